"""Column names for working columns next to columns that a caller brings."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to differ from all columns in any case."""
    taken = {c.lower() for c in columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        free.append(name)
    return free
