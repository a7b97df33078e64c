"""Fixed-position codes, name clean-up and NULL-aware concatenation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(code: Column | str, start: int, length: int) -> Column:
    """``length`` characters from the 1-based position ``start``."""
    return F.substring(code, start, length)


def strip_text(text: Column | str, *removed: str) -> Column:
    """Remove every occurrence of the given pieces."""
    value = F.col(text) if isinstance(text, str) else text
    for piece in removed:
        value = F.replace(value, F.lit(piece))
    return value


def product_name(file_name: Column | str, extension: str = ".png") -> Column:
    """``navy_blue_suit.png`` to ``Navy Blue Suit``."""
    value = F.col(file_name) if isinstance(file_name, str) else file_name
    words = F.replace(value, F.lit("_"), F.lit(" "))
    return F.initcap(F.replace(words, F.lit(extension)))


def join_or(fallback: str, *parts: Column | str) -> Column:
    """Concatenation of ``parts`` (columns, or literal strings), or ``fallback`` if any is NULL."""
    pieces = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.coalesce(F.concat(*pieces), F.lit(fallback))


def any_ilike(text: Column, patterns: list[str]) -> Column:
    """True if the text matches one of the patterns, ignoring case."""
    result = F.lit(False)
    for pattern in patterns:
        result = result | text.ilike(pattern)
    return result


def any_like(text: Column, patterns: list[str]) -> Column:
    """True if the text matches one of the patterns, case included."""
    result = F.lit(False)
    for pattern in patterns:
        result = result | text.like(pattern)
    return result
