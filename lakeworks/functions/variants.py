"""Variant values: parse, extract by path, flatten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(text: Column | str) -> Column:
    """Text to variant; malformed text is NULL."""
    return F.try_parse_json(text)


def path(value: Column | str, where: str, as_type: str = "string") -> Column:
    """Value at a path such as ``user.id`` or ``tags[0].text``.

    A missing path, a JSON null and a value that does not fit ``as_type`` all give NULL.
    """
    if as_type in ("timestamp_ntz", "date"):
        # text such as "2022-10-15 21:41:00.000" has to pass through the string form
        return F.try_variant_get(value, f"$.{where}", "string").try_cast(as_type)
    return F.try_variant_get(value, f"$.{where}", as_type)


def get_key(value: Column | str, key: str, as_type: str = "string") -> Column:
    """Top-level key by name, for keys that are not plain identifiers as well."""
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    got = F.try_variant_get(value, f"$['{quoted}']", "string")
    return got if as_type == "string" else got.try_cast(as_type)


def present(value: Column | str, where: str) -> Column:
    """True where the path holds a value (a JSON null counts as a value)."""
    return F.try_variant_get(value, f"$.{where}", "variant").isNotNull()


def flatten(
    df: DataFrame, value: Column | str, where: str, as_name: str, position: str | None = None
) -> DataFrame:
    """One row per element of the array at ``where``; rows without elements drop out."""
    items = F.try_variant_get(value, f"$.{where}", "array<variant>")
    if position:
        return df.select("*", F.posexplode(items).alias(position, as_name))
    return df.select("*", F.explode(items).alias(as_name))
