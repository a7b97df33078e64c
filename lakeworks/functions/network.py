"""IPv4 addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Addresses sharing their first 16 bits share a join key.
PREFIX_BITS = 16


def _parsed(ip: str) -> tuple[str, str]:
    """SQL texts: whether ``ip`` is well formed, and its value if it is.

    An address is well formed if its value, written as a dotted quad again,
    gives the same text.  That rules out leading zeros, signs, blanks, numbers
    above 255 and missing or surplus parts at once.
    """
    a, b, c, d = (f"try_cast(split_part({ip}, '.', {i}) AS INT)" for i in (1, 2, 3, 4))
    value = f"CAST({a} AS BIGINT) * 16777216 + {b} * 65536 + {c} * 256 + {d}"
    bytes_ = (f"(({value}) div {weight} % 256)" for weight in (16777216, 65536, 256, 1))
    again = " || '.' || ".join(bytes_)
    return f"{again} = {ip} AND {value} >= 0", value


def ip_to_int(ip: str) -> Column:
    """Dotted quad in a column to its 32-bit value as a bigint; anything else is NULL."""
    valid, value = _parsed(ip)
    return F.expr(f"CASE WHEN {valid} THEN {value} END")


def ip_host(ip: str) -> Column:
    """The address itself when it is well formed."""
    return F.expr(f"CASE WHEN {_parsed(ip)[0]} THEN {ip} END")


def join_key(ip_int: Column | str, bits: int = PREFIX_BITS) -> Column:
    """Coarse integer shared by all addresses of one ``32 - bits`` prefix."""
    value = F.col(ip_int) if isinstance(ip_int, str) else ip_int
    return F.shiftright(value, bits)
