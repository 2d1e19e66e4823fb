"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlet.functions.dates import col_


def split_part(s, delim: str, n: int) -> Column:
    """I1 ``SPLIT_PART(s, delim, n)``; an empty delimiter is refused because the
    engines disagree on it."""
    if delim == "":
        raise ValueError("split_part with an empty delimiter is not supported")
    return F.split_part(col_(s), F.lit(delim), F.lit(n))


def left(s, n: int) -> Column:
    return F.left(col_(s), F.lit(n))


def right(s, n: int) -> Column:
    return F.right(col_(s), F.lit(n))


def concat_text(*parts) -> Column:
    """I3 string ``+`` / ``||`` / CONCAT: NULL if any part is NULL."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def rtrim_char(s) -> Column:
    """``::bpchar`` comparison semantics: trailing blanks do not count."""
    return F.rtrim(col_(s))


def timestamp_of_text(s) -> Column:
    """I7 ``s::timestamp`` of ISO text."""
    return col_(s).cast("timestamp_ntz")


def fixed_width(s, n: int) -> Column:
    """I7 ``s::bpchar(n)``: cut or blank-padded to n characters."""
    return F.rpad(F.left(col_(s), F.lit(n)), n, " ")


def safe_cast(s, to: str) -> Column:
    """I7 ``SAFE_CAST``: NULL where the text is no such value."""
    return col_(s).try_cast(to)
