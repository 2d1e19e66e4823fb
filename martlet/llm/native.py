"""Column helpers for operators that use DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANK = "[\\x20\\x09-\\x0D]+"
NOT_ALNUM = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """``body(x)`` with x bound to the value, which is computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(text: Column) -> Column:
    """A-Z to lower case. ``lower`` does just that where a text is ASCII, and is much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column, separators: str = BLANK) -> Column:
    """The non-empty parts between separators; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def upto(last: Column) -> Column:
    """1, 2, ... last; empty if last < 1."""
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def winnowed(h: Column, size: Column, gram: int, window: int, whole) -> Column:
    """Fingerprints of a list of gram hashes: structs (fp, lo, windows).

    ``h`` are hashes of grams of ``gram`` units in a list of ``size`` units. Each window of
    ``window`` units selects the least hash inside; runs of windows that select the same hash
    make one fingerprint, with the first window's number (from 1) and ``whole(h, i)`` of each window i.
    """
    last, width = size - (window - 1), window - gram + 1

    def least(i: Column) -> Column:
        own = [F.get(h, i + (k - 1)) for k in range(width)]
        return F.least(*own) if width > 1 else own[0]

    def of_minima(m: Column) -> Column:
        starts = F.filter(upto(last), lambda i: (i == 1) | (F.get(m, i - 1) != F.get(m, i - 2)))
        return let(starts, lambda s: F.transform(s, lambda lo, j: F.struct(
            F.get(m, lo - 1).alias("fp"), lo.alias("lo"),
            F.transform(F.sequence(lo, F.coalesce(F.get(s, j + 1) - 1, last)), lambda i: whole(h, i)).alias("windows"))))

    return let(F.transform(upto(last), least), of_minima)
