"""Date helpers as Column expressions (I8-I25). All JVM-side, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts) -> Column:
    """I8 ``DATE(ts)`` in the session time zone (UTC)."""
    return F.to_date(col_(ts))


def as_timestamp(d) -> Column:
    """I12 ``TIMESTAMP(date)``: midnight of the day."""
    return col_(d).cast("timestamp_ntz")


def days_ago(as_of, n: int) -> Column:
    """I10 ``DATE_SUB(d, INTERVAL n DAY)``."""
    return F.date_sub(col_(as_of), n)


def months_ago(d, n: int) -> Column:
    """I11 ``DATE_SUB(d, INTERVAL n MONTH)`` (clamped to month end like SQL)."""
    return F.add_months(col_(d), -n)


def month_start(d) -> Column:
    """I13 ``DATE_TRUNC(d, MONTH)`` on a date or timestamp, as a DATE."""
    return F.trunc(F.to_date(col_(d)), "MM")


def month_label(ts) -> Column:
    """I14 ``FORMAT_TIMESTAMP('%Y-%m', ts)``."""
    return F.date_format(col_(ts), "yyyy-MM")


def parse_month_label(s) -> Column:
    """I15 ``PARSE_DATE('%Y-%m', s)``: first day of the month."""
    return F.to_date(col_(s), "yyyy-MM")


def parse_iso_date(s) -> Column:
    """I17 ``TO_DATE(s, 'yyyy-mm-dd')``. In the source dialect ``mm`` is the month;
    in Spark's pattern language it is the minute, so the pattern is restated."""
    return F.to_date(col_(s), "yyyy-MM-dd")


def iso_date_text(d) -> Column:
    """I18 ``TO_CHAR(d, 'YYYY-MM-DD')``."""
    return F.date_format(col_(d), "yyyy-MM-dd")


def day_diff(start, end) -> Column:
    """I19 ``DATEDIFF(day, start, end)`` = end - start in days."""
    return F.datediff(col_(end), col_(start))


def week_boundaries(start, end) -> Column:
    """I20 ``DATEDIFF(week, start, end)``: number of week starts (Mondays)
    crossed going from ``start`` to ``end``, not elapsed weeks."""
    a = F.to_date(F.date_trunc("week", col_(start)))
    b = F.to_date(F.date_trunc("week", col_(end)))
    return (F.datediff(b, a) / 7).cast("int")


def working_days(start, end) -> Column:
    """I21 ``weeks*5 + (days - weeks*7)``, endpoint exclusive as written."""
    w = week_boundaries(start, end)
    return w * 5 + (day_diff(start, end) - w * 7)


# Fiscal cycles of four months and their first / last day (MM-dd).
CYCLE_BOUNDS = {
    "C1": ("01-01", "04-30"),
    "C2": ("05-01", "08-31"),
    "C3": ("09-01", "12-31"),
}


def cycle_of_month(month) -> Column:
    """I24 month 1-4 -> C1, 5-8 -> C2, 9-12 -> C3, else NULL."""
    m = col_(month)
    return (F.when(m.between(1, 4), "C1").when(m.between(5, 8), "C2")
            .when(m.between(9, 12), "C3").otherwise(F.lit(None).cast("string")))


def cycle_first_day_text(year_text, cycle) -> Column:
    """I25 ``year || '-01-01'`` etc.; NULL for other cycle codes."""
    c = col_(cycle)
    expr = None
    for code, (first, _last) in CYCLE_BOUNDS.items():
        v = F.concat(col_(year_text), F.lit("-" + first))
        expr = F.when(c == code, v) if expr is None else expr.when(c == code, v)
    return expr.otherwise(F.lit(None).cast("string"))


def cycle_last_day_text(year_text, cycle) -> Column:
    c = col_(cycle)
    expr = None
    for code, (_first, last) in CYCLE_BOUNDS.items():
        v = F.concat(col_(year_text), F.lit("-" + last))
        expr = F.when(c == code, v) if expr is None else expr.when(c == code, v)
    return expr.otherwise(F.lit(None).cast("string"))


def timestamp_trunc(ts, unit: str) -> Column:
    """I13 ``DATE_TRUNC(unit, ts)`` as a timestamp; weeks start on Monday."""
    return F.date_trunc(unit, col_(ts)).cast("timestamp_ntz")


def parse_timestamp(s, pattern: str) -> Column:
    """I15 ``PARSE_TIMESTAMP``: text to a timestamp by a Spark pattern; what the pattern lacks is its least value."""
    return F.to_timestamp_ntz(col_(s), F.lit(pattern))
