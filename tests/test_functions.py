import datetime as dt

from pyspark.sql import functions as F

from martlet.functions import dates as D
from martlet.functions import text as X
from martlet.plans import sales_plan as SP


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_week_boundaries_count_mondays_crossed(spark):
    sat, sun, mon = dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)
    r = _one(spark, D.week_boundaries(F.lit(sat), F.lit(mon)).alias("a"),
             D.week_boundaries(F.lit(sat), F.lit(sun)).alias("b"))
    assert (r.a, r.b) == (1, 0)


def test_cycle_one_2024_working_days(spark):
    first, last = F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 4, 30))
    r = _one(spark, D.day_diff(first, last).alias("d"), D.week_boundaries(first, last).alias("w"),
             D.working_days(first, last).alias("wd"))
    assert (r.d, r.w, r.wd) == (120, 17, 86)


def test_iso_date_pattern_reads_month_not_minutes(spark):
    assert _one(spark, D.parse_iso_date(F.lit("2024-05-01")).alias("d")).d == dt.date(2024, 5, 1)


def test_cycle_of_month_and_bounds(spark):
    r = _one(spark, D.cycle_of_month(F.lit(4)).alias("a"), D.cycle_of_month(F.lit(5)).alias("b"),
             D.cycle_of_month(F.lit(12)).alias("c"), D.cycle_of_month(F.lit(13)).alias("d"),
             D.cycle_first_day_text(F.lit("2024"), F.lit("C2")).alias("f"),
             D.cycle_last_day_text(F.lit("2024"), F.lit("C3")).alias("l"),
             D.cycle_first_day_text(F.lit("2024"), F.lit("ES")).alias("n"))
    assert (r.a, r.b, r.c, r.d) == ("C1", "C2", "C3", None)
    assert (r.f, r.l, r.n) == ("2024-05-01", "2024-12-31", None)


def test_plan_id_parsing(spark):
    ext = F.lit("MCCP-2024-C1_ESCSO0002PLUSNORTH_X")
    r = _one(spark, SP.plan_year(ext).alias("y"), SP.plan_territory(ext).alias("t"),
             SP.plan_team(ext).alias("team"), SP.plan_cycle(ext).alias("c"), SP.plan_year_cycle(ext).alias("yc"))
    assert (r.y, r.t, r.team, r.c, r.yc) == ("2024", "ESCSO0002PLUSNORTH", "ESCSO0002PLUSN", "C1", "20241")
    r = _one(spark, SP.plan_team(F.lit("MCCP-2024-C1_ESNORTH01CSO_X")).alias("team"))
    assert r.team == "ESNORTH01"   # CSO beyond character 9: not a CSO team


def test_split_part_refuses_empty_delimiter():
    import pytest
    with pytest.raises(ValueError):
        X.split_part("s", "", 1)


def test_round_half_up(spark):
    r = _one(spark, F.round(F.lit(2.5), 0).alias("a"), F.round(F.lit(-2.5), 0).alias("b"))
    assert (r.a, r.b) == (3.0, -3.0)
