"""Sales-call plan per (plan id, product), prorated by working days.

Plan ids look like ``MCCP-<year>-<cycle>_<territory>_X``. The row filter
needs the parsed cycle and team, so those are computed before the
aggregate; everything else that only depends on the plan id (year,
territory, cycle dates, working days) is computed after it, on one row per
group instead of one per input row. The whole-table latest load date is a
scalar subquery (one value, no join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import (
    cycle_first_day_text, cycle_last_day_text, day_diff, parse_iso_date, working_days)
from martlet.functions.text import concat_text, left, right, split_part
from martlet.operators.aggregates import sum_when_or_null
from martlet.plans.params import Params
from martlet.sources.catalog import Catalog

# Fixed values of the model: country, face-to-face channels, attainment
# thresholds (percent) and the team marker.
COUNTRY = "SPAIN"
CHANNELS = ["ES_F2F", "ES_S2S"]
FC_MIN = 80
NOFC_MAX = 79
TEAM_MARK = "%CSO%"
EXCLUDED_CYCLE = "ES"

EXT = "external_id_vod__c"


def _ext(ext):
    return F.col(ext) if isinstance(ext, str) else ext


def plan_year(ext=EXT):
    return split_part(ext, "-", 2)


def plan_territory(ext=EXT):
    return split_part(ext, "_", 2)


def plan_team(ext=EXT):
    """First 14 characters of the territory for PLUS plans, else 9."""
    terr = plan_territory(ext)
    return F.when(_ext(ext).like("%PLUS%"), left(terr, 14)).otherwise(left(terr, 9))


def plan_cycle(ext=EXT):
    return right(split_part(ext, "_", 1), 2)


def plan_year_cycle(ext=EXT):
    return concat_text(plan_year(ext), right(split_part(ext, "_", 1), 1))


def sales_call_plan(cat: Catalog, params: Params = Params()) -> DataFrame:
    src = cat.table("stg_mccp_prod_plan")
    # modified_date is ISO text (yyyy-MM-dd), so its maximum is the maximum of
    # the parsed dates. Aggregating the DATE keeps a fixed-width buffer and a
    # hash aggregate; max() of a string would sort every input row first.
    # A text that is no such date raises, as the source dialect's TO_DATE does.
    text = F.col("modified_date")
    modified = F.coalesce(F.try_to_date(text, "yyyy-MM-dd"),
                          F.when(text.isNotNull(), F.raise_error(F.concat(F.lit("modified_date is no date: "), text)).cast("date")))
    max_loaded = src.agg(F.max(modified).alias("m")).scalar()

    in_scope = (F.col("ropu_nm") == COUNTRY) & F.col("channel_vod__c").isin(CHANNELS) \
        & (plan_cycle() != EXCLUDED_CYCLE) & plan_team().like(TEAM_MARK)
    counted = F.col("channel_vod__c").isin(CHANNELS) & F.col("last_activity_datetime_vod__c").isNotNull()
    att = F.col("product_attainment_vod__c")

    agg = (src.where(in_scope)
           .groupBy("external_id_vod__c", "product_name_vod__c")
           .agg(F.date_format(F.max(modified), "yyyy-MM-dd").alias("fechacargaact"),
                F.sum("product_activity_goal_vod__c").alias("goal"),
                F.sum("product_actual_activity_vod__c").alias("product_actual_activity_vod__c"),
                F.sum("product_interactions_actual_vod__c").alias("product_interactions_actual_vod__c"),
                sum_when_or_null((att >= FC_MIN) & counted).cast("long").alias("fc"),
                sum_when_or_null((att <= NOFC_MAX) & counted).cast("long").alias("nofc"),
                F.max("systemmodstamp").alias("systemmodstamp")))

    year, cycle = plan_year(), plan_cycle()
    first_txt, last_txt = cycle_first_day_text(year, cycle), cycle_last_day_text(year, cycle)
    loaded = parse_iso_date(F.col("fechacargaact"))
    first_day, last_day = parse_iso_date(first_txt), parse_iso_date(last_txt)
    open_cycle = last_day > loaded
    wd_to_date = F.when(open_cycle, working_days(first_day, loaded)).otherwise(F.lit(1))
    wd_cycle = working_days(first_day, last_day)
    prorated = F.when(open_cycle, F.col("goal") * wd_to_date / F.nullif(wd_cycle, F.lit(0))) \
        .otherwise(F.col("goal"))

    return agg.select(
        "external_id_vod__c",
        "fechacargaact",
        max_loaded.alias("maxfecha"),
        year.alias("year"),
        plan_territory().alias("terr"),
        plan_team().alias("team"),
        cycle.alias("ciclo"),
        plan_year_cycle().alias("yearciclo"),
        first_txt.alias("firstdaycicle"),
        last_txt.alias("lastdaycicle"),
        F.when(open_cycle, day_diff(loaded, last_day)).otherwise(F.lit(1)).alias("days_to_prorrate"),
        wd_to_date.alias("working_days_to_prorrate"),
        wd_cycle.alias("working_days_ciclo"),
        "product_name_vod__c",
        F.col("goal").alias("product_activity_goal_vod__c"),
        prorated.alias("product_activity_goal_vod__c_workingprorrate"),
        F.round(prorated, 0).alias("product_activity_goal_vod__c_workingprorrate_round"),
        "product_actual_activity_vod__c",
        "product_interactions_actual_vod__c",
        "fc", "nofc", "systemmodstamp")
