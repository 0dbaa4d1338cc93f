"""Roll-ups: complete ISO weeks (A1/A2), daily (A3), weekly resample (A4), monthly (A5).

All roll-ups are single ``groupBy`` aggregates with partial (map-side)
aggregation: sums and maxima combine before the shuffle, and distinct days
are reduced to one row per (group, day) before the week-level count, so a
family holding a third of all rows only costs its share of map-side work.
Spines (calendar × family) are generated from the min/max of the data with
``sequence`` + ``explode``; their size is bounded by days × families, not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal


def weekly_rollup(
    df: DataFrame,
    min_days: int = 7,
    date_col: str = "fecha",
    family_col: str = "familia",
    value_col: str = "base_imponible",
    flag_cols=("is_summer_peak", "is_easter"),
) -> DataFrame:
    """A1: per ISO week and family — sum of the measure, max of each flag, distinct days.

    Keeps weeks with at least ``min_days`` distinct days.  Output columns:
    ``year, week, familia, <value>, <flags…>, dias_semana, week_start``.
    """
    ws = cal.week_monday(date_col)
    aggs = [F.sum(value_col).alias(value_col)]
    aggs += [F.max(F.col(f)).cast("int").alias(f) for f in flag_cols]
    aggs.append(F.count_distinct(F.col(date_col)).alias("dias_semana"))
    out = (
        df.groupBy(ws.alias("week_start"), F.col(family_col))
        .agg(*aggs)
        .where(F.col("dias_semana") >= min_days)
    )
    return out.select(
        cal.iso_year("week_start").cast("bigint").alias("year"),
        cal.iso_week("week_start").cast("bigint").alias("week"),
        F.col(family_col),
        F.col(value_col).cast("double").alias(value_col),
        *[F.col(f) for f in flag_cols],
        F.col("dias_semana").cast("bigint").alias("dias_semana"),
        "week_start",
    )


def daily_series(
    df: DataFrame,
    date_col: str = "fecha",
    family_col: str = "familia",
    value_cols=("base_imponible", "total"),
    easter_rule: str = "window",
    keep_decimal: bool = False,
) -> DataFrame:
    """A3: one row per (date, family) with summed measures and calendar columns (D3).

    ``keep_decimal`` leaves DECIMAL sums for further exact roll-ups (A4/A5).
    """
    out = df.groupBy(F.col(date_col), F.col(family_col)).agg(
        *[(F.sum(c) if keep_decimal else F.sum(c).cast("double")).alias(c) for c in value_cols]
    )
    return cal.add_daily_calendar(out, date_col, easter_rule)


def _family_spine(df: DataFrame, family_col: str, label: F.Column, step: str) -> DataFrame:
    """Per family, every label between the family's first and last label."""
    bounds = df.groupBy(family_col).agg(F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    return bounds.select(
        family_col,
        F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias("_label"),
    )


def weekly_resample(
    daily: DataFrame,
    date_col: str = "fecha",
    family_col: str = "familia",
    value_cols=("base_imponible", "total", "is_easter", "is_summer_peak"),
    keep_decimal: bool = False,
) -> DataFrame:
    """A4: Sunday-labelled weekly sums; empty weeks inside a family's span are 0.

    The flags are summed (EDA semantics), unlike A1 which takes their max.
    ``keep_decimal`` keeps exact sums for later window arithmetic.
    """
    label = cal.week_ending_sunday(date_col)
    sums = daily.groupBy(label.alias("_label"), F.col(family_col)).agg(
        *[F.sum(c).alias(c) for c in value_cols]
    )
    spine = _family_spine(sums, family_col, F.col("_label"), "7 DAYS")
    out = spine.join(sums, ["_label", family_col], "left")
    if keep_decimal:
        filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in value_cols]
    else:
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in value_cols]
    return out.select(F.col("_label").alias(date_col), family_col, *filled)


def monthly_spine(
    daily: DataFrame,
    date_col: str = "fecha",
    family_col: str = "familia",
    value_cols=("base_imponible", "total", "is_easter", "is_summer_peak"),
) -> DataFrame:
    """A5 + J2 + J3: month-end sums on a (month end × family) spine, missing cells 0.

    The spine holds the month ends that are ≤ the last date, so a partial last
    month is dropped (Q18).  It is built per family by exploding a month
    sequence; its size is bounded by months × families, never by rows.
    """
    label = F.last_day(F.col(date_col))
    sums = daily.groupBy(label.alias("_label"), F.col(family_col)).agg(
        *[F.sum(c).alias(c) for c in value_cols]
    )
    # one row per family carrying the global date bounds; the spine is then an
    # explode per family (months × families rows, bounded by the calendar)
    everything = Window.partitionBy()
    fams = (
        daily.groupBy(family_col)
        .agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
        .select(family_col, F.min("_lo").over(everything).alias("_lo"), F.max("_hi").over(everything).alias("_hi"))
    )
    spine = (
        fams.select(family_col, "_hi", F.explode(F.sequence(F.trunc("_lo", "MM"), F.col("_hi"), F.expr("INTERVAL 1 MONTH"))).alias("_m"))
        .select(family_col, "_hi", F.last_day("_m").alias("_label"))
        .where(F.col("_label") <= F.col("_hi"))
        .select("_label", family_col)
    )
    out = spine.join(sums, ["_label", family_col], "left")
    return out.select(
        F.col("_label").alias(date_col),
        family_col,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in value_cols],
    )
