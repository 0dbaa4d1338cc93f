"""Exploration reports.

Every report is one grouped aggregate over the sales lines or an
aggregated series; flags are unpivoted with ``stack`` so one pass serves
all of them.  Exact quantiles are only taken over aggregated series (days ×
families or weeks × families), whose size does not grow with raw volume;
``positional.exact_quantiles`` covers raw columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as num
from . import positional
from .joins import join_small

CORR_VARS = ("base_imponible", "is_summer_peak", "is_easter", "is_weekend", "day_of_week", "month")
DAILY_FLAGS = ("is_weekend", "is_summer_peak", "is_easter", "day_of_week")


def _mean(c) -> F.Column:
    """Mean of a DECIMAL column as DOUBLE from its exact sum (plan-independent)."""
    return num.ratio(F.sum(c), F.count(c))


def totals_by(df: DataFrame, keys, value_col: str = "base_imponible", name: str = "total_sales") -> DataFrame:
    """Summed sales by any key set (year/month, year/week, weekday, family)."""
    return df.groupBy(*keys).agg(F.sum(value_col).cast("double").alias(name), F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def yoy_pivot(df: DataFrame, value_col: str = "base_imponible", date_col: str = "fecha", years=None) -> DataFrame:
    """Month × year matrix of summed sales (one column per year)."""
    src = df.withColumn("year", F.year(date_col).cast("string"))
    g = src.groupBy(F.month(date_col).cast("int").alias("month"))
    pivoted = (g.pivot("year", [str(y) for y in years]) if years is not None else g.pivot("year")).agg(F.sum(value_col))
    return pivoted.select("month", *[F.col(c).cast("double").alias(c) for c in pivoted.columns if c != "month"])


def unpivot_flags(df: DataFrame, flags, keep) -> DataFrame:
    """(keep…, flag, value) rows, one per flag, via ``stack``."""
    pairs = ", ".join(f"'{f}', cast(`{f}` as int)" for f in flags)
    return df.select(*keep, F.expr(f"stack({len(flags)}, {pairs}) as (flag, value)"))


def mean_by_flag(daily: DataFrame, flags=DAILY_FLAGS, value_col: str = "base_imponible", family_col: str = "familia") -> DataFrame:
    """Mean daily sales per family for each value of each flag."""
    long = unpivot_flags(daily, flags, [family_col, value_col])
    return long.groupBy(family_col, "flag", "value").agg(
        _mean(value_col).alias("mean_sales"), F.count(F.lit(1)).cast("bigint").alias("n_days")
    )


def flag_uplift(daily: DataFrame, flags=("is_summer_peak", "is_easter"), value_col: str = "total", family_col: str = "familia") -> DataFrame:
    """% change of the mean when the flag is 1 vs 0, per family."""
    long = unpivot_flags(daily, flags, [family_col, value_col])
    out = long.groupBy(family_col, "flag").agg(
        num.ratio(F.sum(F.when(F.col("value") == 1, F.col(value_col))), F.count(F.when(F.col("value") == 1, F.col(value_col)))).alias("mean_on"),
        num.ratio(F.sum(F.when(F.col("value") == 0, F.col(value_col))), F.count(F.when(F.col("value") == 0, F.col(value_col)))).alias("mean_off"),
    )
    return out.withColumn("uplift_pct", F.try_divide(F.col("mean_on") - F.col("mean_off"), F.col("mean_off")) * 100)


def iqr_bounds(
    series: DataFrame, value_col: str = "base_imponible", family_col: str = "familia", k: float = 1.5, raw: bool = False
) -> DataFrame:
    """A10: per family Q1, Q3 (linear interpolation), IQR and the k·IQR fences.

    ``percentile`` holds a group's values in one task, which is right for an
    aggregated series (days × families).  ``raw=True`` is for unbounded
    inputs: the same exact quantiles from ranked per-value counts.
    """
    if raw:
        qs = positional.exact_quantiles(series, value_col, (0.25, 0.75), [family_col])
        out = qs.groupBy(family_col).agg(
            F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
            F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
        )
    else:
        q = F.percentile(F.col(value_col).cast("double"), F.array(F.lit(0.25), F.lit(0.75)))
        out = series.groupBy(family_col).agg(q.alias("_q"))
        out = out.select(family_col, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
    out = out.withColumn("iqr", F.col("q3") - F.col("q1"))
    return out.withColumns(
        {"lower_bound": F.col("q1") - F.lit(k) * F.col("iqr"), "upper_bound": F.col("q3") + F.lit(k) * F.col("iqr")}
    )


def flag_outliers(series: DataFrame, bounds: DataFrame, value_col: str = "base_imponible", family_col: str = "familia") -> DataFrame:
    """Rows of the series outside their family's fences (bounds: one row per family)."""
    v = F.col(value_col).cast("double")
    return join_small(series, bounds, family_col).where((v < F.col("lower_bound")) | (v > F.col("upper_bound")))


def iqr_outliers(series: DataFrame, value_col: str = "base_imponible", family_col: str = "familia") -> DataFrame:
    """A10: fences plus the number of outliers per family."""
    b = iqr_bounds(series, value_col, family_col)
    counts = flag_outliers(series, b, value_col, family_col).groupBy(family_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_outliers")
    )
    return b.join(counts, family_col, "left").withColumn("n_outliers", F.coalesce("n_outliers", F.lit(0).cast("bigint")))


def correlation_matrix(daily: DataFrame, variables=CORR_VARS, family_col: str = "familia") -> DataFrame:
    """Pearson correlation of every variable pair per family (long format; NULL for constants)."""
    aggs = []
    for x in variables:
        for y in variables:
            aggs.append(num.safe_corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"{x}__{y}"))
    wide = daily.groupBy(family_col).agg(*aggs)
    pairs = ", ".join(f"'{x}', '{y}', `{x}__{y}`" for x in variables for y in variables)
    return wide.select(family_col, F.expr(f"stack({len(variables) ** 2}, {pairs}) as (var_x, var_y, corr)"))


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column (long format)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', cast(`{c}` as bigint)" for c in df.columns)
    return wide.select(F.expr(f"stack({len(df.columns)}, {pairs}) as (column_name, n_null)"))


def nulls_by_group(df: DataFrame, keys, cols) -> DataFrame:
    """Null counts of some columns per group."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"null_{c}") for c in cols])


def _distinct_count(df: DataFrame, name: str, kind: str) -> DataFrame:
    """column_name, n_distinct of one column (nulls are no value).

    Types whose texts may tell more or fewer values apart (floats' signed
    zeros, timestamps) are compared as texts.
    """
    v = F.col(name)
    if not kind.startswith(("decimal", "int", "bigint", "smallint", "tinyint", "boolean", "date", "string")) or kind.startswith("interval"):
        v = v.cast("string")
    values = df.select(v.alias("v")).where("v is not null").distinct()
    return values.agg(F.count(F.lit(1)).alias("n_distinct")).select(F.lit(name).alias("column_name"), "n_distinct")


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column — distinct and null counts, text min/max, numeric min/max/mean (long format).

    Every column is counted by a distinct aggregation of its own, over a scan
    of that column alone: a task holds one column's values in their own type,
    not the texts of all columns at once.  The other statistics are one plain
    global aggregate, unpivoted with ``stack``; the two 1-row-per-column
    results are joined on the column name.  ``exact=False`` swaps in
    HyperLogLog++ distinct counts for very wide, high-cardinality tables.
    """
    if exact:
        distinct = reduce(DataFrame.union, [_distinct_count(df, c, t) for c, t in df.dtypes])
    else:
        about = df.agg(*[F.approx_count_distinct(F.col(c).cast("string")).alias(c) for c in df.columns])
        pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
        distinct = about.select(F.expr(f"stack({len(df.columns)}, {pairs}) as (column_name, n_distinct)"))
    aggs, rows = [], []
    for i, (c, t) in enumerate(df.dtypes):
        numeric = t.startswith(("decimal", "double", "float", "int", "bigint", "smallint"))
        textual = t in ("string", "date")
        col = F.col(c)
        aggs.append(F.count_if(col.isNull()).cast("bigint").alias(f"n{i}"))
        if textual:
            aggs += [F.min(col).cast("string").alias(f"lt{i}"), F.max(col).cast("string").alias(f"ht{i}")]
        if numeric:
            aggs += [
                F.min(col).cast("double").alias(f"ln{i}"),
                F.max(col).cast("double").alias(f"hn{i}"),
                num.ratio(F.sum(col), F.count(col)).alias(f"m{i}"),
            ]
        text = (f"lt{i}", f"ht{i}") if textual else ("cast(null as string)", "cast(null as string)")
        nums = (f"ln{i}", f"hn{i}", f"m{i}") if numeric else ("cast(null as double)",) * 3
        rows.append(f"'{c}', n{i}, {text[0]}, {text[1]}, {nums[0]}, {nums[1]}, {nums[2]}")
    stats = df.agg(*aggs).select(
        F.expr(f"stack({len(rows)}, {', '.join(rows)}) as (column_name, n_null, min_text, max_text, min_num, max_num, mean_num)")
    )
    out = stats.join(distinct, "column_name", "left")
    return out.select(
        "column_name",
        F.coalesce("n_distinct", F.lit(0).cast("bigint")).alias("n_distinct"),
        "n_null", "min_text", "max_text", "min_num", "max_num", "mean_num",
    )


def value_lists(df: DataFrame, fewer_than: int = 10) -> DataFrame:
    """The values of each column with fewer than ``fewer_than`` distinct ones, with their counts (long format).

    Distinct values per column are first bounded with HyperLogLog++ (one row
    per column), so columns with very many values are left out before the
    exact count; nulls are no value.
    """
    names = [c for c, _ in df.dtypes]
    about = df.agg(*[F.approx_count_distinct(F.col(c).cast("string")).alias(c) for c in names]).first()  # one row
    few = [c for c in names if about[c] < 2 * fewer_than]  # the estimate is off by a few percent at most
    if not few:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n bigint")
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in few])
    counts = df.select(F.explode(pairs).alias("_p")).select("_p.*").where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    kept = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") < fewer_than)
    return counts.join(kept.select("column_name"), "column_name", "left_semi")


def series_stats(series: DataFrame, value_col: str = "base_imponible", family_col: str = "familia", order_col: str = "week_start") -> DataFrame:
    """describe() per family — count, mean, sample std, min, quartiles, max, first/last period."""
    v = F.col(value_col).cast("double")
    qs = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = series.groupBy(family_col).agg(
        F.count(v).cast("bigint").alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        qs.alias("_q"),
        F.max(v).alias("max"),
        F.min(order_col).alias("first_period"),
        F.max(order_col).alias("last_period"),
    )
    return out.select(
        family_col, "n", "mean", "std", "min",
        F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q75"),
        "max", "first_period", "last_period",
    )


def top_k(df: DataFrame, k: int, value_col: str, key_col: str) -> DataFrame:
    """O2: k largest keys by total value (ties broken by key) — a TakeOrderedAndProject."""
    totals = df.groupBy(key_col).agg(F.sum(value_col).cast("double").alias("total_sales"))
    return totals.orderBy(F.desc("total_sales"), F.asc(key_col)).limit(k)


def restrict_to(df: DataFrame, keys: DataFrame, key_col: str) -> DataFrame:
    """O3: rows whose key is in a key set (a top-k result), as a semi join; the set is broadcast only if its size is bounded."""
    return join_small(df, keys.select(key_col), key_col, "left_semi")
