"""Mergeable sketches per day and family (A10, A16, A17): profiles and fences of any date range without the lines.

A row of the sketch table holds, for one (day, family), counts, extremes,
a KLL sketch of each measure and an HLL sketch of each identifier.  Sketches
merge, so a range of dates is an aggregate of a few rows a day whatever the
volume of lines; a new day appends its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: KLL size (rank error about 0.4 %) and HLL registers as a power of two (relative error about 1.6 %).
KLL_K, HLL_LOG = 800, 12


def daily_sketches(df: DataFrame, measures, identifiers=(), date_col: str = "fecha", family_col: str = "familia") -> DataFrame:
    """One row a (day, family): n_rows and for each measure nulls, least, greatest, sum and sketch; a sketch for each identifier."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in measures:
        v = F.col(c).cast("double")
        aggs += [
            F.count(F.when(v.isNull(), 1)).alias(f"{c}_nulls"), F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max"), F.sum(F.col(c)).alias(f"{c}_sum"),
            F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias(f"{c}_kll"),
        ]
    aggs += [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_LOG)).alias(f"{c}_hll") for c in identifiers]
    return df.groupBy(date_col, family_col).agg(*aggs)


def profile(sketches: DataFrame, measures, identifiers=(), start=None, end=None, by=("familia",), date_col: str = "fecha", qs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Profile of a date range from the sketch table alone: n_rows and, for each measure, nulls, min, max, mean, quantiles
    (``<c>_q25`` ...) and the 1.5 IQR fences; for each identifier its distinct count (rounded)."""
    if start is not None:
        sketches = sketches.where(F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        sketches = sketches.where(F.col(date_col) <= F.lit(end).cast("date"))
    aggs = [F.sum("n_rows").cast("bigint").alias("n_rows")]
    for c in measures:
        aggs += [
            F.sum(f"{c}_nulls").cast("bigint").alias(f"{c}_nulls"), F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max"),
            F.sum(f"{c}_sum").cast("double").alias("_sum_" + c), F.kll_merge_agg_double(f"{c}_kll").alias("_kll_" + c),
        ]
    aggs += [F.round(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_hll"))).cast("bigint").alias(f"{c}_distinct") for c in identifiers]
    out = sketches.groupBy(*by).agg(*aggs)
    for c in measures:
        known = F.col("n_rows") - F.col(f"{c}_nulls")
        out = out.withColumn(f"{c}_mean", F.try_divide(F.col("_sum_" + c), known))
        for q in qs:
            out = out.withColumn(f"{c}_q{round(q * 100)}", F.when(known > 0, F.kll_sketch_get_quantile_double("_kll_" + c, F.lit(q))))
        if 0.25 in qs and 0.75 in qs:
            spread = F.col(f"{c}_q75") - F.col(f"{c}_q25")
            out = out.withColumns({f"{c}_low_fence": F.col(f"{c}_q25") - 1.5 * spread, f"{c}_high_fence": F.col(f"{c}_q75") + 1.5 * spread})
        out = out.drop("_sum_" + c, "_kll_" + c)
    return out
