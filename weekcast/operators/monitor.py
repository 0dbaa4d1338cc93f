"""Monitoring: data quality, drift (PSI, Kolmogorov–Smirnov), histograms, run log.

Drift works on a frame with a ``side`` column (``baseline``/``current``) and
a ``value`` column, optionally per group.  Buckets, counts and cumulative
distributions are aggregates; the KS running sums and the positional 70/30
split use the range-partitioned helpers in ``positional`` so a global order
never collapses into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as num
from ..session import ensure_checkpoint_dir
from . import positional
from .joins import join_small

# Fixed values of the drift rules.
PSI_BUCKETS = 10
PSI_FLOOR = 0.0001  # share used for an empty bucket
BASELINE_SHARE = 0.7  # first 70 % of rows by position are the baseline
MIN_SIDE_ROWS = 10
ALERTS = (("high", 0.25, 0.01), ("medium", 0.1, 0.05))  # (level, psi above, p-value below)
QUALITY_CLAMP = (0.8, 1.0)
KS_EXACT_MAX = 10_000  # sizes up to which the two-sample p-value is exact (the reference library's switch)
KS_TERMS = 40  # exp(-2·j²·z²) < 1e-30 for j ≥ 40 once z ≥ 0.15 (below 0.15 the p-value is 1)


# ---------------------------------------------------------------- sides


def _grouped(sides: DataFrame, group_cols):
    """Ungrouped drift runs as one constant group so every join stays an equi-join.

    The key is 0 on every row but is not a literal: Catalyst folds a literal
    key out of the join condition, which would turn the join into a
    nested-loop/cartesian join.
    """
    group_cols = list(group_cols)
    if group_cols:
        return sides, group_cols, False
    return sides.withColumn("_g", F.xxhash64(F.col("side")) * F.lit(0)), ["_g"], True


def split_sides_global(df: DataFrame, order_cols, value_col: str, ratio: float = BASELINE_SHARE) -> DataFrame:
    """70/30 positional split of a whole (unbounded) table in ``order_cols`` order.

    Positions come from a range-partitioned rank; the boundary is a scalar
    subquery on the row count.  Output: ``side, value`` (nulls dropped after
    the split, as the reference does).
    """
    pos = positional.global_position(df.select(*order_cols, value_col), order_cols)
    n = df.agg(F.count(F.lit(1))).scalar()
    side = F.when(F.col("_pos") < F.floor(n * F.lit(ratio)), F.lit("baseline")).otherwise(F.lit("current"))
    return pos.select(side.alias("side"), F.col(value_col).cast("double").alias("value")).where(F.col("value").isNotNull())


def split_sides_grouped(df: DataFrame, group_cols, order_col: str, value_col: str, ratio: float = BASELINE_SHARE) -> DataFrame:
    """Same split inside each group of a bounded series (e.g. one family's weeks)."""
    w = Window.partitionBy(*group_cols).orderBy(order_col)
    pos = F.row_number().over(w) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy(*group_cols))
    side = F.when(pos < F.floor(n * F.lit(ratio)), F.lit("baseline")).otherwise(F.lit("current"))
    return df.select(*group_cols, side.alias("side"), F.col(value_col).cast("double").alias("value")).where(
        F.col("value").isNotNull()
    )


def _attach(df: DataFrame, small: DataFrame, group_cols, how: str = "inner") -> DataFrame:
    """Join one-row-per-group results; an ungrouped (one-row) result becomes scalar subqueries."""
    if group_cols:
        return join_small(df, small, list(group_cols), how)
    return df.withColumns({c: small.select(c).scalar() for c in small.columns})


# ---------------------------------------------------------------- PSI


def psi(sides: DataFrame, group_cols=(), buckets: int = PSI_BUCKETS, mode: str = "independent") -> DataFrame:
    """Population stability index per group.

    ``independent`` bins each side over its own [min, max] (reference: compares
    shapes); ``shared`` bins both over the union range (compares locations).
    A degenerate range [x, x] is widened to [x − 0.5, x + 0.5] (numpy).
    """
    sides, group_cols, synthetic = _grouped(sides, group_cols)
    stats = sides.groupBy(*group_cols, "side").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count(F.lit(1)).alias("_n")
    )
    if mode == "shared":
        g = Window.partitionBy(*group_cols)
        stats = stats.withColumns({"_lo": F.min("_lo").over(g), "_hi": F.max("_hi").over(g)})
    elif mode != "independent":
        raise ValueError(mode)
    same = F.col("_hi") == F.col("_lo")
    stats = stats.withColumns(
        {
            "_lo": F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo")),
            "_hi": F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi")),
        }
    )
    keyed = join_small(sides, stats, [*group_cols, "side"])  # two rows per group
    raw = F.floor((F.col("value") - F.col("_lo")) * (F.lit(float(buckets)) / (F.col("_hi") - F.col("_lo"))))
    bucket = F.least(F.greatest(raw, F.lit(0)), F.lit(buckets - 1)).cast("int")
    counts = keyed.groupBy(*group_cols, bucket.alias("bucket")).agg(
        F.count(F.when(F.col("side") == "baseline", 1)).alias("_ce"),
        F.count(F.when(F.col("side") == "current", 1)).alias("_ca"),
    )
    sizes = stats.groupBy(*group_cols).agg(
        F.max(F.when(F.col("side") == "baseline", F.col("_n"))).alias("_ne"),
        F.max(F.when(F.col("side") == "current", F.col("_n"))).alias("_na"),
    )
    spine = sizes.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    full = spine.join(counts, [*group_cols, "bucket"], "left")
    e = F.coalesce(F.col("_ce"), F.lit(0)) / F.col("_ne")
    a = F.coalesce(F.col("_ca"), F.lit(0)) / F.col("_na")
    e = F.when(e == 0, F.lit(PSI_FLOOR)).otherwise(e)
    a = F.when(a == 0, F.lit(PSI_FLOOR)).otherwise(a)
    term = (a - e) * F.log(a / e)
    out = full.groupBy(*group_cols).agg(F.sum(term).alias("psi"))
    return out.drop("_g") if synthetic else out


# ---------------------------------------------------------------- KS


def ks_pvalue(d, n1, n2, terms: int = KS_TERMS) -> F.Column:
    """Asymptotic two-sided p-value: Kolmogorov survival function at z = sqrt(n1·n2/(n1+n2))·D.

    Expects ``z`` to be computed by ``with_ks_z`` (keeps the generated code small).
    """
    z = F.col("_z")
    total = F.lit(0.0)
    for j in range(1, terms + 1):
        sign = 1.0 if j % 2 else -1.0
        total = total + F.lit(sign) * F.exp(F.lit(-2.0 * j * j) * z * z)
    p = F.least(F.greatest(F.lit(2.0) * total, F.lit(0.0)), F.lit(1.0))
    # the alternating series needs many terms near 0, where the value is 1
    return F.when(z < 0.15, F.lit(1.0)).otherwise(p)


def ks_exact_pvalue(gap, n1, n2) -> F.Column:
    """Exact two-sided p-value: the share of all orders of both samples whose statistic reaches the observed one.

    An order is a lattice path from (0, 0) to (n1, n2); it reaches the
    statistic where |i·n2 − j·n1| ≥ ``gap`` (= statistic · n1 · n2, a whole
    number).  A path drawn at random goes on to i + 1 with probability
    (n1 − i) / (n1 + n2 − t) after t steps, so the mass that leaves the band
    is added up step by step: no subtraction, no scaling.  Only the band's
    cells are held (about 2·gap / (n1 + n2) of them).
    """
    m, n = n1.cast("bigint"), n2.cast("bigint")
    total = m + n

    def step(acc, t):
        lo, f, left = acc["lo"], acc["f"], total - t
        hi = lo + F.size(f) - 1
        lo2 = F.greatest(F.floor(((t + 1) * m - gap) / total) + 1, t + 1 - n, F.lit(0).cast("bigint"))
        hi2 = F.least(F.ceil(((t + 1) * m + gap) / total) - 1, m, t + 1)
        cell = lambda i: F.coalesce(F.get(f, i), F.lit(0.0))
        moved = F.transform(
            F.sequence(lo2, hi2), lambda i: (cell((i - 1 - lo).cast("int")) * (m - i + 1) + cell((i - lo).cast("int")) * (n - t + i)) / left
        )
        up = F.when(hi + 1 > hi2, cell(F.size(f) - 1) * (m - hi) / left).otherwise(0.0)
        down = F.when(lo < lo2, cell(F.lit(0)) * (n - t + lo) / left).otherwise(0.0)
        return F.struct(lo2.alias("lo"), F.when(hi2 < lo2, F.array().cast("array<double>")).otherwise(moved).alias("f"), (acc["out"] + up + down).alias("out"))

    begin = F.struct(F.lit(0).cast("bigint").alias("lo"), F.array(F.lit(1.0)).alias("f"), F.lit(0.0).alias("out"))
    walked = F.aggregate(F.sequence(F.lit(0).cast("bigint"), total - 1), begin, step, lambda acc: acc["out"])
    return F.when(gap == 0, F.lit(1.0)).otherwise(F.least(walked, F.lit(1.0)))


def with_ks_z(df: DataFrame, d, n1, n2) -> DataFrame:
    en = (n1.cast("double") * n2.cast("double")) / (n1 + n2).cast("double")
    return df.withColumn("_z", F.sqrt(en) * d)


def ks(sides: DataFrame, group_cols=(), bounded: bool = False) -> DataFrame:
    """Two-sample KS statistic max|F_baseline − F_current| and its p-value.

    The p-value is exact while both sides have at most ``KS_EXACT_MAX``
    values and the asymptotic one beyond (``ks_p_asymptotic`` has it always).

    ``bounded=True`` is for per-group series whose size does not grow with
    the raw data (weeks × families): the cumulative counts are then one
    window per group instead of the sliced running sums.
    """
    sides, group_cols, synthetic = _grouped(sides, group_cols)
    per_value = sides.groupBy(*group_cols, "value").agg(
        F.count(F.when(F.col("side") == "baseline", 1)).alias("cb"),
        F.count(F.when(F.col("side") == "current", 1)).alias("cc"),
    )
    if bounded and not synthetic:
        upto = Window.partitionBy(*group_cols).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        cum = per_value.withColumns({"cum_cb": F.sum("cb").over(upto), "cum_cc": F.sum("cc").over(upto)})
    else:
        cum = positional.running_sums(per_value, group_cols, "value", ["cb", "cc"])
    sizes = per_value.groupBy(*group_cols).agg(F.sum("cb").alias("_nb"), F.sum("cc").alias("_nc"))
    gap = F.abs(F.col("cum_cb") / F.col("_nb") - F.col("cum_cc") / F.col("_nc"))
    if synthetic:
        joined = _attach(cum, sizes.drop("_g"), [])
    else:
        joined = join_small(cum, sizes, group_cols)
    small = F.greatest("_nb", "_nc") <= KS_EXACT_MAX
    whole = F.when(small, F.abs(F.col("cum_cb") * F.col("_nc") - F.col("cum_cc") * F.col("_nb")))
    out = joined.groupBy(*group_cols).agg(
        F.max(gap).alias("ks_statistic"), F.max(whole).alias("_gap"), F.max("_nb").alias("_nb"), F.max("_nc").alias("_nc")
    )
    out = with_ks_z(out, F.col("ks_statistic"), F.col("_nb"), F.col("_nc"))
    out = out.withColumn("ks_p_asymptotic", ks_pvalue(F.col("ks_statistic"), F.col("_nb"), F.col("_nc")))
    both = small & (F.col("_nb") > 0) & (F.col("_nc") > 0)
    exact = F.when(both, ks_exact_pvalue(F.col("_gap"), F.col("_nb"), F.col("_nc"))).otherwise(F.col("ks_p_asymptotic"))
    out = out.withColumn("ks_p_value", exact).drop("_gap", "_nb", "_nc", "_z")
    return out.drop("_g") if synthetic else out


def alert_level(psi_col, p_col) -> F.Column:
    level = F.lit("low")
    for name, psi_above, p_below in reversed(ALERTS):
        level = F.when((psi_col > psi_above) | (p_col < p_below), F.lit(name)).otherwise(level)
    return level


def drift_report(sides: DataFrame, group_cols=(), materialize: bool = True, bounded: bool = False) -> DataFrame:
    """PSI (both modes), KS, alert level, side means/population stds/sizes per group.

    Groups with fewer than 10 values on a side get ``alert_level = 'insufficient_data'``.
    The sides feed four aggregates; ``materialize`` cuts their lineage once
    with a reliable ``checkpoint()`` (to ``spark.checkpoint.dir``) instead of
    recomputing the positional split (and everything upstream) four times.
    ``bounded=True`` (per-group series bounded by weeks × families) uses
    group windows for the KS cumulative counts.
    """
    if materialize:
        ensure_checkpoint_dir(sides.sparkSession)
        sides = sides.checkpoint(eager=True)
    original = list(group_cols)
    work, group_cols, synthetic = _grouped(sides, original)
    side_stats = work.groupBy(*group_cols).agg(
        F.avg(F.when(F.col("side") == "baseline", F.col("value"))).alias("baseline_mean"),
        F.avg(F.when(F.col("side") == "current", F.col("value"))).alias("current_mean"),
        F.stddev_pop(F.when(F.col("side") == "baseline", F.col("value"))).alias("baseline_std"),
        F.stddev_pop(F.when(F.col("side") == "current", F.col("value"))).alias("current_std"),
        F.count(F.when(F.col("side") == "baseline", 1)).cast("bigint").alias("baseline_size"),
        F.count(F.when(F.col("side") == "current", 1)).cast("bigint").alias("current_size"),
    )
    p1 = psi(sides, original, mode="independent")
    p2 = psi(sides, original, mode="shared").withColumnRenamed("psi", "psi_shared")
    k = ks(sides, original, bounded=bounded).drop("ks_p_asymptotic")
    if synthetic:  # one-row results: attach as scalars, not by a constant-key join
        out = _attach(side_stats.drop("_g"), p1, [])
        out = _attach(out, p2, [])
        out = _attach(out, k, [])
    else:
        out = side_stats.join(p1, group_cols, "left").join(p2, group_cols, "left").join(k, group_cols, "left")
    enough = (F.col("baseline_size") >= MIN_SIDE_ROWS) & (F.col("current_size") >= MIN_SIDE_ROWS)
    return out.withColumn(
        "alert_level", F.when(enough, alert_level(F.col("psi"), F.col("ks_p_value"))).otherwise(F.lit("insufficient_data"))
    )


# ---------------------------------------------------------------- histograms and boxes


def histogram_compare(sides: DataFrame, bins: int = 30, group_cols=()) -> DataFrame:
    """Counts of both sides over shared equal-width bins."""
    sides, group_cols, synthetic = _grouped(sides, group_cols)
    rng = sides.groupBy(*group_cols).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    same = F.col("_hi") == F.col("_lo")
    rng = rng.withColumns(
        {"_lo": F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo")), "_hi": F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi"))}
    )
    keyed = _attach(sides, rng.drop("_g"), []) if synthetic else join_small(sides, rng, group_cols)
    raw = F.floor((F.col("value") - F.col("_lo")) * (F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))))
    b = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = keyed.groupBy(*group_cols, b.alias("bin")).agg(
        F.count(F.when(F.col("side") == "baseline", 1)).cast("bigint").alias("n_baseline"),
        F.count(F.when(F.col("side") == "current", 1)).cast("bigint").alias("n_current"),
    )
    spine = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    out = spine.join(counts, [*group_cols, "bin"], "left")
    return out.select(
        *[c for c in group_cols if not synthetic],
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce("n_baseline", F.lit(0).cast("bigint")).alias("n_baseline"),
        F.coalesce("n_current", F.lit(0).cast("bigint")).alias("n_current"),
    )


def box_summary(sides: DataFrame, group_cols=()) -> DataFrame:
    """Min, Q1, median, Q3, max per side (exact, without collecting a side)."""
    group_cols = [*group_cols, "side"]
    qs = positional.exact_quantiles(sides, "value", (0.0, 0.25, 0.5, 0.75, 1.0), group_cols)
    names = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}
    return qs.groupBy(*group_cols).agg(
        *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n) for q, n in names.items()]
    )


# ---------------------------------------------------------------- data quality


def null_cell_ratio(cols) -> F.Column:
    return sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))


def volume_quality_trend(df: DataFrame, week_col: str = "week_start", last: int = 30) -> DataFrame:
    """Rows and quality (1 − null cells / cells) per week; the last ``last`` weeks, ascending."""
    cols = df.columns  # every column counts, the week too
    per_week = df.groupBy(week_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("volume"),
        F.sum(null_cell_ratio(cols)).cast("bigint").alias("_nulls"),
    )
    q = F.lit(1.0) - F.col("_nulls") / (F.col("volume") * F.lit(len(cols))).cast("double")
    # the last-N report is a top-k: the limit is the feature
    return per_week.orderBy(F.desc(week_col)).limit(last).select(week_col, "volume", q.alias("quality_score")).orderBy(week_col)


def quality_score(df: DataFrame, week_col: str = "week_start") -> DataFrame:
    """One row — rows, null cells, cells, clamped quality score and last week."""
    cols = df.columns  # every column counts, the week too
    out = df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(null_cell_ratio(cols)).cast("bigint").alias("null_cells"),
        F.max(week_col).alias("last_week"),
    )
    cells = (F.col("n_rows") * F.lit(len(cols))).cast("bigint")
    raw = F.lit(1.0) - F.try_divide(F.col("null_cells").cast("double"), cells.cast("double"))
    return out.select("n_rows", "null_cells", cells.alias("total_cells"), num.clamp(raw, *QUALITY_CLAMP).alias("quality_score"), "last_week")


# ---------------------------------------------------------------- run log


def run_trend(runs: DataFrame, created_col: str = "created", name_col: str = "run_name", last: int = 30) -> DataFrame:
    """The last ``last`` runs by creation (ties by name), returned oldest first."""
    return runs.orderBy(F.desc(created_col), F.desc(name_col)).limit(last).orderBy(created_col, name_col)


def latest_run(runs: DataFrame, created_col: str = "created", name_col: str = "run_name") -> DataFrame:
    """The newest run (top-1 by (created, name)); no row for an empty log."""
    return runs.orderBy(F.desc(created_col), F.desc(name_col)).limit(1)


def best_run(runs: DataFrame, metric: str = "mae", name_col: str = "run_name") -> DataFrame:
    """The run with the lowest metric, ties by name (top-1); no row for an empty log."""
    return runs.orderBy(F.asc(metric), F.asc(name_col)).limit(1)
