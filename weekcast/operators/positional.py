"""Global order without a single-partition window.

A window with no ``partitionBy`` funnels every row through one task.  The
helpers here get the same answers at any scale.  Rows are cut into
*slices* by comparing their order key with approximate quantile bounds
(one ``percentile_approx`` pass; the few bounds are pinned as literals).  Each slice
is ranked or summed on its own, and a tiny table (one row per slice and group)
carries the offsets between slices.

Slices are a pure function of the key, so the result does not depend on
the physical plan (AQE may coalesce or locally read shuffles freely), and
a recomputed task after an executor loss gives the same rows.

* ``global_position`` – 0-based rank of every row in a total order;
* ``running_sums``    – cumulative sums in order, per group;
* ``exact_quantiles`` – linear-interpolated quantiles from per-value counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_small

SLICE_ACCURACY = 10000

#: Rows that one task ranks or sums at once: the number of slices follows the data, whatever the shuffle setting.
ROWS_PER_SLICE = 5_000_000
MAX_SLICES = 100_000


def _n_slices(df: DataFrame, n: int | None) -> int:
    """Slices of a global order: the caller's number, or one for every ``ROWS_PER_SLICE`` rows (so retries agree)."""
    return int(n) if n else min(MAX_SLICES, max(1, -(-df.count() // ROWS_PER_SLICE)))


def numeric_key(df: DataFrame, col: str) -> Column:
    """A numeric, order-preserving image of a column (for slicing only)."""
    t = dict(df.dtypes)[col]
    c = F.col(col)
    if t.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if t == "date":
        return F.unix_date(c).cast("double")
    return c.cast("double")


def with_slice(df: DataFrame, key: Column, n_slices: int | None = None, name: str = "_slice") -> DataFrame:
    """Add the slice number of each row: how many quantile bounds are ≤ its key.

    The bounds (at most ``n_slices − 1`` numbers) are computed once and pinned
    as a literal array, so every later job and every retried task cuts the
    same slices.  Equal keys always share a slice; slices are balanced by the
    approximate quantiles except where one key value is itself heavy.
    """
    n = _n_slices(df, n_slices)
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    found = df.agg(F.percentile_approx(key, probs, max(SLICE_ACCURACY, 10 * n)).alias("b")).first()["b"] if n > 1 else None
    bounds = sorted({float(b) for b in (found or []) if b is not None})
    if not bounds:  # 0, but no literal: a join on a literal key would become a nested loop
        return df.withColumn(name, (F.xxhash64(key) * F.lit(0)).cast("int"))
    # one flat expression over literal arrays, in two levels: the coarse bounds choose a run of
    # fine ones, so a row compares with about 2 * sqrt(n) numbers
    step = max(1, math.isqrt(len(bounds)))
    coarse = F.array(*[F.lit(b) for b in bounds[::step]])
    runs = F.array(*[F.array(*[F.lit(b) for b in bounds[i : i + step]]) for i in range(0, len(bounds), step)])
    with_key = df.withColumn("_slice_key", key)
    run = with_key.withColumn("_slice_run", F.size(F.filter(coarse, lambda b: b <= F.col("_slice_key"))))
    inside = F.size(F.filter(F.get(runs, F.col("_slice_run") - 1), lambda b: b <= F.col("_slice_key")))
    slice_no = F.when(F.col("_slice_run") > 0, (F.col("_slice_run") - 1) * step + inside).otherwise(0)
    return run.withColumn(name, slice_no.cast("int")).drop("_slice_key", "_slice_run")


def _split_ties(sliced: DataFrame, order_cols: list[str], n_slices: int | None) -> DataFrame:
    """Cut a slice that one value of the first order column fills by the second order column.

    Such a slice begins with the value (it is a bound).  Its rows with that
    value are dealt by quantiles of the second column, the others follow;
    slice numbers stay in the order of the rows.  Few slices can be that
    large: the bounds are pinned like those of the slices.
    """
    second = order_cols[1]
    kind = dict(sliced.dtypes)[second]
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a slice
    usual = max(1, sum(r.n for r in sizes) // n_slices) if n_slices else ROWS_PER_SLICE
    large = {r["_slice"]: -(-r.n // usual) for r in sizes if r.n > 3 * usual}
    if not large or not kind.startswith(("int", "bigint", "smallint", "tinyint", "double", "float", "decimal", "date", "timestamp")):
        return sliced
    first, key = numeric_key(sliced, order_cols[0]), numeric_key(sliced, second)
    rows = sliced.where(F.col("_slice").isin(list(large)))
    heavy = {r["_slice"]: r.v for r in rows.groupBy("_slice").agg(F.min(first).alias("v")).collect()}
    n = max(large.values())
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    tied = rows.where(F.col("_slice").isin(list(heavy)) & _equals(first, heavy))
    bounds = {r["_slice"]: sorted({float(b) for b in r.b}) for r in tied.groupBy("_slice").agg(F.percentile_approx(key, probs, max(SLICE_ACCURACY, 10 * n)).alias("b")).collect() if r.b}
    sub = F.lit(0)
    for s, own in bounds.items():
        inside = F.size(F.filter(F.array(*[F.lit(b) for b in own]), lambda b: b <= key))
        sub = F.when(F.col("_slice") == s, F.when(first == heavy[s], inside).otherwise(len(own) + 1)).otherwise(sub)
    return sliced.withColumn("_slice", F.col("_slice").cast("bigint") * (n + 2) + sub)


def _equals(key: Column, by_slice: dict) -> Column:
    out = F.lit(False)
    for s, v in by_slice.items():
        if v is not None:
            out = out | ((F.col("_slice") == s) & (key == v))
    return out


def global_position(df: DataFrame, order_cols, n_slices: int | None = None, name: str = "_pos") -> DataFrame:
    """Add a 0-based position in ``order_cols`` order (a total order is assumed).

    Rank within a slice is a window partitioned by the slice; the slice
    offsets are the cumulative slice sizes (a table with one row per slice).
    """
    order_cols = list(order_cols)
    n = _n_slices(df, n_slices)
    if n == 1:  # one task's share
        return df.withColumn(name, (F.row_number().over(Window.orderBy(*order_cols)) - 1).cast("bigint"))
    sliced = with_slice(df, numeric_key(df, order_cols[0]), n)
    if len(order_cols) > 1:
        sliced = _split_ties(sliced, order_cols, n_slices)
    local = F.row_number().over(Window.partitionBy("_slice").orderBy(*order_cols)) - 1
    sliced = sliced.withColumn("_local", local)
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row per slice: bounded by the slice count, never by the data
    offsets = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    out = sliced.join(F.broadcast(offsets), "_slice")
    return out.withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint")).drop("_slice", "_local", "_offset")


def running_sums(df: DataFrame, group_cols, order_col: str, sum_cols, n_slices: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows of the same group with order ≤ this row's.

    ``order_col`` must be unique within a group (aggregate by it first).
    Slices cut the order column globally, so a group holding a third of all
    rows is spread over many slices.
    """
    group_cols = list(group_cols)
    n = _n_slices(df, n_slices)
    if n == 1:  # one task's share
        whole = Window.partitionBy(*group_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({f"cum_{c}": F.sum(c).over(whole) for c in sum_cols})
    sliced = with_slice(df, numeric_key(df, order_col), n)
    upto = Window.partitionBy("_slice", *group_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns({f"_cum_{c}": F.sum(c).over(upto) for c in sum_cols})
    totals = sliced.groupBy("_slice", *group_cols).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    prev = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (slice, group)
    offsets = totals.select(
        "_slice", *group_cols, *[F.coalesce(F.sum(f"_tot_{c}").over(prev), F.lit(0)).alias(f"_off_{c}") for c in sum_cols]
    )
    joined = join_small(local, offsets, ["_slice", *group_cols])  # one row per (slice, group)
    return joined.withColumns({f"cum_{c}": F.col(f"_cum_{c}") + F.col(f"_off_{c}") for c in sum_cols}).drop(
        "_slice", *[f"_cum_{c}" for c in sum_cols], *[f"_off_{c}" for c in sum_cols]
    )


def exact_quantiles(df: DataFrame, value_col: str, qs, group_cols=(), n_slices: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default) per group, exactly.

    Values are first counted per (group, value) — a partial aggregate, so a
    heavy value costs one row — then cumulative counts give every distinct
    value its position range.  Each group's wanted positions (2 per q) are
    attached with an equi-join on the group and matched against the ranges.
    Output: ``group…, q, value``.
    """
    group_cols = list(group_cols)
    v = F.col(value_col).cast("double")
    counts = df.where(v.isNotNull()).groupBy(*group_cols, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(counts, group_cols, "_v", ["_c"], n_slices)
    cum = cum.withColumns({"_start": F.col("cum__c") - F.col("_c"), "_end": F.col("cum__c")})
    sizes = counts.groupBy(*group_cols).agg(F.sum("_c").alias("_n")) if group_cols else counts.agg(F.sum("_c").alias("_n"))
    wanted = F.transform(
        F.array(*[F.lit(float(q)) for q in qs]),
        lambda q: F.struct(
            q.alias("q"),
            F.floor((F.col("_n") - 1) * q).alias("lo"),
            F.ceil((F.col("_n") - 1) * q).alias("hi"),
            ((F.col("_n") - 1) * q - F.floor((F.col("_n") - 1) * q)).alias("frac"),
        ),
    )
    sizes = sizes.select(*group_cols, wanted.alias("_w"))
    if group_cols:
        j = join_small(cum, sizes, group_cols)  # one row per group
    else:
        j = cum.withColumn("_w", sizes.select("_w").scalar())
    hits = j.select(
        *group_cols,
        F.explode(
            F.filter(
                F.transform(
                    "_w",
                    lambda w: F.struct(
                        w["q"].alias("q"),
                        w["frac"].alias("frac"),
                        F.when((w["lo"] >= F.col("_start")) & (w["lo"] < F.col("_end")), F.col("_v")).alias("vlo"),
                        F.when((w["hi"] >= F.col("_start")) & (w["hi"] < F.col("_end")), F.col("_v")).alias("vhi"),
                    ),
                ),
                lambda h: h["vlo"].isNotNull() | h["vhi"].isNotNull(),
            )
        ).alias("_h"),
    )
    per_q = hits.groupBy(*group_cols, F.col("_h.q").alias("q")).agg(
        F.max("_h.vlo").alias("_vlo"), F.max("_h.vhi").alias("_vhi"), F.max("_h.frac").alias("_frac")
    )
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    return per_q.select(*group_cols, "q", value.alias("value"))
