"""Time-ordered splits.

Splits are labels (``role``/``fold`` columns), not separate DataFrames, so
one plan feeds both sides and nothing is materialised twice.  Positions are
per family (``partitionBy(family)``): a family's weekly series is bounded by
the number of weeks, so no window ever needs a global order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def temporal_split(
    df: DataFrame,
    ratio: float = 0.8,
    split_date=None,
    family_col: str = "familia",
    order_col: str = "week_start",
) -> DataFrame:
    """``role`` = train for weeks ≤ the boundary week, test after it (Q6).

    Without ``split_date`` the boundary is the row at 0-based position
    ``int(n·ratio)`` of the family's series, which therefore stays in train.
    """
    if split_date is not None:
        boundary = F.lit(split_date).cast("date")
    else:
        fam = Window.partitionBy(family_col)
        pos = F.row_number().over(Window.partitionBy(family_col).orderBy(order_col)) - 1
        n = F.count(F.lit(1)).over(fam)
        df = df.withColumns({"_pos": pos, "_n": n})
        at = F.floor(F.col("_n") * F.lit(ratio))
        boundary = F.max(F.when(F.col("_pos") == at, F.col(order_col))).over(fam)
    out = df.withColumn("role", F.when(F.col(order_col) <= boundary, F.lit("train")).otherwise(F.lit("test")))
    return out.drop("_pos", "_n")


def split_week(df: DataFrame, ratio: float = 0.8, order_col: str = "week_start") -> DataFrame:
    """One-row frame with the last training week = ``weeks[int(n·ratio) − 1]`` over distinct weeks.

    The distinct-week set is bounded by the calendar, so ranking it needs no
    partitioning.
    """
    weeks = df.select(order_col).distinct()
    ranked = weeks.withColumns(
        {"_k": F.row_number().over(Window.orderBy(order_col)), "_n": F.count(F.lit(1)).over(Window.partitionBy())}
    )
    return ranked.where(F.col("_k") == F.floor(F.col("_n") * F.lit(ratio))).select(F.col(order_col).alias("split_week"))


def split_by_week(df: DataFrame, ratio: float = 0.8, order_col: str = "week_start") -> DataFrame:
    """W6 applied: ``role`` from the distinct-week boundary (a scalar subquery)."""
    boundary = split_week(df, ratio, order_col).scalar()
    return df.withColumn("role", F.when(F.col(order_col) <= boundary, F.lit("train")).otherwise(F.lit("test")))


def expanding_folds(
    df: DataFrame,
    n_splits: int = 5,
    family_col: str = "familia",
    order_col: str = "week_start",
) -> DataFrame:
    """Expanding-window folds; test size ``n // (n_splits+1)``, train = everything before.

    Each row appears once per fold it belongs to, with ``fold`` (0-based) and
    ``role``; the expansion is at most ``n_splits``× the input.
    """
    fam = Window.partitionBy(family_col)
    pos = F.row_number().over(Window.partitionBy(family_col).orderBy(order_col)) - 1
    df = df.withColumns({"_pos": pos, "_n": F.count(F.lit(1)).over(fam)})
    test_size = F.floor(F.col("_n") / F.lit(n_splits + 1))
    df = df.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    train_end = F.col("_n") - (F.lit(n_splits) - F.col("fold")) * test_size
    role = F.when(F.col("_pos") < train_end, F.lit("train")).when(
        F.col("_pos") < train_end + test_size, F.lit("test")
    )
    return df.withColumn("role", role).where(F.col("role").isNotNull() & (test_size > 0)).drop("_pos", "_n")


def latest_row(df: DataFrame, family_col: str = "familia", order_col: str = "week_start") -> DataFrame:
    """Last row of each series, as an aggregate (``max_by``) rather than a sort."""
    rest = [c for c in df.columns if c != family_col]
    last = F.max_by(F.struct(*rest), F.col(order_col)).alias("_last")
    return df.groupBy(family_col).agg(last).select(family_col, "_last.*")
