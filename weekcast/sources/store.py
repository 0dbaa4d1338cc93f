"""Dated, keyed tables on shared storage.

A "feature group" is a Parquet folder partitioned by ``run_date`` (and
optionally family); a "view" is a temp view over a column subset.  Writes
use dynamic partition overwrite so a run replaces only its own partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from ..operators.joins import join_small
from ..session import shared_path


def new_location(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint/scratch folder."""
    return shared_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def write_dated(df: DataFrame, path: str, run_date, partition_cols=("familia",), mode: str = "overwrite") -> None:
    """Write one dated snapshot, partitioned by ``run_date`` and ``partition_cols``."""
    out = df.withColumn("run_date", F.lit(run_date).cast("date"))
    cols = ["run_date", *[c for c in partition_cols if c in df.columns]]
    # rows of one partition land together, so each task writes few files; adaptive execution splits a large one
    out = out.hint("rebalance", *cols)
    (
        out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(path)
    )


def dated_schema(df: DataFrame) -> StructType:
    """Schema of a dated table written from ``df`` (``run_date`` added)."""
    return StructType([*df.schema.fields, T.StructField("run_date", T.DateType())])


def read_dated(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a dated table; an explicit schema also reads a table written from empty batches."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def read_latest(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The newest snapshot (``run_date`` = max), read with partition pruning on the date."""
    df = read_dated(spark, path, schema)
    newest = df.agg(F.max("run_date")).scalar()
    return df.where(F.col("run_date") == newest)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace or append a table."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def upsert_latest(current: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """Keyed insert — for each key the incoming row wins over the stored one.

    ``incoming`` ∪ (stored rows whose key is not incoming).  The anti join
    broadcasts the incoming keys when the batch is small (the usual
    incremental load), so the stored table is scanned but never shuffled.
    Incoming keys must be unique (one row per key, as a batch of weeks is).
    """
    keys = list(keys)
    cols = list(current.columns)
    kept = join_small(current, incoming.select(*keys).distinct(), keys, "left_anti")
    return incoming.select(*cols).unionByName(kept.select(*cols))


def latest_of(batch: DataFrame, keys, order_cols) -> DataFrame:
    """Of the rows of a batch that repeat a key, the last in load order (a partial aggregate)."""
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order_cols))
    return batch.groupBy(*keys).agg(last.alias("_r")).select(*keys, "_r.*").select(*batch.columns)


def upsert_store(spark: SparkSession, path: str, batch: DataFrame, keys, run_date, order_cols=None) -> DataFrame:
    """Write the store's next version — the newest snapshot with the batch's rows upserted — and read it back.

    A batch that repeats keys needs ``order_cols`` (its load order).
    """
    schema = dated_schema(batch)
    current = read_latest(spark, path, schema).drop("run_date")
    incoming = latest_of(batch, keys, order_cols) if order_cols else batch
    write_dated(upsert_latest(current, incoming, keys), path, run_date)
    return read_latest(spark, path, schema).drop("run_date")


def new_rows(incoming: DataFrame, stored: DataFrame, keys, week_col: str = "week_start") -> DataFrame:
    """Incoming rows whose key is not stored yet (anti join).

    The stored side is first cut to the incoming batch's week range (scalar
    bounds → pushed filter / partition pruning), so the anti join only sees
    the overlapping weeks.
    """
    keys = list(keys)
    if week_col in keys:
        lo = incoming.agg(F.min(week_col)).scalar()
        hi = incoming.agg(F.max(week_col)).scalar()
        stored = stored.where(F.col(week_col).between(lo, hi))
    return join_small(incoming, stored.select(*keys).distinct(), keys, "left_anti")


def profile(df: DataFrame, family_col: str = "familia", week_col: str = "week_start") -> DataFrame:
    """Rows and first/last week per family."""
    return df.groupBy(family_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.min(week_col).alias("first_week"),
        F.max(week_col).alias("last_week"),
    )


def register_view(df: DataFrame, name: str, columns=None) -> DataFrame:
    """A named view over a column subset (``select_all`` when ``columns`` is None)."""
    view = df.select(*columns) if columns else df
    view.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def batch_read(spark: SparkSession, view: str, start=None, end=None, columns=None, week_col: str = "week_start") -> DataFrame:
    """Ordered read of a view with optional date range and feature list."""
    df = spark.table(view)
    if start is not None:
        df = df.where(F.col(week_col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(week_col) <= F.lit(end).cast("date"))
    if columns:
        df = df.select(*columns)
    return df.orderBy(week_col)


def chart_data(history: DataFrame, predictions: DataFrame, family_col: str = "familia", date_col: str = "week_start") -> DataFrame:
    """History and predictions as (family, ``yyyy-MM-dd`` text, value, series) records."""

    def records(df, value_col, series):
        return df.select(
            family_col,
            F.date_format(date_col, "yyyy-MM-dd").alias("date"),
            F.col(value_col).cast("double").alias("value"),
            F.lit(series).alias("series"),
        )

    return records(history, "base_imponible", "actual").unionByName(
        records(predictions, "predicted_base_imponible", "predicted")
    )


def enforce_schema(df: DataFrame, schema: StructType, required=None) -> DataFrame:
    """Check required columns, then cast/reorder to ``schema`` (``DataFrame.to``)."""
    missing = [c for c in (required or schema.fieldNames()) if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.to(schema)


def reconcile(expected: DataFrame, processed: DataFrame, keys) -> DataFrame:
    """Keys expected but not processed, and processed but not expected (one full outer join)."""
    keys = list(keys)
    e = expected.select(*keys).distinct().withColumn("_e", F.lit(1))
    p = processed.select(*keys).distinct().withColumn("_p", F.lit(1))
    j = e.join(p, keys, "full_outer")
    status = F.when(F.col("_p").isNull(), F.lit("missing_in_processed")).when(
        F.col("_e").isNull(), F.lit("unexpected_in_processed")
    )
    return j.select(*keys, status.alias("status")).where(F.col("status").isNotNull())
