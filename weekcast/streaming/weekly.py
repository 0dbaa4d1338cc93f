"""Incremental weekly roll-up with Structured Streaming.

Events are rolled up into Monday-aligned tumbling weeks per key with a
watermark, emitted in ``update`` mode, and upserted into a log-structured
Parquet table by ``foreachBatch``: each micro-batch writes its own
``batch_id=`` folder (overwrite, so a replayed batch is idempotent), and
readers keep the newest row per key.  Distinct days per week are kept
exactly with a 7-bit day mask (``countDistinct`` is not allowed in streaming),
and sums stay DECIMAL so partial state merges are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..functions import dates
from ..sources.store import new_location, new_rows

WEEK = "7 days"
MONDAY_OFFSET = "4 days"  # the epoch is a Thursday; +4 days aligns windows on Mondays


def read_event_stream(spark: SparkSession, path: str, ts_col: str = "ts") -> DataFrame:
    """T1 source: a file stream with the batch schema.

    ``_day`` keeps the wall-clock date of the event; ``ts`` becomes a
    TIMESTAMP for the watermark (watermarks reject TIMESTAMP_NTZ).
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if path.rstrip("/").endswith(".parquet"):
        # a single table file: stream its folder, filtered to that file name
        folder, name = path.rstrip("/").rsplit("/", 1)
        stream = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        stream = reader.parquet(path)
    # the event time for windows and the watermark is the wall-clock reading
    # as a UTC instant: Monday-aligned windows then match wall-clock weeks in
    # any session time zone
    return stream.withColumn("_day", F.to_date(F.col(ts_col))).withColumn(ts_col, dates.wall_instant(ts_col))


def weekly_rollup_stream(
    events: DataFrame,
    key_col: str = "event_type",
    value_col: str = "value",
    ts_col: str = "ts",
    watermark: str = "7 days",
    value_type: str = "decimal(18,2)",
) -> DataFrame:
    """Per (Monday week, key): events, exact value sum, distinct active days.

    Weeks and days come from the event's wall-clock date, so they do not
    depend on the session time zone; the 7-day window on the timestamp is
    a grouping key only so the watermark can evict finished weeks' state.
    """
    day = F.col("_day") if "_day" in events.columns else F.to_date(F.col(ts_col))
    w = F.window(F.col(ts_col), WEEK, WEEK, MONDAY_OFFSET)
    day_bit = F.call_function("shiftleft", F.lit(1), F.weekday(day))
    agg = (
        events.withWatermark(ts_col, watermark)
        .groupBy(w.alias("w"), F.date_sub(day, F.weekday(day)).alias("week_start"), F.col(key_col))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum(F.col(value_col).cast(value_type)).alias("total_value"),
            F.bit_or(day_bit).alias("_days"),
        )
    )
    return agg.select(
        "week_start",
        key_col,
        F.col("n_events").cast("bigint").alias("n_events"),
        "total_value",
        F.bit_count("_days").cast("int").alias("active_days"),
    )


def read_upserted(spark: SparkSession, path: str, keys) -> DataFrame:
    """Current state of the log-structured table: newest batch's row per key (``max_by``)."""
    log = spark.read.option("basePath", path).parquet(path)
    rest = [c for c in log.columns if c not in keys and c != "batch_id"]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_r")).select(*keys, "_r.*")


def upsert_batch(path: str, keys, only_new: bool = False, first_id: int = 0):
    """foreachBatch sink: write micro-batch ``b`` under ``batch_id=<first_id + b>``.

    A retried micro-batch of one run rewrites its own folder (overwrite); a
    run that starts anew writes a later folder.  Readers keep the newest
    row per key, so neither duplicates a key.
    ``only_new`` (T2) first drops rows that are stored as they are (anti join
    on all columns), so a replay of old data leaves the table unchanged and
    a week that has grown since is replaced by its new totals.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the batch is read twice (emptiness, write): keep it instead of re-running the state update
        batch.persist()
        try:
            if batch.isEmpty():  # watermark-only batches write nothing
                return
            out = batch
            if only_new and _exists(spark, path):
                # anti join against the stored rows of this batch's weeks only
                out = new_rows(out, read_upserted(spark, path, keys).select(*out.columns), out.columns)
            # week folders inside the batch folder: replay's week-range filter prunes them
            part = [k for k in keys if k == "week_start"]
            writer = out.write.mode("overwrite")
            if part:
                writer = writer.partitionBy(*part)
            writer.parquet(f"{path}/batch_id={first_id + batch_id}")
        finally:
            batch.unpersist()

    return run


def compact(spark: SparkSession, path: str, keys, target: str) -> str:
    """Write the current state of the log as one batch of a new store at ``target`` (older batches are not copied)."""
    part = [k for k in keys if k == "week_start"]
    writer = read_upserted(spark, path, keys).write
    (writer.partitionBy(*part) if part else writer).parquet(f"{target}/batch_id=0")
    return target


def next_batch_id(spark: SparkSession, path: str) -> int:
    """First free batch number of a store (0 for a new store)."""
    if not _exists(spark, path):
        return 0
    top = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    return 0 if top is None else int(top) + 1


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def run_weekly_stream(
    spark: SparkSession,
    source_path: str,
    store_path: str | None = None,
    checkpoint: str | None = None,
    keys=("week_start", "event_type"),
    only_new: bool = False,
    **rollup_kwargs,
) -> str:
    """Run T1 to completion with ``Trigger.AvailableNow``; return the store path."""
    store_path = store_path or new_location(spark, "stream-store")
    checkpoint = checkpoint or new_location(spark, "stream-ckpt")
    stream = weekly_rollup_stream(read_event_stream(spark, source_path), **rollup_kwargs)
    q = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert_batch(store_path, keys, only_new, next_batch_id(spark, store_path)))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return store_path
