"""Queries: incremental weekly roll-up of the event stream (T1) and idempotent replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import store
from ..streaming import features, weekly
from . import sqltext as q
from . import views
from .catalog import query

KEYS = ("week_start", "event_type")
EVENT_WEEKS_SQL = """select cast(cast(ts as date) - cast(isodow(cast(ts as date)) - 1 as integer) as date) as week_start, event_type,
       cast(count(*) as bigint) as n_events, sum(cast(value as decimal(18,2))) as total_value,
       cast(count(distinct cast(ts as date)) as integer) as active_days
from events group by all"""


def _events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def _as_double(df):
    return df.withColumn("total_value", df.total_value.cast("double"))


@query("stream_weekly", f"select week_start, event_type, n_events, cast(total_value as double) as total_value, active_days from ({EVENT_WEEKS_SQL})")
def stream_weekly(spark, sf_dir):
    """Watermarked tumbling-week roll-up streamed into a keyed store; equals the batch roll-up."""
    path = weekly.run_weekly_stream(spark, _events_path(sf_dir), keys=KEYS)
    return _as_double(weekly.read_upserted(spark, path, KEYS))


@query("stream_replay", f"select week_start, event_type, n_events, cast(total_value as double) as total_value, active_days from ({EVENT_WEEKS_SQL})")
def stream_replay(spark, sf_dir):
    """Replaying the whole stream (fresh checkpoint) into the same store adds nothing."""
    path = weekly.run_weekly_stream(spark, _events_path(sf_dir), keys=KEYS)
    weekly.run_weekly_stream(spark, _events_path(sf_dir), store_path=path, keys=KEYS, only_new=True)
    return _as_double(weekly.read_upserted(spark, path, KEYS))


@query("stream_features", f"with {q.SALES_LINES}, {q.weekly(7)}, {q.features((1, 2, 3, 52), 1)} select * from features")
def stream_features(spark, sf_dir):
    """The feature table kept by a stateful stream over four batches of lines in no order; equals ``feature_table``."""
    lines = views.sales(spark, sf_dir).select("fecha", "familia", "n_factura", "base_imponible")
    path = store.new_location(spark, "lines")
    part = F.pmod(F.xxhash64("n_factura"), F.lit(4)).cast("int")
    # every task deals its lines to the four parts, so no task reads a quarter of all lines
    dealt = lines.withColumn("_p", part).drop("n_factura")
    dealt.write.partitionBy("_p").parquet(path)
    n_files = len(spark.read.schema(dealt.schema).parquet(path).inputFiles())
    return features.read_features(spark, features.run_feature_stream(spark, path, dealt.schema, files_per_batch=max(1, -(-n_files // 4))))
