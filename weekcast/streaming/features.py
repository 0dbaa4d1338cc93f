"""Stateful feature maintenance (T1, M9): lag features kept up to date from a stream of invoice lines.

Keyed state per family is a ring of its weeks: the exact sum of the measure,
a mask of the days seen and the flags.  A micro-batch changes some weeks;
the feature rows that differ from those before it are emitted, no others,
and upserted into a keyed store.  So after any split of the lines into
micro-batches, late ones included, the store equals the batch feature table.

Lines are summed to (family, day of a week) inside each task before they are
dealt by family, so a family with a third of the lines sends a row for each
of its days and task.  A ring of ``keep_weeks`` bounds the state: weeks that
are older than that are finished; their rows stay in the store and later
lines for them are left out (as behind a watermark).  ``None`` keeps all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import calendar as cal
from ..session import ship
from ..sources.store import new_location
from .weekly import _exists, next_batch_id, read_upserted, upsert_batch

EPOCH = dt.date(1970, 1, 1)
FULL_WEEK = 127
MAX_SUMS = 500_000  # rows a task holds before it sends them
STATE = "week array<int>, total array<bigint>, days array<int>, summer array<int>, easter array<int>"


def line_weeks(lines: DataFrame, date_col: str = "fecha", family_col: str = "familia", value_col: str = "base_imponible", scale: int = 4) -> DataFrame:
    """(family, week as days since 1970, day bit, flags, sum in units of 10**-scale), summed within each task."""
    flagged = cal.add_calendar_flags(lines, date_col) if "is_easter" not in lines.columns else lines
    d = F.col(date_col)
    rows = flagged.select(
        F.col(family_col).alias("family"), F.unix_date(F.date_sub(d, F.weekday(d))).alias("week"), F.call_function("shiftleft", F.lit(1), F.weekday(d)).alias("day"),
        F.col("is_summer_peak").cast("int").alias("summer"), F.col("is_easter").cast("int").alias("easter"), (F.col(value_col) * 10**scale).cast("bigint").alias("total"),
    )

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["family", "week", "day"]

        def summed(parts: list[pa.Table]) -> pa.Table:
            found = pa.concat_tables(parts).group_by(keys, use_threads=False).aggregate([("summer", "max"), ("easter", "max"), ("total", "sum")])
            return found.select([*keys, "summer_max", "easter_max", "total_sum"]).rename_columns([*keys, "summer", "easter", "total"])

        held, n = [], 0
        for batch in batches:
            held.append(summed([pa.Table.from_batches([batch])]))
            n += held[-1].num_rows
            if n >= MAX_SUMS:  # one sum for each key; very many keys go on as they are
                held = [summed(held)]
                if held[0].num_rows > MAX_SUMS // 2:
                    yield from held.pop().to_batches()
                n = sum(t.num_rows for t in held)
        if held:
            yield from summed(held).to_batches(100_000)

    return rows.mapInArrow(combine, "family string, week int, day int, summer int, easter int, total bigint")


def feature_rows(weeks: dict, lags, horizon: int, scale: int = 4) -> dict:
    """The complete feature rows of a family's weeks {week: [total, days, summer, easter]}: {week: values}."""
    whole = sorted(w for w, v in weeks.items() if v[1] == FULL_WEEK)
    value = [weeks[w][0] / 10**scale for w in whole]
    out = {}
    for i, w in enumerate(whole):
        if i >= max(lags, default=0) and i + horizon < len(whole):
            out[w] = (value[i], *[value[i - k] for k in lags], weeks[w][2], weeks[w][3], value[i + horizon])
    return out


def schema_of(lags) -> str:
    return "familia string, week_start date, base_imponible double, " + "".join(f"base_imponible_lag{k} double, " for k in lags) + "is_summer_peak int, is_easter int, target double"


def feature_stream(lines: DataFrame, lags=(1, 2, 3, 52), horizon: int = 1, keep_weeks: int | None = None, **columns) -> DataFrame:
    """Stream of changed feature rows (familia, week_start, base_imponible, lags, flags, target) in update mode."""
    ship(lines.sparkSession)
    lags = tuple(lags)
    if keep_weeks is not None and keep_weeks <= max(lags, default=0) + horizon:
        raise ValueError("a ring must hold more weeks than the longest lag and the horizon")
    out = schema_of(lags)
    names = [c.split()[0] for c in out.split(", ")]

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        weeks = {w: [t, d, s, e] for w, t, d, s, e in zip(*state.get)} if state.exists else {}
        before = feature_rows(weeks, lags, horizon)
        oldest = min(weeks) if keep_weeks is not None and len(weeks) >= keep_weeks else None
        for part in parts:
            for week, day, summer, easter, total in zip(part["week"].tolist(), part["day"].tolist(), part["summer"].tolist(), part["easter"].tolist(), part["total"].tolist()):
                if oldest is not None and week < oldest:  # finished
                    continue
                own = weeks.setdefault(week, [0, 0, 0, 0])
                own[0], own[1], own[2], own[3] = own[0] + total, own[1] | day, max(own[2], summer), max(own[3], easter)
        after = feature_rows(weeks, lags, horizon)
        if keep_weeks is not None:
            weeks = {w: weeks[w] for w in sorted(weeks)[-keep_weeks:]}
        state.update(tuple([list(c) for c in zip(*[(w, *v) for w, v in sorted(weeks.items())])] or [[]] * 5))
        changed = [(key[0], EPOCH + dt.timedelta(days=w), *row) for w, row in after.items() if before.get(w) != row]
        yield pd.DataFrame(changed, columns=names)

    grouped = line_weeks(lines, **columns).groupBy("family")
    return grouped.applyInPandasWithState(update, out, STATE, "update", GroupStateTimeout.NoTimeout)


def run_feature_stream(spark: SparkSession, source: str, schema, store_path: str | None = None, checkpoint: str | None = None, files_per_batch: int = 1, **how) -> str:
    """Run to completion over the files of ``source``, a few a micro-batch; returns the store (see ``read_features``)."""
    store_path = store_path or new_location(spark, "feature-store")
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (
        feature_stream(lines, **how)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint or new_location(spark, "feature-ckpt"))
        .foreachBatch(upsert_batch(store_path, ("familia", "week_start"), first_id=next_batch_id(spark, store_path)))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store_path


def read_features(spark: SparkSession, store_path: str, lags=(1, 2, 3, 52)) -> DataFrame:
    """The newest row of every family and week; a stream without a complete row has written no store yet."""
    if not _exists(spark, store_path):
        return spark.createDataFrame([], schema_of(lags))
    return read_upserted(spark, store_path, ("familia", "week_start"))
