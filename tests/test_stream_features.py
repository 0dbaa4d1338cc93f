"""Features from a stateful stream equal the batch table after any split, with late lines; only changed rows are emitted."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weekcast.functions import calendar as cal
from weekcast.operators import features as batch
from weekcast.operators import rollup
from weekcast.streaming import features

SCHEMA = "fecha date, familia string, base_imponible decimal(18,4)"
MONDAY = dt.date(2024, 1, 1)


def lines(n_weeks=14, seed=4):
    rnd = random.Random(seed)
    out = []
    for f in ("A", "B", "HOT"):
        for w in range(n_weeks):
            for d in range(7):
                if f == "B" and w == 5 and d == 3:
                    continue  # an incomplete week
                out += [(MONDAY + dt.timedelta(days=7 * w + d), f, Decimal(rnd.randrange(1, 10**8)).scaleb(-4)) for _ in range(6 if f == "HOT" else 1)]
    rnd.shuffle(out)
    return out


def expected(spark, rows, lags):
    weekly = rollup.weekly_rollup(cal.add_calendar_flags(spark.createDataFrame(rows, SCHEMA)), min_days=7)
    return {(r.familia, r.week_start): tuple(r) for r in batch.feature_table(weekly, lags, 1).collect()}


def write_parts(spark, parts, folder):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("n_parts", [1, 5])
def test_any_split_equals_the_batch_table(spark, tmp_path, n_parts):
    rows = lines()
    folder = str(tmp_path / "in")
    write_parts(spark, [rows[i::n_parts] for i in range(n_parts)], folder)
    schema = spark.createDataFrame([], SCHEMA).schema
    store = features.run_feature_stream(spark, folder, schema, str(tmp_path / "store"), lags=(1, 2, 4))
    got = {(r.familia, r.week_start): tuple(r) for r in features.read_features(spark, store).select("familia", "week_start", "base_imponible", "base_imponible_lag1", "base_imponible_lag2", "base_imponible_lag4", "is_summer_peak", "is_easter", "target").collect()}
    assert got == expected(spark, rows, (1, 2, 4)) and len(got) > 20


def test_a_late_line_changes_its_rows_only(spark, tmp_path):
    rows = lines()
    folder, store, ckpt = (str(tmp_path / x) for x in ("in", "store", "ckpt"))
    schema = spark.createDataFrame([], SCHEMA).schema
    write_parts(spark, [rows], folder)
    features.run_feature_stream(spark, folder, schema, store, ckpt, lags=(1, 2, 4))
    late = [(MONDAY + dt.timedelta(days=7 * 8 + 2), "A", Decimal("5.0000")), (MONDAY + dt.timedelta(days=7 * 5 + 3), "B", Decimal("7.0000"))]
    write_parts(spark, [late], folder)
    features.run_feature_stream(spark, folder, schema, store, ckpt, lags=(1, 2, 4))
    got = {(r.familia, r.week_start): tuple(r) for r in features.read_features(spark, store).drop("batch_id").select("familia", "week_start", "base_imponible", "base_imponible_lag1", "base_imponible_lag2", "base_imponible_lag4", "is_summer_peak", "is_easter", "target").collect()}
    assert got == expected(spark, rows + late, (1, 2, 4))
    last = spark.read.parquet(store).agg(F.max("batch_id")).first()[0]
    again = {(r.familia, (r.week_start - MONDAY).days // 7) for r in spark.read.parquet(store).where(F.col("batch_id") == last).collect()}
    assert {w for f, w in again if f == "A"} == {7, 8, 9, 10, 12}  # as target, as value, as lags 1, 2 and 4
    assert "HOT" not in {f for f, _ in again}


def test_a_ring_bounds_the_state(spark, tmp_path):
    rows = sorted(lines(30))
    folder = str(tmp_path / "in")
    write_parts(spark, [rows[i : i + 400] for i in range(0, len(rows), 400)], folder)
    schema = spark.createDataFrame([], SCHEMA).schema
    store = features.run_feature_stream(spark, folder, schema, str(tmp_path / "store"), lags=(1, 2, 4), keep_weeks=8)
    got = {(r.familia, r.week_start): r.target for r in features.read_features(spark, store).collect()}
    assert got == {k: v[-1] for k, v in expected(spark, rows, (1, 2, 4)).items()}
    with pytest.raises(ValueError, match="ring"):
        features.feature_stream(spark.createDataFrame(rows, SCHEMA), lags=(1, 52), keep_weeks=50)


def test_a_stream_without_a_complete_row(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_parts(spark, [lines(2)], folder)
    store = features.run_feature_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, str(tmp_path / "store"), lags=(4,))
    assert features.read_features(spark, store, (4,)).count() == 0


def test_a_task_sums_its_lines_over_all_batches(spark):
    rows = spark.range(0, 30_000, 1, 1).selectExpr("date'2024-01-01' as fecha", "'A' as familia", "cast(1 as decimal(18,4)) as base_imponible")
    assert [tuple(r) for r in features.line_weeks(rows).select("family", "day", "total").collect()] == [("A", 1, 30_000 * 10**4)]


def test_very_many_sums_are_sent_before_the_task_ends(spark, monkeypatch):
    monkeypatch.setattr(features, "MAX_SUMS", 50)
    rows = [(MONDAY + dt.timedelta(days=i % 300), "AB"[i % 2], Decimal(i)) for i in range(1000)]
    got = {}
    for r in features.line_weeks(spark.createDataFrame(rows, SCHEMA)).collect():
        key = r.family, r.week, r.day
        got[key] = got.get(key, 0) + r.total
    want = {}
    for d, f, v in rows:
        key = f, (d - features.EPOCH).days - d.weekday(), 1 << d.weekday()
        want[key] = want.get(key, 0) + int(v) * 10**4
    assert got == want


def test_no_task_writes_or_reads_a_quarter_of_the_lines(spark, tmp_path, monkeypatch):
    from weekcast.plans import q_stream

    li = spark.range(0, 4000, 1, 8).selectExpr(
        "id as l_orderkey", "id % 10 as l_partkey", "1.0d as l_quantity", "10.0d as l_extendedprice", "0.0d as l_discount", "0.0d as l_tax", "timestamp'2024-01-01 00:00:00' as l_shipdate")
    li.write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(10).selectExpr("id as p_partkey", "'A' as p_type", "'n' as p_name").write.parquet(str(tmp_path / "part.parquet"))
    seen = {}

    def run(spark, path, schema, files_per_batch=1):
        seen.update(path=path, files=files_per_batch)

    monkeypatch.setattr(q_stream.features, "run_feature_stream", run)
    monkeypatch.setattr(q_stream.features, "read_features", lambda spark, store: None)
    q_stream.stream_features(spark, str(tmp_path))
    lines = spark.read.parquet(seen["path"])
    per_file = [r["count"] for r in lines.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 4000 and max(per_file) < 1000 and 4 * (seen["files"] - 1) < len(per_file) <= 4 * seen["files"]


def test_the_query_on_tables_without_lines(spark, tmp_path):
    from weekcast.plans import q_stream

    spark.sql("select 1L as l_orderkey, 1L as l_partkey, 1.0d as l_quantity, 10.0d as l_extendedprice, 0.0d as l_discount, 0.0d as l_tax, timestamp'2024-01-01 00:00:00' as l_shipdate").where("false").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("select 1L as p_partkey, 'A' as p_type, 'n' as p_name").write.parquet(str(tmp_path / "part.parquet"))
    assert q_stream.stream_features(spark, str(tmp_path)).count() == 0
