"""S12, J6, J8, join_small: keyed store semantics on micro tables."""

import datetime as dt

from pyspark.sql import functions as F

from weekcast.operators.joins import join_small
from weekcast.sources import store

MON = dt.date(2024, 1, 1)
SCHEMA = "familia string, week_start date, v double"


def _rows(spark, items):
    return spark.createDataFrame([(f, MON + dt.timedelta(weeks=w), v) for f, w, v in items], SCHEMA)


def test_upsert_incoming_wins_and_keeps_the_rest(spark):
    old = _rows(spark, [("A", 0, 1.0), ("A", 1, 2.0), ("B", 0, 3.0)])
    new = _rows(spark, [("A", 1, 20.0), ("A", 2, 30.0)])
    got = {(r.familia, r.week_start): r.v for r in store.upsert_latest(old, new, ["familia", "week_start"]).collect()}
    assert got == {("A", MON): 1.0, ("A", MON + dt.timedelta(weeks=1)): 20.0,
                   ("A", MON + dt.timedelta(weeks=2)): 30.0, ("B", MON): 3.0}


def test_new_rows_only_unstored_keys(spark):
    old = _rows(spark, [("A", 0, 1.0), ("A", 1, 2.0)])
    new = _rows(spark, [("A", 1, 9.0), ("A", 2, 9.0), ("B", 1, 9.0)])
    got = sorted((r.familia, r.week_start) for r in store.new_rows(new, old, ["familia", "week_start"]).collect())
    assert got == [("A", MON + dt.timedelta(weeks=2)), ("B", MON + dt.timedelta(weeks=1))]


def test_reconcile_both_directions(spark):
    expected = _rows(spark, [("A", 0, 0.0), ("A", 1, 0.0)])
    processed = _rows(spark, [("A", 1, 0.0), ("A", 2, 0.0)])
    got = {r.week_start: r.status for r in store.reconcile(expected, processed, ["familia", "week_start"]).collect()}
    assert got == {MON: "missing_in_processed", MON + dt.timedelta(weeks=2): "unexpected_in_processed"}


def test_join_small_broadcasts_only_under_the_bound(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k")
    plan_small = join_small(big, small, "k")._jdf.queryExecution().executedPlan().toString()
    plan_over = join_small(big, small, "k", max_bytes=5)
    assert "Broadcast" in plan_small
    assert plan_over.count() == 1000 and join_small(big, small, "k").count() == 1000


def test_upsert_store_keeps_the_last_loaded_row(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "familia string, week_start int, v int, loaded int"
    store.write_dated(spark.createDataFrame([("a", 1, 1, 0), ("b", 1, 2, 0)], schema), path, "2024-01-01")
    batch = spark.createDataFrame([("a", 1, 5, 1), ("a", 1, 6, 2), ("c", 1, 7, 1)], schema)
    out = store.upsert_store(spark, path, batch, ["familia", "week_start"], "2024-01-08", order_cols=["loaded"])
    assert sorted((r.familia, r.v) for r in out.collect()) == [("a", 6), ("b", 2), ("c", 7)]


def test_history_union_keeps_the_whole_archive(spark):
    import datetime

    from weekcast.sources import tables

    old = spark.createDataFrame([(datetime.date(2020, 1, 1),), (datetime.date(2024, 1, 1),), (None,)], "fecha date")
    assert tables.history_union(old, old, "2023-01-01").count() == 4
    assert tables.history_union(old, old, "2023-01-01", cut_archive=True).count() == 2
