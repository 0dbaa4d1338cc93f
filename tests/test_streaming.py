"""Incremental arrival, late data beyond the watermark, idempotent replay."""

import datetime as dt

from weekcast.streaming import weekly

KEYS = ("week_start", "event_type")
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _ev(i, ts, kind, value):
    return (i, ts, 1, kind, value, "{}")


def test_incremental_weeks_and_late_events(spark, tmp_path):
    src, store, ckpt = str(tmp_path / "src"), str(tmp_path / "store"), str(tmp_path / "ckpt")
    mon = dt.datetime(2024, 1, 1)
    _write(spark, src, [_ev(1, mon, "a", 1.5), _ev(2, mon + dt.timedelta(days=2), "a", 2.0), _ev(3, mon + dt.timedelta(days=8), "a", 4.0)])
    weekly.run_weekly_stream(spark, src, store, ckpt, keys=KEYS, watermark="1 day")
    first = {r.week_start: (r.n_events, float(r.total_value), r.active_days) for r in weekly.read_upserted(spark, store, KEYS).collect()}
    assert first == {dt.date(2024, 1, 1): (2, 3.5, 2), dt.date(2024, 1, 8): (1, 4.0, 1)}

    # second file: one on-time event in week 2, one event far behind the watermark
    _write(spark, src, [_ev(4, mon + dt.timedelta(days=9), "a", 1.0), _ev(5, mon + dt.timedelta(days=1), "a", 100.0)])
    weekly.run_weekly_stream(spark, src, store, ckpt, keys=KEYS, watermark="1 day")
    second = {r.week_start: (r.n_events, float(r.total_value), r.active_days) for r in weekly.read_upserted(spark, store, KEYS).collect()}
    assert second[dt.date(2024, 1, 8)] == (2, 5.0, 2)  # updated in place (upsert)
    assert second[dt.date(2024, 1, 1)] == (2, 3.5, 2)  # the late event was dropped

    # replay everything from a fresh checkpoint: nothing new is stored
    before = weekly.read_upserted(spark, store, KEYS).count()
    weekly.run_weekly_stream(spark, src, store, str(tmp_path / "ckpt2"), keys=KEYS, only_new=True)
    after = {r.week_start: float(r.total_value) for r in weekly.read_upserted(spark, store, KEYS).collect()}
    assert len(after) == before and after[dt.date(2024, 1, 8)] == 5.0


def test_a_week_in_two_runs_keeps_both(spark, tmp_path):
    src, store, ckpt = str(tmp_path / "src"), str(tmp_path / "store"), str(tmp_path / "ckpt")
    mon = dt.datetime(2024, 1, 1)
    for i, value in ((1, 1.0), (2, 10.0)):
        _write(spark, src, [_ev(i, mon + dt.timedelta(hours=i), "a", value)])
        weekly.run_weekly_stream(spark, src, store, ckpt, keys=KEYS, only_new=True)
    rows = weekly.read_upserted(spark, store, KEYS).collect()
    assert [(r.n_events, float(r.total_value)) for r in rows] == [(2, 11.0)]
    small = weekly.compact(spark, store, KEYS, str(tmp_path / "compact"))
    assert [(r.n_events, float(r.total_value)) for r in weekly.read_upserted(spark, small, KEYS).collect()] == [(2, 11.0)]
