"""The keyed store with a manifest: equal to a plain upsert, few files rewritten, crash and version reads."""

import random

import pytest

from weekcast.sources import keyed, store

SCHEMA = "week int, familia string, v double"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_rewrites_the_touched_files_only(spark, tmp_path):
    path, held = str(tmp_path / "s"), {}
    rnd = random.Random(1)
    first = [(w, f, rnd.random()) for w in range(100) for f in "abcdefghij"]
    keyed.upsert(spark, path, spark.createDataFrame(first, SCHEMA), ["week", "familia"], rows_per_file=100)
    held = {(w, f): v for w, f, v in first}
    schema = spark.createDataFrame([], SCHEMA).schema
    before = {r.file: r for r in keyed.manifest(spark, path).collect()}
    assert len(before) >= 8 and sum(r.n_rows for r in before.values()) == 1000
    for weeks in ([97, 98, 99, 100, 101], [50], [200, 3]):
        batch = [(w, f, rnd.random()) for w in weeks for f in "abcz"]
        known = {r.file for r in keyed.manifest(spark, path).collect()}
        keyed.upsert(spark, path, spark.createDataFrame(batch, SCHEMA), ["week", "familia"], rows_per_file=100)
        held |= {(w, f): v for w, f, v in batch}
        now = {r.file for r in keyed.manifest(spark, path).collect()}
        assert rows_of(keyed.read(spark, path, schema)) == sorted((*k, v) for k, v in held.items())
        assert len(known - now) <= 3 < len(known & now)  # files replaced, files that stay
    assert keyed.versions(spark, path) == [0, 1, 2, 3]
    assert rows_of(keyed.read(spark, path, schema, version=0)) == sorted(first)
    part = keyed.read(spark, path, schema, low=20, high=29)
    assert part.count() == 100 and len(part.inputFiles()) < len(now) / 2
    assert keyed.vacuum(spark, path, keep_versions=1) > 0
    assert rows_of(keyed.read(spark, path, schema)) == sorted((*k, v) for k, v in held.items())


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    one = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], SCHEMA)
    keyed.upsert(spark, path, one, ["week", "familia"])
    monkeypatch.setattr(keyed, "_write", lambda rows, *a: (rows.write.parquet(f"{path}/data/torn"), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        keyed.upsert(spark, path, spark.createDataFrame([(2, "a", 9.0)], SCHEMA), ["week", "familia"])
    (tmp_path / "s" / "manifest" / "version=1").mkdir()  # a manifest without its mark
    assert rows_of(keyed.read(spark, path, one.schema)) == [(1, "a", 1.0), (2, "a", 2.0)]
    monkeypatch.undo()
    keyed.upsert(spark, path, spark.createDataFrame([(2, "a", 9.0)], SCHEMA), ["week", "familia"])
    assert rows_of(keyed.read(spark, path, one.schema)) == [(1, "a", 1.0), (2, "a", 9.0)]


def test_load_order_empty_batch_and_null_place(spark, tmp_path):
    path = str(tmp_path / "s")
    batch = spark.createDataFrame([(1, "a", 1.0, 1), (1, "a", 2.0, 2)], "week int, familia string, v double, load int")
    keyed.upsert(spark, path, store.latest_of(batch, ["week", "familia"], ["load"]).drop("load"), ["week", "familia"])
    keyed.upsert(spark, path, spark.createDataFrame([], SCHEMA), ["week", "familia"])
    assert rows_of(keyed.read(spark, path, spark.createDataFrame([], SCHEMA).schema)) == [(1, "a", 2.0)]
    with pytest.raises(ValueError, match="null week"):
        keyed.upsert(spark, path, spark.createDataFrame([(None, "a", 1.0)], SCHEMA), ["week", "familia"])
    assert keyed.read(spark, str(tmp_path / "none"), batch.schema).count() == 0
