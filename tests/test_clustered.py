"""Clustering by two columns: same rows, and each filter alone skips most row groups."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from weekcast.plans import views
from weekcast.sources import clustered

from given_core import SF_CHECK


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "lines")
    df = views.sales(spark, SF_CHECK).where("total is not null")
    clustered.write_clustered(df, path, rows_per_file=3000, row_group_bytes=32 << 10)
    return df, path


def _groups(path, column):
    """(least, greatest) of a column in every row group, from the footers."""
    out = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            at = [group.column(i).path_in_schema for i in range(group.num_columns)].index(column)
            stats = group.column(at).statistics
            out.append((stats.min, stats.max))
    return out


def _rows_read(df):
    """Rows that the scan hands on, after row groups and pages are skipped."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_each_filter_alone_skips_most_row_groups(lines):
    _, path = lines
    days, families = _groups(path, "fecha"), _groups(path, "familia")
    assert len(days) >= 16
    start, end = dt.date(1995, 6, 1), dt.date(1995, 9, 30)
    assert sum(lo <= end and start <= hi for lo, hi in days) < 0.4 * len(days)
    assert sum(lo <= "PROMO" <= hi for lo, hi in families) < 0.5 * len(families)


def test_scans_return_the_same_rows_and_read_few(spark, lines):
    df, path = lines
    n = df.count()
    invoice = df.groupBy("n_factura").count().orderBy(F.desc("count"), "n_factura").first()[0]
    for given, where, share in (
        ({"start": "1995-06-01", "end": "1995-09-30"}, "fecha between '1995-06-01' and '1995-09-30'", 0.4),
        ({"families": ["PROMO"]}, "familia = 'PROMO'", 0.5),
        ({"invoices": [invoice]}, f"n_factura = '{invoice}'", 0.25),
        ({}, "true", 1.0),
    ):
        found = clustered.scan(spark, path, **given)
        assert found.columns == df.columns
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.where(where).collect()))
        assert _rows_read(found) <= share * n


def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    got = {(r.a, r.b): r.z for r in rows.withColumn("z", clustered.interleaved([F.col("a"), F.col("b")], 3)).collect()}
    for (a, b), z in got.items():
        assert z == int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}")), 2)
    with pytest.raises(ValueError):
        clustered.interleaved([F.col("a")] * 4, 16)


def test_nulls_hot_cells_and_empty_tables(spark, tmp_path):
    day = dt.date(2000, 1, 1)
    given = [(day, "HOT", str(i)) for i in range(900)] + [(None, None, None), (None, "B", "x"), (day, None, "y"), (dt.date(2000, 1, 2), "A", None)]
    df = spark.createDataFrame(given, "fecha date, familia string, n_factura string")
    clustered.write_clustered(df, str(tmp_path / "a"), rows_per_file=200)
    back = spark.read.parquet(str(tmp_path / "a"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, back.collect())) == sorted(map(key, given))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(str(tmp_path / "a" / "*.parquet"))]
    assert max(sizes) < 450  # one day of one family holds nearly all rows and is cut by its invoices
    clustered.write_clustered(df.limit(0), str(tmp_path / "b"))
    assert clustered.scan(spark, str(tmp_path / "b"), families=["A"]).count() == 0
