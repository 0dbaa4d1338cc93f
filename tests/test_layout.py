"""Sketches, bucketed tables: results and plans."""

from pyspark.sql import functions as F

from weekcast.functions import calendar as cal
from weekcast.operators import rollup, sketches
from weekcast.plans import views
from weekcast.sources import bucketed

from given_core import SF_SMALL


def test_sketches_merge_over_any_range_and_read_no_lines(spark, tmp_path):
    lines = views.sales(spark, SF_SMALL).select("fecha", "familia", "n_factura", "base_imponible")
    path = str(tmp_path / "sketches")
    daily = sketches.daily_sketches(lines, ["base_imponible"], ["n_factura"])
    daily.where("fecha < '1996-01-01'").write.parquet(path)
    daily.where("fecha >= '1996-01-01'").write.mode("append").parquet(path)  # later days are appended
    stored = spark.read.parquet(path)
    found = sketches.profile(stored, ["base_imponible"], ["n_factura"], "1995-06-01", "1996-06-30")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sketches" in found.inputFiles()[0] and "Join" not in plan and all("lineitem" not in f for f in found.inputFiles())
    exact = lines.where("fecha between '1995-06-01' and '1996-06-30'").groupBy("familia").agg(
        F.count(F.lit(1)).alias("n"), F.min("base_imponible").cast("double").alias("lo"), F.count_distinct("n_factura").alias("d"),
        F.percentile(F.col("base_imponible").cast("double"), F.lit(0.5)).alias("mid"),
    )
    for r in found.join(exact, "familia").collect():
        assert (r.n_rows, r.base_imponible_nulls, r.base_imponible_min) == (r.n, 0, r.lo)
        assert abs(r.n_factura_distinct - r.d) <= 0.06 * r.d + 1 and abs(r.base_imponible_q50 - r.mid) < 0.1 * r.mid
        assert r.base_imponible_high_fence > r.base_imponible_q75
    assert sketches.profile(stored, ["base_imponible"], by=(), start="2050-01-01").first().n_rows is None


def test_bucketed_join_shuffles_nothing(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = bucketed.bucketed_lines(spark, SF_SMALL, buckets=4)
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
        got = rollup.weekly_rollup(cal.add_calendar_flags(lines), min_days=1)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, views.weekly(spark, SF_SMALL, 1).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
