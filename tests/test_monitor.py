"""A12, A22–A25, quantiles, global ordering helpers."""

import math

from pyspark.sql import functions as F

from weekcast.functions import numeric as num
from weekcast.operators import monitor, positional


def _sides(spark, base, cur):
    rows = [("baseline", float(v)) for v in base] + [("current", float(v)) for v in cur]
    return spark.createDataFrame(rows, "side string, value double")


def test_single_value_has_no_drift(spark):
    s = _sides(spark, [5] * 20, [5] * 10)
    assert monitor.psi(s).first().psi == 0.0
    k = monitor.ks(s).first()
    assert k.ks_statistic == 0.0 and k.ks_p_value == 1.0


def test_psi_matches_numpy_formula(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    base, cur = rng.normal(0, 1, 300), rng.normal(0.5, 1.2, 120)

    def ref(e, a):
        ep = np.histogram(e, bins=10)[0] / len(e)
        ap = np.histogram(a, bins=10)[0] / len(a)
        ep = np.where(ep == 0, 0.0001, ep)
        ap = np.where(ap == 0, 0.0001, ap)
        return float(np.sum((ap - ep) * np.log(ap / ep)))

    got = monitor.psi(_sides(spark, base, cur)).first().psi
    assert math.isclose(got, ref(base, cur), rel_tol=1e-9)


def test_ks_statistic_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    base, cur = rng.integers(0, 30, 200), rng.integers(5, 40, 90)
    xs = np.union1d(base, cur)
    d = max(abs((base <= x).mean() - (cur <= x).mean()) for x in xs)
    got = monitor.ks(_sides(spark, base, cur)).first().ks_statistic
    assert math.isclose(got, d, rel_tol=1e-12)


def test_exact_quantiles_and_constant_corr(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    q = {r.q: r.value for r in positional.exact_quantiles(df, "v", (0.25, 0.75)).collect()}
    assert q == {0.25: 1.75, 0.75: 3.25}
    c = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "x double, y double").agg(num.safe_corr("x", "y").alias("c"))
    assert c.first().c is None


def test_global_position_is_a_permutation_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    out = positional.global_position(df, ["k"], n_slices=7)
    assert out.where(F.col("_pos") != F.col("k")).count() == 0


def test_running_sums_by_group(spark):
    df = spark.createDataFrame([(g, float(i), 1) for g in ("a", "b") for i in range(100)], "g string, v double, c int")
    out = positional.running_sums(df, ["g"], "v", ["c"], n_slices=5)
    assert out.where(F.col("cum_c") != F.col("v") + 1).count() == 0


def test_alert_levels(spark):
    df = spark.createDataFrame([(0.3, 0.5), (0.05, 0.03), (0.01, 0.5)], "psi double, p double")
    levels = [r.a for r in df.select(monitor.alert_level(F.col("psi"), F.col("p")).alias("a")).collect()]
    assert levels == ["high", "medium", "low"]


def test_raw_iqr_equals_percentile(spark):
    from weekcast.operators import explore
    from weekcast.plans import views

    from given_core import SF_CHECK

    daily = views.daily(spark, SF_CHECK)
    a = {r.familia: (round(r.q1, 6), round(r.q3, 6)) for r in explore.iqr_bounds(daily).collect()}
    b = {r.familia: (round(r.q1, 6), round(r.q3, 6)) for r in explore.iqr_bounds(daily, raw=True).collect()}
    assert a == b


def test_five_thousand_slices(spark):
    df = spark.range(20_000).withColumn("v", (F.col("id") * 7919 % 20_011).cast("double"))
    out = positional.with_slice(df, F.col("v"), n_slices=5000)
    found = out.agg(F.min("_slice").alias("lo"), F.max("_slice").alias("hi"), F.countDistinct("_slice").alias("n")).first()
    assert found.lo == 0 and found.n > 3000 and found.hi >= found.n - 1
    ordered = [r._slice for r in out.orderBy("v").select("_slice").collect()]
    assert ordered == sorted(ordered)


def test_quality_counts_every_column(spark):
    df = spark.createDataFrame([("2024-01-01", 1, None), ("2024-01-01", 2, 3)], "week_start string, a int, b int")
    assert abs(monitor.volume_quality_trend(df).first().quality_score - (1 - 1 / 6)) < 1e-12


def test_trends_are_oldest_first(spark):
    df = spark.createDataFrame([(w, 1) for w in "bacd"], "week_start string, a int")
    assert [r.week_start for r in monitor.volume_quality_trend(df, last=3).collect()] == ["b", "c", "d"]
    runs = spark.createDataFrame([(i, f"r{i}") for i in (2, 0, 1)], "created int, run_name string")
    assert [r.created for r in monitor.run_trend(runs, last=2).collect()] == [1, 2]


def test_exact_ks_equals_every_order(spark):
    """All interleavings of two samples, for sizes up to 8."""
    import itertools

    def statistic(first, m, n):
        i = j = worst = 0
        for t in range(m + n):
            i, j = (i + 1, j) if t in first else (i, j + 1)
            worst = max(worst, abs(i * n - j * m))
        return worst

    rows, want = [], {}
    for m, n in [(1, 1), (2, 5), (5, 2), (4, 4), (7, 3), (8, 8), (8, 5), (1, 8)]:
        gaps = [statistic(set(c), m, n) for c in itertools.combinations(range(m + n), m)]
        for gap in sorted({*gaps, 0}):
            rows.append((gap, m, n))
            want[gap, m, n] = sum(g >= gap for g in gaps) / len(gaps)
    df = spark.createDataFrame(rows, "gap bigint, m bigint, n bigint")
    for r in df.withColumn("p", monitor.ks_exact_pvalue(F.col("gap"), F.col("m"), F.col("n"))).collect():
        assert abs(r.p - want[r.gap, r.m, r.n]) < 1e-12, r


def test_exact_ks_up_to_the_limit_then_asymptotic(spark, monkeypatch):
    monkeypatch.setattr(monitor, "KS_EXACT_MAX", 30)
    rows = [("a", "baseline", float(i)) for i in range(30)] + [("a", "current", i + 7.5) for i in range(20)]
    rows += [("b", "baseline", float(i)) for i in range(31)] + [("b", "current", i + 7.5) for i in range(20)]
    rows += [("c", s, 1.0) for s in ("baseline", "current")]
    got = {r.g: r for r in monitor.ks(spark.createDataFrame(rows, "g string, side string, value double"), ["g"], bounded=True).collect()}
    assert got["a"].ks_p_value != got["a"].ks_p_asymptotic and abs(got["a"].ks_p_value - got["a"].ks_p_asymptotic) < 0.1
    assert got["b"].ks_p_value == got["b"].ks_p_asymptotic
    assert got["c"].ks_p_value == 1.0


def test_slices_follow_the_rows_and_ties_are_cut(spark, monkeypatch):
    monkeypatch.setattr(positional, "ROWS_PER_SLICE", 500)
    df = spark.range(10_000).select((F.when(F.col("id") % 3 == 0, 40).otherwise(F.col("id") % 97)).alias("ts"), (F.col("id") * 7919 % 10_007).alias("k"))
    assert positional._n_slices(df, None) == 20
    got = [(r.ts, r.k) for r in positional.global_position(df, ["ts", "k"]).orderBy("_pos").collect()]
    assert got == sorted(got)
    cut = positional._split_ties(positional.with_slice(df, F.col("ts").cast("double")), ["ts", "k"], None)
    assert cut.groupBy("_slice").count().agg(F.max("count")).first()[0] < 1500  # 3,333 rows hold one value
    small = positional.with_slice(spark.range(100).toDF("v"), F.col("v").cast("double"))
    assert small.select("_slice").distinct().count() == 1
