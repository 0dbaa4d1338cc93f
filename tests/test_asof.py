"""Point-in-time retrieval against a plain version: irregular times, ties, time to live, several groups, a hot key."""

import datetime as dt
import random

from pyspark.sql import functions as F

from weekcast.operators import asof

T0 = dt.datetime(2024, 3, 1)
HOUR = dt.timedelta(hours=1)


def plain(entities, rows, ttl):
    out = {}
    for e, key, t in entities:
        best = None
        for k, ft, order, value in rows:
            if None not in (k, ft, key, t) and k == key and ft <= t and (best is None or (ft, order) > best[:2]):
                best = ft, order, value
        out[e] = (None, None) if best is None or (ttl is not None and best[0] + dt.timedelta(seconds=ttl) < t) else (best[2], best[0])
    return out


def test_any_event_times_two_groups_and_ttl(spark):
    rnd = random.Random(2)
    when = lambda: T0 + rnd.randrange(400) * HOUR + dt.timedelta(microseconds=rnd.choice([0, 0, 1]))
    key = lambda: "hot" if rnd.random() < 0.4 else rnd.choice("abcdefg")
    entities = [(i, key(), when()) for i in range(600)] + [(600, None, when()), (601, "a", None), (602, "nobody", when())]
    price = [(key(), when(), o, rnd.random()) for o in range(300)] + [(None, T0, 1, 5.0), ("a", None, 2, 6.0)]
    stock = [(key(), when(), o, f"s{o}") for o in range(40)]
    e = spark.createDataFrame(entities, "id int, k string, at timestamp_ntz").withColumn("price_note", F.lit("own"))
    p = spark.createDataFrame(price, "k string, at timestamp_ntz, load int, v double")
    s = spark.createDataFrame(stock, "k string, seen timestamp_ntz, load int, v string").withColumnRenamed("k", "k")
    groups = [asof.FeatureGroup("price", p, ("v",), "at", "load", 50 * 3600), asof.FeatureGroup("stock", s, ("v",), "seen", "load")]
    for n in (1, 7):
        got = asof.asof_join(e, groups, ["k"], "at", n_slices=n).collect()
        assert len(got) == len(entities)
        assert {r.id: (r.price_v, r.price_time) for r in got} == plain(entities, price, 50 * 3600)
        assert {r.id: (r.stock_v, r.stock_time) for r in got} == plain(entities, stock, None)


def test_repeated_rows_and_empty_tables(spark):
    e = spark.createDataFrame([(1, "a", T0), (1, "a", T0)], "id int, k string, at timestamp_ntz")
    f = spark.createDataFrame([("a", T0, 1, 2.0), ("a", T0, 2, None)], "k string, at timestamp_ntz, load int, v double")
    g = [asof.FeatureGroup("f", f, ("v",), "at", "load")]
    assert [(r.f_v, r.f_time) for r in asof.asof_join(e, g, ["k"], "at").collect()] == [(None, T0)] * 2  # the last load is known, its value null
    none = [asof.FeatureGroup("f", f.limit(0), ("v",), "at", "load")]
    assert [r.f_time for r in asof.asof_join(e, none, ["k"], "at").collect()] == [None, None]
    assert asof.asof_join(e.limit(0), g, ["k"], "at").count() == 0


def test_a_hot_key_is_many_window_groups(spark):
    """The window's groups are slices of a key, none much above its share, and nothing joins every pair."""
    e = spark.range(5000).select(F.lit("hot").alias("k"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("at"))
    f = spark.range(500).select(F.lit("hot").alias("k"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id") * 10)).cast("timestamp_ntz").alias("at"), F.col("id").alias("v"))
    df = asof.asof_join(e, [asof.FeatureGroup("f", f, ("v",), "at")], ["k"], "at", n_slices=10)
    assert df.agg(F.sum("f_v")).first()[0] == sum(i // 10 for i in range(5000))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("_slice" in line and "_k0" in line for line in windows)
    per_slice = asof.with_slice(e.withColumn("_t", F.col("at")), asof.numeric_key(e, "at"), 10).groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert per_slice < 600
