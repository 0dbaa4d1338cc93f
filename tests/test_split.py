"""W5, W6, W7, W9 boundaries."""

import datetime as dt


from weekcast.operators import split

MON = dt.date(2024, 1, 1)


def _series(spark, n, fam="A"):
    return spark.createDataFrame([(fam, MON + dt.timedelta(weeks=i), float(i)) for i in range(n)], "familia string, week_start date, v double")


def test_temporal_split_boundary_stays_in_train(spark):
    roles = [r.role for r in split.temporal_split(_series(spark, 10), 0.8).orderBy("week_start").collect()]
    assert roles.count("train") == 9 and roles.count("test") == 1


def test_split_by_distinct_weeks(spark):
    roles = [r.role for r in split.split_by_week(_series(spark, 10), 0.8).orderBy("week_start").collect()]
    assert roles.count("train") == 8 and roles.count("test") == 2


def test_expanding_folds_sizes(spark):
    out = split.expanding_folds(_series(spark, 13), 5)
    sizes = {(r.fold, r.role): r["count"] for r in out.groupBy("fold", "role").count().collect()}
    assert [sizes[(f, "train")] for f in range(5)] == [3, 5, 7, 9, 11]
    assert all(sizes[(f, "test")] == 2 for f in range(5))


def test_latest_row(spark):
    df = _series(spark, 5).unionByName(_series(spark, 3, "B"))
    got = {r.familia: r.v for r in split.latest_row(df).collect()}
    assert got == {"A": 4.0, "B": 2.0}
