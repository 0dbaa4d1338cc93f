"""W1, J10, W2, W4, M9, J11, J12 on micro tables."""

import datetime as dt


from weekcast.operators import features

MON = dt.date(2024, 1, 1)


def _weeks(spark, idx, values=None):
    values = values or [float(i * 10) for i in idx]
    rows = [("A", MON + dt.timedelta(weeks=i - 1), v, 0, 0) for i, v in zip(idx, values)]
    return spark.createDataFrame(rows, "familia string, week_start date, base_imponible double, is_summer_peak int, is_easter int")


def test_positional_vs_calendar_lag_with_missing_week(spark):
    df = _weeks(spark, [1, 2, 4, 5])
    pos = {r.week_start: r.base_imponible_lag1 for r in features.lags_positional(df, (1,)).collect()}
    cal = {r.week_start: r.base_imponible_lag1 for r in features.lags_calendar(df, (1,)).collect()}
    wk4 = MON + dt.timedelta(weeks=3)
    assert pos[wk4] == 20.0  # week 2's value
    assert cal[wk4] is None  # week 3 is missing


def test_modes_agree_without_gaps(spark):
    df = _weeks(spark, list(range(1, 11)))
    a = features.lags_positional(df, (1, 2, 3)).orderBy("week_start").collect()
    b = features.lags_calendar(df, (1, 2, 3)).orderBy("week_start").collect()
    assert [r.asDict() for r in a] == [r.asDict() for r in b]


def test_feature_table_drops_incomplete_and_targets_next_week(spark):
    df = _weeks(spark, list(range(1, 8)))
    ft = features.feature_table(df, (1, 2), horizon=1).orderBy("week_start").collect()
    assert len(ft) == 4  # weeks 3..6 have lag2 and a next week
    assert ft[0].base_imponible_lag1 == 20.0 and ft[0].target == 40.0
    aligned = features.feature_table(df, (1,), horizon=0).orderBy("week_start").first()
    assert aligned.target == aligned.base_imponible


def test_rolling_mean_centered(spark):
    df = spark.createDataFrame([("A", i, float(i)) for i in (1, 2, 3, 4)], "familia string, fecha int, v double")
    out = features.rolling_mean_centered(df, "v", 3, order_col="fecha").orderBy("fecha").collect()
    assert [r.v_rolling for r in out] == [None, 2.0, 3.0, None]


def test_next_week_and_availability(spark):
    df = _weeks(spark, [1, 2, 4])
    nxt = features.next_week_features(df, (1, 2, 3)).first()
    assert nxt.week_start == MON + dt.timedelta(weeks=4)
    assert (nxt.base_imponible_lag1, nxt.base_imponible_lag2, nxt.base_imponible_lag3) == (40.0, None, 20.0)
    assert nxt.missing_lags == 1
    av = {r.lag: r.available for r in features.lag_availability(df, (1, 2, 3)).collect()}
    assert av == {1: True, 2: False, 3: True}


def test_asof_picks_latest_week_on_or_before(spark):
    wk = _weeks(spark, [1, 3]).select("familia", "week_start", "base_imponible")
    ents = spark.createDataFrame(
        [("A", MON - dt.timedelta(days=1)), ("A", MON + dt.timedelta(days=9)), ("A", MON + dt.timedelta(days=40))],
        "familia string, fecha date",
    )
    got = {r.fecha: r.f_base_imponible for r in features.asof_weekly(ents, wk, available_after_days=0).collect()}
    assert got[MON - dt.timedelta(days=1)] is None
    assert got[MON + dt.timedelta(days=9)] == 10.0  # week 2 missing → week 1
    assert got[MON + dt.timedelta(days=40)] == 30.0
