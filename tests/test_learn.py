"""M2–M5, M11, S19 on the sf0.01 feature table with tiny models (fast)."""

import pytest
from pyspark.sql import functions as F

from weekcast.operators import features, learn, split
from weekcast.plans import views

from given_core import SF_CHECK


def _data(spark):
    ft = features.feature_table(views.weekly(spark, SF_CHECK, 7), (1, 2, 3, 52), horizon=1)
    return split.split_by_week(ft, 0.8)


def test_grid_search_on_expanding_folds(spark):
    ft = _data(spark).drop("role")
    folds = split.expanding_folds(ft, 3)
    grid = {"maxIter": [2], "maxDepth": [2, 3]}
    out = learn.grid_search(folds, grid).collect()
    assert len(out) == 2 and all(r.n_folds == 3 for r in out)
    assert out[0].mean_mae <= out[1].mean_mae


def test_random_search_and_importance_and_roundtrip(spark, tmp_path):
    labelled = _data(spark)
    train, test = labelled.where("role = 'train'"), labelled.where("role = 'test'")
    small = {**learn.RANDOM_RANGES, "maxIter": (2, 3), "maxDepth": (2, 3)}
    trials = learn.random_search(train.drop("role"), n_trials=2, ranges=small)
    trials = trials.collect()
    assert len(trials) == 2
    model = learn.fit(train, learn.regressor("gbt", maxIter=3, maxDepth=2))
    imp = learn.permutation_importance(model, test).collect()
    assert {r.feature for r in imp} == set(learn.feature_columns(train))
    path = str(tmp_path / "model")
    learn.save(model, path)
    a = learn.score(model, test).orderBy("familia", "week_start").collect()
    b = learn.score(learn.load(path), test).orderBy("familia", "week_start").collect()
    assert [r.predicted for r in a] == [r.predicted for r in b]


def test_bakeoff_linear_models(spark):
    labelled = _data(spark)
    train, test = labelled.where("role = 'train'"), labelled.where("role = 'test'")
    out = learn.bakeoff(train, test, kinds=("linear", "ridge", "lasso"))
    assert out.select("model").distinct().count() == 3
    assert out.where(F.col("mae").isNull()).count() == 0


def test_same_model_whatever_the_input_partitions(spark):
    train = _data(spark).where("role = 'train'").drop("role")
    gbt = learn.regressor("gbt", maxIter=3, maxDepth=3, subsamplingRate=0.5)
    one, four = (learn.fit(train.repartition(n), gbt) for n in (1, 4))
    a, b = ({(r.familia, r.week_start): r.predicted for r in learn.score(m, train).collect()} for m in (one, four))
    assert a == b


def test_rows_with_a_null_feature_stay_without_a_prediction(spark):
    train = _data(spark).where("role = 'train'").drop("role")
    model = learn.fit(train, learn.regressor("linear"))
    holed = train.withColumn("base_imponible_lag1", F.when(F.col("familia") != "ECONOMY", F.col("base_imponible_lag1")))
    out = learn.score(model, holed)
    assert out.count() == train.count()
    assert out.where("predicted is null").count() == train.where("familia = 'ECONOMY'").count() > 0
    with pytest.raises(ValueError, match="null feature"):
        learn.fit(holed, learn.regressor("linear"))


def test_permutation_moves_two_rows(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 5.0), ("a", 2, 9.0, 5.0)], "familia string, week_start int, x double, target double")
    by_x = lambda rows: rows.select("familia", F.col("target").alias("actual"), F.col("x").alias("predicted"))
    moved = {}

    def predict(rows):
        moved.setdefault("rows", []).append([(r.week_start, r.x) for r in rows.orderBy("week_start").collect()])
        return by_x(rows)

    learn.permutation_importance(None, df, features=["x"], predict=predict).collect()
    assert moved["rows"][-1] == [(1, 9.0), (2, 1.0)]
