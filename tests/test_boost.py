"""Trees, leaf values, attribution and searches against plain versions."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.operators import boost
from weekcast.operators.boost import Params

ROWS = "familia string, week_start int, x double, z double, flag int, target double"


def make_rows(n=400, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        f, x, z, flag = rnd.choice("abcd"), rnd.uniform(0, 10), rnd.gauss(0, 1), rnd.randrange(2)
        out.append((f, i, x, z, flag, {"a": 5.0, "b": 0.0, "c": -3.0, "d": 1.0}[f] + (4 if x > 6 else 0) * flag + z + rnd.gauss(0, 0.3)))
    return out


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(make_rows(), ROWS)


FEATURES = ["x", "z", "flag"]


def plain_tree(rows, pred, p, depth):
    """A tree by trying every split, as nested tuples (feature, cut, left, right) or a leaf weight."""
    soft = lambda g: (g > 0) * max(abs(g) - p.reg_alpha, 0) - (g < 0) * max(abs(g) - p.reg_alpha, 0)
    score = lambda own: soft(sum(pred[i] - rows[i][5] for i in own)) ** 2 / (len(own) + p.reg_lambda) if own else 0.0

    def grow(own, level):
        best = None
        if level < depth:
            for c, name in ((2, "x"), (3, "z"), (4, "flag"), (0, "familia")):
                for cut in sorted({rows[i][c] for i in own} if name == "familia" else {r[c] for r in rows}):
                    left = [i for i in own if (rows[i][c] == cut if name == "familia" else rows[i][c] < cut)]
                    right = [i for i in own if i not in set(left)]
                    if left and right:
                        gain = score(left) + score(right) - score(own)
                        if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-12)):
                            best = gain, name, cut, left, right
        if best is None:
            return -soft(sum(pred[i] - rows[i][5] for i in own)) / (len(own) + p.reg_lambda) * p.learning_rate
        return best[1], best[2], grow(best[3], level + 1), grow(best[4], level + 1)

    return grow(list(range(len(rows))), 0)


def walk(tree, row):
    while isinstance(tree, tuple):
        name, cut, left, right = tree
        v = row[{"familia": 0, "x": 2, "z": 3, "flag": 4}[name]]
        tree = left if (v == cut if name == "familia" else v < cut) else right
    return tree


def test_trees_equal_every_split_tried(spark):
    rows = make_rows(60)
    p = Params(n_estimators=3, max_depth=3, learning_rate=0.5, reg_lambda=0.7, reg_alpha=1.3)
    model = boost.fit(spark.createDataFrame(rows, ROWS), p, FEATURES)
    pred = [sum(r[5] for r in rows) / len(rows)] * len(rows)
    for _ in range(3):
        tree = plain_tree(rows, pred, p, 3)
        pred = [q + walk(tree, r) for q, r in zip(pred, rows)]
    got = {r.week_start: r.predicted for r in boost.score(model, spark.createDataFrame(rows, ROWS)).collect()}
    assert all(abs(got[r[1]] - q) < 1e-9 for r, q in zip(rows, pred))


@pytest.mark.parametrize("block_rows", [65_536, 50])
def test_jobs_and_tasks_grow_the_same_trees(spark, train, monkeypatch, block_rows):
    monkeypatch.setattr(boost, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(boost, "REWRITE", 2)
    p = Params(n_estimators=4, max_depth=3, subsample=0.6, colsample_bytree=0.6, reg_alpha=0.1)
    a = boost.fit(train, p, FEATURES)
    b = boost.fit(train.repartition(7), p, FEATURES, broadcast_bytes=0)
    assert a.trees == b.trees and a.base == pytest.approx(b.base)


def test_many_fits_equal_single_fits_and_errors(spark, train):
    fold = train.withColumns({"train_folds": F.when(F.col("week_start") < 300, F.array(F.lit(0), F.lit(1))).when(F.col("week_start") < 350, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
                              "test_folds": F.when(F.col("week_start") >= 350, F.array(F.lit(1))).when(F.col("week_start") >= 300, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))})
    sets = [Params(n_estimators=n, max_depth=d) for n in (2, 4) for d in (1, 3)]
    bins = boost.make_bins(train, FEATURES)
    got = boost.errors(fold, sets, 2, FEATURES, bins=bins)
    by_jobs = boost.errors(fold, sets, 2, FEATURES, bins=bins, broadcast_bytes=0)
    assert np.array(got) == pytest.approx(np.array(by_jobs), rel=1e-12)
    own = train.where("week_start < 300").withColumns({"train_folds": F.array(F.lit(0)), "test_folds": F.array().cast("array<int>")})
    for p, maes in zip(sets, got):
        done = boost._fits(boost.blocks(own, bins, 1), [(0, p, 0, ())], boost._means(own, 1), bins.offsets)[0]
        scored = boost.score(boost.Booster(bins, done.base, p, done.trees), train.where("week_start >= 300 and week_start < 350"))
        assert scored.agg(F.avg(F.abs(F.col("actual") - F.col("predicted")))).first()[0] == pytest.approx(maes[0])


def test_grid_lists_every_combination(spark, train):
    from weekcast.operators import split

    folds = split.expanding_folds(train, 3)
    out = boost.grid_search(folds, {"n_estimators": [2, 3], "max_depth": [1, 2]}, FEATURES, n_splits=3).collect()
    assert [r["rank"] for r in out] == [1, 2, 3, 4] and all(r.n_folds == 3 for r in out)
    assert [r.mean_mae for r in out] == sorted(r.mean_mae for r in out) and out[0].max_depth == 2.0


def test_model_is_stored_and_nulls_have_no_prediction(spark, train, tmp_path):
    model = boost.fit(train, Params(n_estimators=3, max_depth=2), FEATURES)
    model.save(spark, str(tmp_path / "m"))
    again = boost.Booster.load(spark, str(tmp_path / "m"))
    holed = train.withColumn("x", F.when(F.col("familia") != "a", F.col("x")))
    a, b = ({r.week_start: r.predicted for r in boost.score(m, holed).collect()} for m in (model, again))
    assert a == b and {k for k, v in a.items() if v is None} == {r.week_start for r in train.where("familia = 'a'").collect()}
    unknown = boost.score(model, train.withColumn("familia", F.lit("new")))
    assert unknown.where("predicted is null").count() == 0
    with pytest.raises(ValueError, match="null feature"):
        boost.fit(holed, Params(n_estimators=1), FEATURES)


def test_linear_booster_reaches_least_squares(spark, train):
    model = boost.fit(train, Params(n_estimators=3000, learning_rate=0.5, reg_lambda=0.0, booster="gblinear"), FEATURES)
    err = boost.score(model, train).join(train, ["familia", "week_start"]).withColumn("e", F.col("predicted") - F.col("actual"))
    for column in ("x", "z", "flag"):
        assert abs(err.agg(F.avg(F.col("e") * F.col(column))).first()[0]) < 1e-4


def expectation(t, node, bins, known, cat):
    """Path-dependent expectation of a tree for one row when only the inputs in ``known`` are known."""
    f = t.feature[node]
    if f < 0:
        return t.weight[node]
    sides = (t.left[node], t.right[node])
    if f in known:
        goes_left = bins[f] == t.bin[node] if f == cat else bins[f] <= t.bin[node]
        return expectation(t, sides[0 if goes_left else 1], bins, known, cat)
    return sum(t.cover[c] / t.cover[node] * expectation(t, c, bins, known, cat) for c in sides)


def test_attribution_equals_all_subsets(spark, train):
    from math import factorial

    model = boost.fit(train, Params(n_estimators=3, max_depth=5, learning_rate=0.5, subsample=0.8), FEATURES)
    rows = train.limit(12).collect()
    bins = model.bins.of(np.array([[r.x, r.z, r.flag] for r in rows], float), [r.familia for r in rows])
    phi, base = boost.attributions(model, bins)
    n = 4
    for i in range(len(rows)):
        for f in range(n):
            others, want = [j for j in range(n) if j != f], 0.0
            for k in range(n):
                for s in itertools.combinations(others, k):
                    more = sum(expectation(t, 0, bins[i], {*s, f}, 3) - expectation(t, 0, bins[i], set(s), 3) for t in model.trees)
                    want += factorial(k) * factorial(n - k - 1) / factorial(n) * more
            assert phi[i, f] == pytest.approx(want, abs=1e-9)
    assert base + phi.sum(axis=1) == pytest.approx(model.margins(np.array([[r.x, r.z, r.flag] for r in rows], float), [r.familia for r in rows]))


def test_model_based_draws_beat_random_draws():
    ranges = {"a": (0.0, 1.0), "b": (1e-4, 1.0, "log"), "n": (1, 50, "int"), "kind": ("u", "v", "w")}
    surface = lambda d: (d["a"] - 0.3) ** 2 + (np.log10(d["b"]) + 2) ** 2 / 4 + ((d["n"] - 12) / 50) ** 2 + (d["kind"] != "v")
    ours, random_ = [], []
    for seed in range(12):
        for found, startup in ((ours, 10), (random_, 1000)):
            search = boost.Parzen(ranges, seed, startup)
            for _ in range(40):
                d = search.draw()
                search.tell(d, surface(d))
            found.append(min(e for _, e in search.trials))
    assert np.mean(ours) < 0.6 * np.mean(random_)
    first, again = boost.Parzen(ranges, 5), boost.Parzen(ranges, 5)
    assert [first.draw() for _ in range(5)] == [again.draw() for _ in range(5)]


def test_search_table(spark, train):
    ranges = {**boost.RANGES, "n_estimators": (2, 4, "int"), "max_depth": (1, 3, "int")}
    out = boost.tpe_search(train, 13, features=FEATURES, ranges=ranges).orderBy("rank").collect()
    assert sorted(r.trial for r in out) == list(range(13)) and [r.mae for r in out] == sorted(r.mae for r in out)
    assert {r.booster for r in out} <= {"gbtree", "gblinear", "dart"}
    again = boost.tpe_search(train.repartition(5), 13, features=FEATURES, ranges=ranges).orderBy("rank").collect()
    assert [(r.trial, round(r.mae, 9)) for r in out] == [(r.trial, round(r.mae, 9)) for r in again]
