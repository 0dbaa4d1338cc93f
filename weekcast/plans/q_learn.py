"""Queries: learning jobs.

A fitted model has no SQL twin, so most checks are on what must hold for any
model: keys, actuals, which rows get a prediction, that a stored model
predicts the same, that a linear fit is at its optimum.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boost, evaluate, features, learn, split
from ..sources import store
from . import sqltext as q
from . import views
from .catalog import query

LAGS = (1, 2, 3, 52)
LAG_COLS = [f"base_imponible_lag{k}" for k in LAGS]
FLAGS = ["is_summer_peak", "is_easter"]
DIGITS = {"mae": 4, "mse": 0, "rmse": 4, "mape": 8, "mape_pct": 6, "r2": 8}

WEEKLY = f"{q.SALES_LINES}, {q.weekly(7)}"
SPLIT_SQL = f"""{WEEKLY}, {q.features(LAGS, 1)},
wk as (select week_start, row_number() over (order by week_start) as k, count(*) over () as n
       from (select distinct week_start from features)),
lsplit as (select *, case when week_start <= (select week_start from wk where k = floor(n * cast(0.8 as double))) then 'train' else 'test' end as role
           from features)"""
SERVING_SQL = f"""{WEEKLY},
nxt as (select familia, cast(max(week_start) + 7 as date) as week_start from weekly group by familia),
serving as (select n.familia, n.week_start,
  cast({" + ".join(f"cast(l{k}.base_imponible is null as integer)" for k in LAGS)} as integer) as missing_lags
  from nxt n {" ".join(f"left join weekly l{k} on l{k}.familia = n.familia and l{k}.week_start = cast(n.week_start - {7 * k} as date)" for k in LAGS)})"""


def _round(df):
    return df.withColumns({c: F.round(c, d) for c, d in DIGITS.items() if c in df.columns})


def _split(spark, sf_dir):
    """Train, test and all labelled rows of the feature table, from a written table.

    Every stage of a fit and every scoring pass reads it; it is bounded by
    weeks × families, and writing it keeps them off the raw lines.
    """
    ft = features.feature_table(views.weekly(spark, sf_dir, 7), LAGS, horizon=1)
    labelled = split.split_by_week(ft, 0.8)
    path = store.new_location(spark, "labelled")
    store.write_table(labelled, path)
    labelled = spark.read.schema(labelled.schema).parquet(path)
    return labelled.where(F.col("role") == "train"), labelled.where(F.col("role") == "test"), labelled


def _tuned_model(train):
    return boost.fit(train, boost.TUNED)


@query("train_gbt")
def train_gbt(spark, sf_dir):
    """M2 with ``pyspark.ml``: tuned boosted trees, one model for all families; test errors per family."""
    train, test, _ = _split(spark, sf_dir)
    model = learn.fit(train, learn.regressor("gbt", **learn.TUNED_GBT))
    return _round(evaluate.error_metrics(learn.score(model, test), ["familia"]))


@query("train_xgb")
def train_xgb(spark, sf_dir):
    """M2: the tuned booster with its L1/L2 penalties, row and column samples; test errors per family."""
    train, test, _ = _split(spark, sf_dir)
    return _round(evaluate.error_metrics(boost.score(_tuned_model(train), test), ["familia"]))


ROOT_FEATURES = [*LAG_COLS, *FLAGS]


@query(
    "xgb_root_gains",
    f"""with {SPLIT_SQL},
tr as (select familia, cast(target as double) as y, {", ".join(f"cast({c} as double) as {c}" for c in ROOT_FEATURES)} from lsplit where role = 'train'),
tot as (select avg(y) as base, count(*) as n, sum((y - (select avg(y) from tr)) * (y - (select avg(y) from tr))) as sse from tr),
x as (select feature, v, y from tr unpivot (v for feature in ({", ".join(ROOT_FEATURES)}))),
o as (select feature, v, row_number() over (partition by feature order by v) as k, count(*) over (partition by feature) as n from x),
cut as (select distinct feature, v as threshold from o join (select unnest(range(0, {boost.MAX_BINS})) as i) on k = greatest(1, cast(ceil(i * n / {float(boost.MAX_BINS)}) as bigint))),
side as (select c.feature, cast(null as varchar) as category, c.threshold, sum(t.base - x.y) filter (where x.v < c.threshold) as gl, count(*) filter (where x.v < c.threshold) as hl,
           sum(t.base - x.y) as g, count(*) as h from cut c join x on x.feature = c.feature, tot t group by all
  union all
  select 'familia' as feature, f.familia as category, cast(null as double) as threshold, sum(t.base - tr.y) filter (where tr.familia = f.familia), count(*) filter (where tr.familia = f.familia), sum(t.base - tr.y), count(*)
  from (select distinct familia from tr) f, tr, tot t group by all),
gains as (select feature, category, threshold, {" ".join(f"{s} power(greatest(abs({g}) - {boost.TUNED.reg_alpha!r}, 0.0), 2) / ({h} + {boost.TUNED.reg_lambda!r})" for s, g, h in (("", "gl", "hl"), ("+", "(g - gl)", "(h - hl)"), ("-", "g", "h")))} as gain
  from side where hl >= 1 and h - hl >= 1)
select feature, category, round(threshold, 4) as threshold, round(gain / sse, 9) as gain_share from gains, tot""",
)
def xgb_root_gains(spark, sf_dir):
    """M2: gain of every root split of the first tree (as a share of the squared error), from its histograms."""
    train, _, _ = _split(spark, sf_dir)
    found = boost.root_gains(train, boost.TUNED, ROOT_FEATURES)
    y = F.col("target").cast("double")
    sse = train.agg((F.var_pop(y) * F.count(F.lit(1))).alias("s")).scalar()
    return found.select("feature", "category", F.round("threshold", 4).alias("threshold"), F.round(F.col("gain") / sse, 9).alias("gain_share"))


@query("model_bakeoff")
def model_bakeoff(spark, sf_dir):
    """M3: linear, ridge, lasso, random forest (100) and boosted trees (100) on one split."""
    train, test, _ = _split(spark, sf_dir)
    return _round(learn.bakeoff(train, test))


@query(
    "linear_optimality",
    "select m.model, f.feature, 0.0 as gradient from (select unnest(['linear', 'ridge']) as model) m, "
    f"(select unnest({[*LAG_COLS, 'intercept']}) as feature) f",
)
def linear_optimality(spark, sf_dir):
    """M3: the gradient of the least-squares objective at the fitted coefficients, relative to its terms, is 0."""
    train, _, _ = _split(spark, sf_dir)
    rows, out = train.count(), None
    for kind, alpha in (("linear", 0.0), ("ridge", 1.0)):
        model = learn.fit(train, learn.regressor(kind, rows))
        names = model.stages[2].getInputCols()
        weight = dict(zip(names, model.stages[-1].coefficients.toArray().tolist()))
        scored = model.transform(train)
        err = F.col("prediction") - F.col("target")
        parts = []
        for c in [*LAG_COLS, "intercept"]:
            x = F.lit(1.0) if c == "intercept" else F.col(c)
            push = F.avg(err * x) + F.lit(alpha / rows * weight.get(c, 0.0))
            parts.append(F.struct(F.lit(c).alias("feature"), F.round(push / F.avg(F.abs(F.col("target") * x)), 4).alias("gradient")))
        one = scored.agg(F.array(*parts).alias("p")).select(F.lit(kind).alias("model"), F.explode("p").alias("p"))
        one = one.select("model", "p.feature", (F.col("p.gradient") + 0.0).alias("gradient"))
        out = one if out is None else out.unionByName(one)
    return out


@query("grid_search")
def grid_search(spark, sf_dir):
    """M4: all 72 combinations of the reference's grid over all rows and all five expanding folds, best first."""
    _, _, labelled = _split(spark, sf_dir)
    found = boost.grid_search(split.expanding_folds(labelled.drop("role"), 5))
    return found.withColumns({c: F.round(c, 4) for c in ("mean_mae", "std_mae")})


@query("random_search")
def random_search(spark, sf_dir):
    """M5: 30 model-based trials over the reference's ranges, scored on the last fifth of each family's train weeks."""
    train, _, _ = _split(spark, sf_dir)
    return boost.tpe_search(train.drop("role"), n_trials=30).withColumn("mae", F.round("mae", 4))


@query("batch_score")
def batch_score(spark, sf_dir):
    """M7: score every stored week with the tuned model (train and test rows labelled)."""
    train, _, labelled = _split(spark, sf_dir)
    return boost.score(_tuned_model(train), labelled)


@query("predict_latest")
def predict_latest(spark, sf_dir):
    """M6 (``solo_ultima``): prediction for each family's last feature row."""
    train, _, labelled = _split(spark, sf_dir)
    return boost.score(_tuned_model(train), split.latest_row(labelled))


def _predicted_store(spark, sf_dir, model):
    """(returned predictions, what the keyed store holds of them): the store's older snapshot has the rows without predictions."""
    serving = features.next_week_features(views.weekly(spark, sf_dir, 7), LAGS)
    preds = boost.score(model, serving, keys=("familia", "week_start", "missing_lags")).withColumnRenamed("predicted", "predicted_base_imponible")
    path = store.new_location(spark, "predictions")
    store.write_dated(preds.withColumn("predicted_base_imponible", F.lit(None).cast("double")), path, "2001-10-29")
    return preds, store.upsert_store(spark, path, preds, ["familia", "week_start"], "2001-11-05")


@query("weekly_prediction_job")
def weekly_prediction_job(spark, sf_dir):
    """M8: history → next-week serving rows (calendar lags, M9) → score → keyed prediction store → its newest rows.

    Every family gets a row; one with a missing lag has no prediction.
    """
    train, _, _ = _split(spark, sf_dir)
    stored = _predicted_store(spark, sf_dir, _tuned_model(train))[1]
    return stored.select("familia", "week_start", "missing_lags", "predicted_base_imponible")


@query(
    "prediction_checks",
    f"""with {SPLIT_SQL}, {SERVING_SQL.split(", ", 1)[1].split("nxt as", 1)[0] and "nxt as" + SERVING_SQL.split("nxt as", 1)[1]}
select 'rows' as what, cast(count(*) as bigint) as found from lsplit
union all select 'predicted', count(*) from lsplit
union all select 'sum of actuals', cast(round(sum(cast(target as double))) as bigint) from lsplit
union all select 'outside the range of the training target', 0
union all select 'equal features, other prediction', 0
union all select 'latest other than in the batch', 0
union all select 'latest', count(distinct familia) from lsplit
union all select 'stored other than returned', 0
union all select 'stored', count(*) from serving
union all select 'stored without prediction', count(*) from serving where missing_lags > 0
union all select 'training error not below that of the mean', 0""",
)
def prediction_checks(spark, sf_dir):
    """M6–M8: what must hold of the predictions of the batch, the latest rows and the stored week (counts of breaches)."""
    train, _, labelled = _split(spark, sf_dir)
    model = _tuned_model(train)
    batch = boost.score(model, labelled)
    path = store.new_location(spark, "batch")
    store.write_table(batch, path)
    batch = spark.read.schema(batch.schema).parquet(path)
    y = F.col("target").cast("double")
    low, high, mean = (train.agg(f(y).alias("v")).scalar() for f in (F.min, F.max, F.avg))
    slack = (high - low) * 0.25  # boosting may overshoot a little
    outside = (F.col("predicted") < low - slack) | (F.col("predicted") > high + slack)
    n = lambda df, what: df.agg(F.count(F.lit(1)).alias("found")).select(F.lit(what).alias("what"), F.col("found").cast("bigint").alias("found"))
    both = labelled.join(batch.select("familia", "week_start", "predicted"), ["familia", "week_start"])
    groups = both.groupBy("familia", *ROOT_FEATURES).agg(F.countDistinct("predicted").alias("d")).where("d > 1")
    latest = boost.score(model, split.latest_row(labelled))
    other = latest.alias("l").join(batch.alias("b"), ["familia", "week_start"]).where("l.predicted <> b.predicted")
    preds, stored = _predicted_store(spark, sf_dir, model)
    moved = stored.alias("s").join(preds.alias("p"), ["familia", "week_start"], "full").where("not (s.predicted_base_imponible <=> p.predicted_base_imponible)")
    miss = lambda p: F.avg((F.col("actual") - p) * (F.col("actual") - p))
    fitted = batch.where("role = 'train'").withColumn("mean", mean).agg(miss(F.col("predicted")).alias("m"), miss(F.col("mean")).alias("naive"))
    parts = [
        n(batch, "rows"), n(batch.where("predicted is not null"), "predicted"),
        batch.agg(F.round(F.sum("actual")).cast("bigint").alias("found")).select(F.lit("sum of actuals").alias("what"), "found"),
        n(batch.where(outside), "outside the range of the training target"), n(groups, "equal features, other prediction"), n(other, "latest other than in the batch"),
        n(latest, "latest"), n(moved, "stored other than returned"), n(stored, "stored"), n(stored.where("predicted_base_imponible is null"), "stored without prediction"),
        n(fitted.where("m >= naive"), "training error not below that of the mean"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("model_roundtrip", f"with {SPLIT_SQL} select count(*) as n_rows, 0.0 as max_difference from lsplit where role = 'test'")
def model_roundtrip(spark, sf_dir):
    """Save the fitted model to shared storage, load it, compare the predictions of the test weeks."""
    train, test, _ = _split(spark, sf_dir)
    model, path, keys = _tuned_model(train), store.new_location(spark, "model"), ["familia", "week_start"]
    model.save(spark, path)
    both = boost.score(model, test).join(boost.score(boost.Booster.load(spark, path), test).withColumnRenamed("predicted", "again").drop("actual", "role"), keys)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("predicted") - F.col("again"))).alias("max_difference"))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """M11 (re-aimed): permutation importance (MAE increase per permuted feature) on the test weeks."""
    train, test, _ = _split(spark, sf_dir)
    model = _tuned_model(train)
    out = learn.permutation_importance(None, test, features=list(model.bins.features), predict=lambda rows: boost.score(model, rows))
    return out.withColumns({c: F.round(c, 4) for c in ("permuted_mae", "base_mae", "mae_increase")})


@query(
    "feature_importance_lag1",
    f"""with {SPLIT_SQL},
pos as (select familia, target, base_imponible_lag1 as x, row_number() over (partition by familia order by week_start) - 1 as p,
               count(*) over (partition by familia) as n from lsplit where role = 'test'),
moved as (select a.target, b.x from pos a join pos b on a.familia = b.familia and b.p = (a.p + greatest(1, a.n // 2)) % a.n),
m as (select (select avg(abs(target - x)) from pos) as base, (select avg(abs(target - x)) from moved) as permuted)
select feature, round(case when feature = 'base_imponible_lag1' then permuted else base end, 4) as permuted_mae, round(base, 4) as base_mae,
       round(case when feature = 'base_imponible_lag1' then permuted - base else 0.0 end, 4) as mae_increase
from m, (select unnest({[*LAG_COLS, *FLAGS]}) as feature)""",
)
def feature_importance_lag1(spark, sf_dir):
    """Permutation importance with the previous week as the predictor: only that feature counts."""
    _, test, _ = _split(spark, sf_dir)

    def previous_week(rows):
        return rows.select("familia", "week_start", F.col("target").cast("double").alias("actual"), F.col("base_imponible_lag1").alias("predicted"))

    out = learn.permutation_importance(None, test, features=[*LAG_COLS, *FLAGS], predict=previous_week)
    return out.withColumns({c: F.round(c, 4) for c in ("permuted_mae", "base_mae", "mae_increase")})


@query("builtin_importance")
def builtin_importance(spark, sf_dir):
    """The tuned booster's own importances: mean gain of the splits on each input, as a share."""
    train, _, _ = _split(spark, sf_dir)
    found = boost.importance(_tuned_model(train))
    return spark.createDataFrame([(c, round(v, 6)) for c, v in found.items()], "feature string, importance double")  # one row per input


@query("shap_values")
def shap_values(spark, sf_dir):
    """Shapley attribution of the tuned booster's predictions, per family, test week and input."""
    train, test, _ = _split(spark, sf_dir)
    found = boost.shap(_tuned_model(train), test)
    return found.withColumns({c: F.round(c, 4) for c in ("attribution", "base_value", "predicted")})


@query(
    "shap_checks",
    f"""with {SPLIT_SQL}
select 'rows' as what, cast(count(*) * {len(ROOT_FEATURES) + 1} as bigint) as found from lsplit where role = 'test'
union all select 'weeks whose attributions and base do not add up to the prediction', 0
union all select 'inputs', {len(ROOT_FEATURES) + 1}
union all select 'base values', 1""",
)
def shap_checks(spark, sf_dir):
    """Attributions and base value add up to what the model predicts, for every row."""
    train, test, _ = _split(spark, sf_dir)
    model = _tuned_model(train)
    found = boost.shap(model, test)
    per_row = found.groupBy("familia", "week_start").agg((F.sum("attribution") + F.first("base_value")).alias("total"))
    scored = boost.score(model, test).join(per_row, ["familia", "week_start"], "left")
    wrong = scored.where("total is null or abs(total - predicted) > 1e-6 * abs(predicted)")
    one = lambda what, col: found.agg(col.cast("bigint").alias("found")).select(F.lit(what).alias("what"), "found")
    return (
        one("rows", F.count(F.lit(1)))
        .unionByName(wrong.agg(F.count(F.lit(1)).alias("found")).select(F.lit("weeks whose attributions and base do not add up to the prediction").alias("what"), "found"))
        .unionByName(one("inputs", F.countDistinct("feature")))
        .unionByName(one("base values", F.countDistinct("base_value")))
    )


@query("baseline_vs_model")
def baseline_vs_model(spark, sf_dir):
    """Test errors of the tuned model next to the naive lag-1 baseline, per family."""
    train, test, _ = _split(spark, sf_dir)
    model_preds = boost.score(_tuned_model(train), test).withColumn("model", F.lit("xgb_tuned"))
    naive = test.select(
        "familia", "week_start", F.col("target").cast("double").alias("actual"),
        F.col("base_imponible_lag1").alias("predicted"), F.lit("previous_week").alias("model"),
    )
    both = model_preds.select("familia", "week_start", "actual", "predicted", "model").unionByName(naive)
    return _round(evaluate.error_metrics(both, ["model", "familia"]))
