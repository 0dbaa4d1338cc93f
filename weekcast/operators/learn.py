"""Learning jobs on the feature table with ``pyspark.ml``.

One global model is trained for all families at once: the family enters
as a one-hot feature, so a single distributed fit replaces the reference's
per-family loop.  Scoring is ``model.transform`` (a projection), and every
error table is the grouped aggregate from ``evaluate``.

Boosted trees are ``GBTRegressor`` (squared loss).  XGBoost's L1/L2 leaf
penalties have no counterpart; row subsampling and column sampling map to
``subsamplingRate`` and ``featureSubsetStrategy``.
"""

from __future__ import annotations

import itertools
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import evaluate

SEED = 42
# The tuned booster (Optuna result of the reference).
TUNED_GBT = {
    "maxIter": 51,
    "maxDepth": 7,
    "stepSize": 0.08962161965694515,
    "subsamplingRate": 0.2068525521593345,
    "featureSubsetStrategy": "0.8857508899692184",
}
# The reference's grid (n_estimators, max_depth, learning_rate, subsample, colsample_bytree).
REFERENCE_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [3, 5, 7],
    "stepSize": [0.01, 0.1, 0.2],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "1.0"],
}
# Random-search ranges of the reference (n_trials = 30, 20 % validation tail).
RANDOM_RANGES = {
    "maxIter": (50, 300),
    "maxDepth": (2, 10),
    "stepSize": (0.01, 0.3),
    "subsamplingRate": (0.2, 1.0),
    "featureSubsetStrategy": (0.2, 1.0),
}


def feature_columns(df: DataFrame, exclude=("familia", "week_start", "target", "base_imponible", "role", "fold")) -> list[str]:
    """Model inputs: lags and flags; never the target or any ``*_next*`` column (Q5)."""
    return [c for c in df.columns if c not in exclude and "_next" not in c]


def regressor(kind: str, rows: int = 1, **params):
    """Bake-off members (M3): linear, ridge, lasso, random forest, boosted trees.

    ``rows`` (of the training set) scales the ridge penalty.
    """
    common = {"featuresCol": "features", "labelCol": "target", "predictionCol": "prediction"}
    if kind == "linear":
        return LinearRegression(regParam=0.0, **common, **params)
    if kind == "ridge":  # a penalty of 1 on the sum of squares: 1 / rows on Spark's mean, on unscaled features
        return LinearRegression(regParam=1.0 / rows, elasticNetParam=0.0, standardization=False, **common, **params)
    if kind == "lasso":
        return LinearRegression(regParam=0.1, elasticNetParam=1.0, standardization=False, **common, **params)
    if kind == "random_forest":  # full depth (30 is Spark's limit), all features at each split
        return RandomForestRegressor(numTrees=100, maxDepth=30, featureSubsetStrategy="all", seed=SEED, **common, **params)
    if kind == "gradient_boosting":
        return GBTRegressor(maxIter=100, maxDepth=3, stepSize=0.1, seed=SEED, **common, **params)
    if kind == "gbt":
        return GBTRegressor(seed=SEED, **common, **params)
    raise ValueError(kind)


BAKEOFF = ("linear", "ridge", "lasso", "random_forest", "gradient_boosting")


def pipeline(features, estimator, family_col: str = "familia") -> Pipeline:
    """Family one-hot + assembler + estimator."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=family_col, outputCol="_fam_idx", handleInvalid="keep"),
            OneHotEncoder(inputCol="_fam_idx", outputCol="_fam_vec", handleInvalid="keep"),
            VectorAssembler(inputCols=[*features, "_fam_vec"], outputCol="features", handleInvalid="keep"),
            estimator,
        ]
    )


#: Partitions of a training set.  Row samples are drawn per partition, so this number is part of the model's seed.
TRAIN_PARTITIONS = 4


def fit(train: DataFrame, estimator, features=None, partitions: int = TRAIN_PARTITIONS, keys=("familia", "week_start")) -> PipelineModel:
    """Fit the pipeline on complete rows; a null feature or target is an error, not a dropped row.

    The rows are dealt by a hash of their keys into ``partitions`` sorted
    partitions, so the model depends neither on the input's partitions nor
    on the cluster.
    """
    features = features or feature_columns(train)
    missing = [c for c in (*features, "target") if dict(train.dtypes)[c] != "void"]
    bad = train.where(F.greatest(*[F.col(c).isNull().cast("int") for c in missing], F.lit(0)) == 1).count()
    if bad:
        raise ValueError(f"{bad} training rows with a null feature or target")
    return pipeline(features, estimator).fit(train.repartition(partitions, *keys).sortWithinPartitions(*keys))


def score(model: PipelineModel, df: DataFrame, keys=("familia", "week_start")) -> DataFrame:
    """M6/M7: one row for each row (keys, actual, predicted); the prediction is null where a feature is null."""
    needed = model.stages[2].getInputCols()[:-1]
    missing = [c for c in needed if c not in df.columns]
    if missing:  # model feature names must be present (reference's assertion)
        raise ValueError(f"missing model features: {missing}")
    out = model.transform(df)
    actual = [F.col("target").cast("double").alias("actual")] if "target" in df.columns else []
    extra = [c for c in ("role", "fold") if c in df.columns]
    known = F.least(*[F.col(c).isNotNull().cast("int") for c in needed], F.lit(1)) == 1
    return out.select(*keys, *extra, *actual, F.when(known, F.col("prediction")).alias("predicted"))


def train_evaluate(train: DataFrame, test: DataFrame, estimator, features=None, by=("familia",)) -> DataFrame:
    """M2: fit on train, error table per family on test (and overall with ``by=()``)."""
    model = fit(train, estimator, features)
    preds = score(model, test)
    return evaluate.error_metrics(preds, list(by))


def bakeoff(train: DataFrame, test: DataFrame, kinds=BAKEOFF, features=None) -> DataFrame:
    """M3: every model on the same split; one error row per (model, family)."""
    tables, rows = [], train.count()
    for kind in kinds:
        model = fit(train, regressor(kind, rows), features)
        preds = score(model, test).withColumn("model", F.lit(kind))
        tables.append(preds)
    preds = tables[0]
    for t in tables[1:]:
        preds = preds.unionByName(t)
    return evaluate.error_metrics(preds, ["model", "familia"])


def param_grid(grid: dict) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, values)) for values in itertools.product(*(grid[k] for k in keys))]


def grid_search(folds: DataFrame, grid: dict = REFERENCE_GRID, features=None, kind: str = "gbt") -> DataFrame:
    """M4: mean test MAE over expanding folds (W7) for every parameter set.

    ``folds`` holds (keys…, features…, target, fold, role).  Each fold trains
    only on earlier weeks (unlike ``CrossValidator``), and the parameter sets
    of one fold are fitted together with ``fitMultiple``.
    """
    features = features or feature_columns(folds)
    combos = param_grid(grid)
    n_folds = folds.agg(F.max("fold")).first()[0] + 1
    rows = []
    base = regressor(kind)
    for fold in range(n_folds):
        part = folds.where(F.col("fold") == fold)
        train, test = part.where(F.col("role") == "train"), part.where(F.col("role") == "test")
        pipe = pipeline(features, base)
        train = train.repartition(TRAIN_PARTITIONS, "familia", "week_start").sortWithinPartitions("familia", "week_start")
        maps = [{getattr(base, k): v for k, v in combo.items()} for combo in combos]
        for idx, model in pipe.fitMultiple(train, maps):
            mae = evaluate.error_metrics(score(model, test), []).first()["mae"]
            rows.append((idx, fold, float(mae)))
    spark = folds.sparkSession
    res = spark.createDataFrame(rows, "combo int, fold int, mae double")
    summary = res.groupBy("combo").agg(F.avg("mae").alias("mean_mae"), F.count(F.lit(1)).alias("n_folds"))
    labels = spark.createDataFrame([(i, str(c)) for i, c in enumerate(combos)], "combo int, params string")
    return summary.join(labels, "combo").orderBy("mean_mae", "combo")


def random_search(
    train: DataFrame, n_trials: int = 30, features=None, seed: int = SEED, valid_share: float = 0.2, ranges=None
) -> DataFrame:
    """M5: seeded random parameter draws, scored on the last 20 % of each family's train weeks."""
    rng = random.Random(seed)
    ranges = ranges or RANDOM_RANGES
    w = Window.partitionBy("familia").orderBy("week_start")
    pos = F.row_number().over(w) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy("familia"))
    tagged = train.withColumn("_inner", F.when(pos < F.floor(n * (1 - valid_share)), "train").otherwise("valid"))
    inner_train, valid = tagged.where(F.col("_inner") == "train"), tagged.where(F.col("_inner") == "valid")
    features = features or feature_columns(train.drop("_inner"))
    trials = []
    for t in range(n_trials):
        p = {
            "maxIter": rng.randint(*ranges["maxIter"]),
            "maxDepth": rng.randint(*ranges["maxDepth"]),
            "stepSize": rng.uniform(*ranges["stepSize"]),
            "subsamplingRate": rng.uniform(*ranges["subsamplingRate"]),
            "featureSubsetStrategy": f"{rng.uniform(*ranges['featureSubsetStrategy']):.4f}",
        }
        model = fit(inner_train, regressor("gbt", **p), features)
        mae = evaluate.error_metrics(score(model, valid), []).first()["mae"]
        trials.append((t, str(p), float(mae)))
    return train.sparkSession.createDataFrame(trials, "trial int, params string, mae double").orderBy("mae", "trial")


def permutation_importance(model: PipelineModel, df: DataFrame, features=None, family_col: str = "familia", order_col: str = "week_start", predict=None) -> DataFrame:
    """MAE increase when one feature is permuted.

    The permutation is a fixed derangement inside each family: row i takes
    the value of row (i + max(1, ⌊n/2⌋)) mod n, joined on (family, position).
    ``predict`` gives (keys, actual, predicted) of a frame; by default the model does.
    """
    predict = predict or (lambda rows: score(model, rows))
    features = features or model.stages[2].getInputCols()[:-1]
    w = Window.partitionBy(family_col).orderBy(order_col)
    base = df.withColumns({"_pos": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(family_col))})
    base_mae = evaluate.error_metrics(predict(df), []).select(F.col("mae").alias("base_mae"))
    out = []
    for f in features:
        donor = base.select(family_col, F.col("_pos").alias("_src"), F.col(f).alias("_perm"))
        shifted = base.withColumn("_src", (F.col("_pos") + F.greatest(F.lit(1), F.floor(F.col("_n") / 2))) % F.col("_n"))
        permuted = shifted.join(donor, [family_col, "_src"]).withColumn(f, F.col("_perm")).drop("_perm", "_src", "_pos", "_n")
        mae = evaluate.error_metrics(predict(permuted), []).select(F.lit(f).alias("feature"), F.col("mae").alias("permuted_mae"))
        out.append(mae)
    res = out[0]
    for m in out[1:]:
        res = res.unionByName(m)
    b = base_mae.scalar()  # scalar subquery, no collect
    return res.withColumns({"base_mae": b, "mae_increase": F.col("permuted_mae") - b})


def tree_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """Built-in feature importances of a tree model, by input name."""
    names = model.stages[2].getInputCols()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return list(zip(names[:-1], imp[: len(names) - 1]))


def save(model: PipelineModel, path: str) -> None:
    """Spark ML persistence."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
