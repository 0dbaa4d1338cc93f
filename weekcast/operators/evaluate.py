"""Forecast evaluation: naive baselines, error tables, correlation.

Metrics are grouped aggregates (one pass, partial aggregation), so scoring
all families and all models is one job instead of a loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as num
from .features import lag_name

# The five naive baselines and the lags each one averages.
BASELINES = {
    "previous_week": (1,),
    "mean_last_4": (1, 2, 3, 4),
    "same_week_last_year": (52,),
    "lag_12": (12,),
    "mean_of_lags": (1, 2, 3, 4, 12, 24, 52),
}
BASELINE_LAGS = (1, 2, 3, 4, 12, 24, 52)
CORR_BANDS = ((0.9, "strong"), (0.7, "moderate"))


def baseline_forecasts(
    features: DataFrame,
    value_col: str = "base_imponible",
    target_col: str = "target",
    keys=("familia", "week_start"),
    baselines=None,
) -> DataFrame:
    """M1: long table ``keys…, model, actual, predicted`` with one row per baseline."""
    baselines = baselines or BASELINES
    preds = F.array(
        *[
            F.struct(F.lit(name).alias("model"), num.row_mean([lag_name(value_col, k) for k in lags]).alias("predicted"))
            for name, lags in baselines.items()
        ]
    )
    extra = [c for c in ("role",) if c in features.columns]
    return features.select(*keys, *extra, F.col(target_col).cast("double").alias("actual"), F.explode(preds).alias("_p")).select(
        *keys, *extra, "_p.model", "actual", "_p.predicted"
    )


def error_metrics(df: DataFrame, by, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """N, MAE, MSE, RMSE, MAPE (ratio, epsilon-guarded like scikit-learn), MAPE %, R².

    ``mape_pct`` is the dashboard's unguarded ×100 variant (NULL when an
    actual is 0).  R² = 1 − SSE / (n · var_pop(actual)).
    """
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    err = a - p
    eps = F.lit(2.220446049250313e-16)  # float64 machine epsilon, as scikit-learn
    n = F.count(F.lit(1))
    sse = F.sum(err * err)
    return (
        df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*by)
        .agg(
            n.cast("bigint").alias("n"),
            F.avg(F.abs(err)).alias("mae"),
            F.avg(err * err).alias("mse"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.avg(F.abs(err) / F.greatest(F.abs(a), eps)).alias("mape"),
            (F.avg(F.try_divide(F.abs(err), F.abs(a))) * 100).alias("mape_pct"),
            (F.lit(1.0) - F.try_divide(sse, n * F.var_pop(a))).alias("r2"),
        )
    )


def forecast_correlation(
    df: DataFrame, by, actual: str = "actual", predicted: str = "predicted", digits: int | None = None
) -> DataFrame:
    """Pearson correlation of actual vs predicted with a quality band."""
    corr = num.safe_corr(actual, predicted)
    out = df.groupBy(*by).agg((F.round(corr, digits) if digits is not None else corr).alias("correlation"))
    band = F.lit("weak")
    for lo, name in reversed(CORR_BANDS):
        band = F.when(F.col("correlation") > lo, F.lit(name)).otherwise(band)
    return out.withColumn("band", F.when(F.col("correlation").isNotNull(), band))


def residuals(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """residual = actual − predicted per row."""
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def fold_run_log(
    predictions: DataFrame,
    folds: DataFrame,
    keys=("familia", "week_start"),
    digits: int = 4,
) -> DataFrame:
    """One run-log row per (family, model, fold) of an expanding-window backtest.

    ``predictions``: keys, model, actual, predicted.  ``folds``: keys, fold, role.
    A run's ``created`` date is its first test week; ``mae`` is rounded to
    ``digits`` so rankings of runs do not depend on summation order.
    """
    test = folds.where(F.col("role") == "test").select(*keys, "fold")
    j = predictions.join(test, list(keys))
    out = j.groupBy("familia", "model", "fold").agg(
        F.min("week_start").alias("created"),
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.round(F.avg(F.abs(F.col("actual") - F.col("predicted"))), digits).alias("mae"),
    )
    name = F.concat_ws("/", F.col("model"), F.col("familia"), F.col("fold").cast("string"))
    return out.select(name.alias("run_name"), "familia", "model", F.col("fold").cast("int").alias("fold"), "created", "n", "mae")
