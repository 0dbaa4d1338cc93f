"""Plan guards: no registered query may plan a cross product or a nested-loop join."""

import pytest

import __spark_entry__ as entry

from given_core import SF_CHECK, SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
# sf0.001 has no complete week to fit a model on: these run on sf0.01
LEARNING = {"train_gbt", "model_bakeoff", "batch_score", "predict_latest", "weekly_prediction_job", "model_roundtrip", "feature_importance",
            "baseline_vs_model", "linear_optimality", "grid_search", "random_search", "feature_importance_lag1", "builtin_importance",
            "train_xgb", "xgb_root_gains", "prediction_checks", "shap_values", "shap_checks"}
#: These fit the same models and score with the plan of ``batch_score``.
SLOW = {"model_bakeoff", "train_gbt", "predict_latest", "weekly_prediction_job", "model_roundtrip", "feature_importance",
        "baseline_vs_model", "grid_search", "random_search", "train_xgb", "xgb_root_gains", "shap_values"}
#: The training-data queries are checked in tests/llm.
OWN = {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW - OWN))
def test_no_cross_products(spark, name):
    df = entry.queries()[name](spark, SF_CHECK if name in LEARNING else SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan[:2000]


def test_column_profile_keeps_one_columns_values_at_a_time(spark):
    """No table of all columns' texts is grouped; nulls and signed zeros count as before, with and without rows."""
    from weekcast.operators import explore

    rows = spark.sql(
        "select * from values (1L, 'a', 1.50, 0.0d, date'2001-01-01'), (1L, null, 1.50, -0.0d, null), (2L, 'b', null, null, date'2001-01-02'),"
        " (null, 'b', 2.25, 0.0d, date'2001-01-02') t(n, s, amount, x, d)"
    )
    profile = explore.column_profile(rows)
    assert "explode(" not in profile._jdf.queryExecution().executedPlan().toString()
    for found in (profile, explore.column_profile(rows, exact=False)):
        assert {r["column_name"]: (r["n_distinct"], r["n_null"]) for r in found.collect()} == {"n": (2, 1), "s": (2, 1), "amount": (2, 1), "x": (2, 1), "d": (2, 1)}
    assert {r["n_distinct"] for r in explore.column_profile(rows.where("n > 5")).collect()} == {0}
