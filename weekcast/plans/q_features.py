"""Queries: features, splits, baselines and error tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, evaluate, features, rollup, split
from ..sources import tables
from . import sqltext as q
from . import views
from .catalog import query

LAGS = (1, 2, 3, 52)
WEEKLY = f"{q.SALES_LINES}, {q.weekly(7)}"


def _weekly(spark, sf_dir):
    return views.weekly(spark, sf_dir, min_days=7)


def _lag_sql(lags=LAGS, src="weekly"):
    return ", ".join(
        f"lag(base_imponible, {k}) over (partition by familia order by week_start) as base_imponible_lag{k}" for k in lags
    )


# Metric rounding: sums of doubles depend on summation order, so every
# aggregate of doubles is rounded well above its accumulated error.
METRIC_DIGITS = {"mae": 4, "mse": 0, "rmse": 4, "mape": 8, "mape_pct": 6, "r2": 8, "correlation": 8}


def _round(df):
    return df.withColumns({c: F.round(c, d) for c, d in METRIC_DIGITS.items() if c in df.columns})


def _metrics_sql(src: str, by: str) -> str:
    r = METRIC_DIGITS
    return f"""select {by}, cast(count(*) as bigint) as n,
       round(avg(abs(actual - predicted)), {r['mae']}) as mae,
       round(avg((actual - predicted) * (actual - predicted)), {r['mse']}) as mse,
       round(sqrt(avg((actual - predicted) * (actual - predicted))), {r['rmse']}) as rmse,
       round(avg(abs(actual - predicted) / greatest(abs(actual), 2.220446049250313e-16)), {r['mape']}) as mape,
       round(avg(case when actual <> 0 then abs(actual - predicted) / abs(actual) end) * 100, {r['mape_pct']}) as mape_pct,
       round(1.0 - sum((actual - predicted) * (actual - predicted)) / nullif(count(*) * var_pop(actual), 0), {r['r2']}) as r2
from {src} where actual is not null and predicted is not null group by {by}"""


# ---------------------------------------------------------------- lags and targets


@query(
    "lags_positional",
    f"with {WEEKLY} select familia, week_start, base_imponible, {_lag_sql()} from weekly",
)
def lags_positional(spark, sf_dir):
    """Lag k = k rows earlier in the family's series."""
    w = _weekly(spark, sf_dir).select("familia", "week_start", "base_imponible")
    return features.lags_positional(w, LAGS)


@query(
    "lags_calendar",
    f"""with {WEEKLY}
select w.familia, w.week_start, w.base_imponible,
       {", ".join(f"l{k}.base_imponible as base_imponible_lag{k}" for k in LAGS)}
from weekly w
{" ".join(f"left join weekly l{k} on l{k}.familia = w.familia and l{k}.week_start = cast(w.week_start - {7 * k} as date)" for k in LAGS)}""",
)
def lags_calendar(spark, sf_dir):
    """Lag k = the week exactly 7k days earlier (null when that week is absent)."""
    w = _weekly(spark, sf_dir).select("familia", "week_start", "base_imponible")
    return features.lags_calendar(w, LAGS)


@query(
    "lead_target",
    f"""with {WEEKLY}
select familia, week_start, base_imponible,
       lead(base_imponible, 1) over (partition by familia order by week_start) as target from weekly""",
)
def lead_target(spark, sf_dir):
    """Next week's value as the target."""
    w = _weekly(spark, sf_dir).select("familia", "week_start", "base_imponible")
    return features.lead_target(w, 1)


@query("feature_table", f"with {WEEKLY}, {q.features(LAGS, 1)} select * from features")
def feature_table(spark, sf_dir):
    """Lags 1,2,3,52 + flags + target (horizon 1), incomplete rows dropped."""
    return features.feature_table(_weekly(spark, sf_dir), LAGS, horizon=1)


@query(
    "rolling_mean",
    f"""with {q.SALES_LINES}, {q.daily(exact=True)},
sums as (select {q.sunday_label('fecha')} as label, familia, sum(total) as total from daily group by all),
spine as (select familia, cast(unnest(generate_series(min(label), max(label), interval 7 day)) as date) as label
          from sums group by familia),
wk as (select s.label as fecha, s.familia, coalesce(m.total, 0) as total
       from spine s left join sums m on s.label = m.label and s.familia = m.familia)
select fecha, familia, cast(total as double) as total,
       case when count(total) over w = 3 then cast(sum(total) over w as double) / 3.0 end as total_rolling
from wk window w as (partition by familia order by fecha rows between 1 preceding and 1 following)""",
)
def rolling_mean(spark, sf_dir):
    """Centred 3-week rolling mean of weekly totals (null at both edges)."""
    wk = rollup.weekly_resample(views.daily(spark, sf_dir, keep_decimal=True), value_cols=("total",), keep_decimal=True)
    out = features.rolling_mean_centered(wk, "total", 3, order_col="fecha", name="total_rolling")
    return out.select("fecha", "familia", F.col("total").cast("double").alias("total"), "total_rolling")


@query(
    "next_week_features",
    f"""with {WEEKLY},
nxt as (select familia, cast(max(week_start) + 7 as date) as week_start,
               arg_max(is_summer_peak, week_start) as is_summer_peak, arg_max(is_easter, week_start) as is_easter
        from weekly group by familia)
select n.familia, n.week_start, {", ".join(f"l{k}.base_imponible as base_imponible_lag{k}" for k in LAGS)},
       n.is_summer_peak, n.is_easter,
       cast({" + ".join(f"cast(l{k}.base_imponible is null as integer)" for k in LAGS)} as integer) as missing_lags
from nxt n
{" ".join(f"left join weekly l{k} on l{k}.familia = n.familia and l{k}.week_start = cast(n.week_start - {7 * k} as date)" for k in LAGS)}""",
)
def next_week_features(spark, sf_dir):
    """M9: serving row per family for the week after its last stored week (calendar lags, carried flags)."""
    return features.next_week_features(_weekly(spark, sf_dir), LAGS)


@query(
    "lag_availability",
    f"""with {WEEKLY},
nxt as (select familia, cast(max(week_start) + 7 as date) as next_week from weekly group by familia),
req as (select familia, next_week, lag, cast(next_week - 7 * lag as date) as required_week
        from nxt, (select unnest([{", ".join(str(k) for k in LAGS)}]) as lag))
select r.familia, r.next_week, cast(r.lag as integer) as lag, r.required_week, w.week_start is not null as available
from req r left join weekly w on w.familia = r.familia and w.week_start = r.required_week""",
)
def lag_availability(spark, sf_dir):
    """Are the weeks the next forecast needs stored?"""
    return features.lag_availability(_weekly(spark, sf_dir), LAGS)


@query(
    "asof_features",
    f"""with {WEEKLY},
days as (select distinct fecha, familia from sales),
wk as (select familia, week_start, base_imponible from weekly)
select d.fecha, d.familia, w.week_start as f_week_start, w.base_imponible as f_base_imponible
from days d asof left join wk w on d.familia = w.familia and d.fecha >= w.week_start + 7""",
)
def asof_features(spark, sf_dir):
    """Point-in-time lookup — for each sale day, the latest complete week that had ended before it."""
    days = views.sales(spark, sf_dir).select("fecha", "familia").distinct()
    wk = _weekly(spark, sf_dir).select("familia", "week_start", "base_imponible")
    return features.asof_weekly(days, wk)


# Feature groups of the event table: purchases count for two days, views until the next one.
ASOF_GROUPS = (("purchase", 2 * 86400), ("view", None))


def _asof_sql(name, ttl):
    rows = f"(select * from events where event_type = '{name}' qualify row_number() over (partition by user_id, ts order by event_id desc) = 1)"
    fresh = f"e.ts <= f.ts + interval {ttl} second" if ttl else "true"
    return f"""select e.event_id, case when {fresh} then f.value end as {name}_value, case when {fresh} then f.props end as {name}_props,
  case when {fresh} then f.ts end as {name}_time from e asof left join {rows} f on e.user_id = f.user_id and e.ts >= f.ts"""


@query(
    "asof_events",
    f"""with e as (select event_id, user_id, ts, event_type from events where event_type in ('click', 'error'))
select e.*, {", ".join(f"{n}_value, {n}_props, {n}_time" for n, _ in ASOF_GROUPS)}
from e {" ".join(f"join ({_asof_sql(n, t)}) using (event_id)" for n, t in ASOF_GROUPS)}""",
)
def asof_events(spark, sf_dir):
    """For each click and error, the user's latest purchase (held for two days) and view at that moment."""
    ev = tables.table(spark, sf_dir, "events")
    groups = [asof.FeatureGroup(n, ev.where(F.col("event_type") == n), ("value", "props"), "ts", "event_id", ttl) for n, ttl in ASOF_GROUPS]
    entities = ev.where(F.col("event_type").isin("click", "error")).select("event_id", "user_id", "ts", "event_type")
    return asof.asof_join(entities, groups, ["user_id"], "ts", n_slices=8)


# ---------------------------------------------------------------- splits


@query(
    "temporal_split",
    f"""with {WEEKLY},
pos as (select familia, week_start, base_imponible,
               row_number() over (partition by familia order by week_start) - 1 as p,
               count(*) over (partition by familia) as n from weekly)
select familia, week_start, base_imponible,
       case when week_start <= max(case when p = floor(n * cast(0.8 as double)) then week_start end) over (partition by familia)
            then 'train' else 'test' end as role
from pos""",
)
def temporal_split(spark, sf_dir):
    """Per family, the row at position int(0.8·n) closes train."""
    w = _weekly(spark, sf_dir).select("familia", "week_start", "base_imponible")
    return split.temporal_split(w, 0.8)


@query(
    "split_by_week",
    f"""with {WEEKLY},
wk as (select week_start, row_number() over (order by week_start) as k, count(*) over () as n
       from (select distinct week_start from weekly)),
b as (select week_start as split_week from wk where k = floor(n * cast(0.8 as double)))
select familia, week_start, base_imponible,
       case when week_start <= (select split_week from b) then 'train' else 'test' end as role
from weekly""",
)
def split_by_week(spark, sf_dir):
    """boundary = weeks[int(0.8·n_weeks) − 1] over distinct weeks, shared by all families."""
    w = _weekly(spark, sf_dir).select("familia", "week_start", "base_imponible")
    return split.split_by_week(w, 0.8)


@query(
    "expanding_folds",
    f"""with {WEEKLY}, {q.features(LAGS, 1)},
pos as (select familia, week_start, row_number() over (partition by familia order by week_start) - 1 as p,
               count(*) over (partition by familia) as n from features),
f as (select *, floor(n / 6) as ts, n - (5 - fold) * floor(n / 6) as te
      from pos, (select unnest(range(0, 5)) as fold))
select familia, week_start, cast(fold as integer) as fold,
       case when p < te then 'train' else 'test' end as role
from f where ts > 0 and p < te + ts""",
)
def expanding_folds(spark, sf_dir):
    """Five expanding folds per family on the feature table."""
    ft = features.feature_table(_weekly(spark, sf_dir), LAGS, horizon=1).select("familia", "week_start")
    out = split.expanding_folds(ft, 5)
    return out.select("familia", "week_start", F.col("fold").cast("int").alias("fold"), "role")


@query(
    "latest_row",
    f"""with {WEEKLY}
select familia, arg_max(year, week_start) as year, arg_max(week, week_start) as week,
       arg_max(base_imponible, week_start) as base_imponible, arg_max(is_summer_peak, week_start) as is_summer_peak,
       arg_max(is_easter, week_start) as is_easter, arg_max(dias_semana, week_start) as dias_semana,
       max(week_start) as week_start
from weekly group by familia""",
)
def latest_row(spark, sf_dir):
    """Last stored week of every family."""
    return split.latest_row(_weekly(spark, sf_dir))


# ---------------------------------------------------------------- baselines and errors

BASE_FEATURES_SQL = (
    f"{WEEKLY}, {q.features(evaluate.BASELINE_LAGS, 1, name='bfeat')},"
    f"""
wk as (select week_start, row_number() over (order by week_start) as k, count(*) over () as n
       from (select distinct week_start from bfeat)),
bsplit as (select *, case when week_start <= (select week_start from wk where k = floor(n * cast(0.8 as double))) then 'train' else 'test' end as role
           from bfeat)"""
)


def _row_mean_sql(cols):
    total = "0.0"
    for c in cols:
        total = f"({total} + coalesce({c}, 0.0))"
    cnt = " + ".join(f"cast({c} is not null as double)" for c in cols)
    return f"({total} / nullif(0.0 + {cnt}, 0))"


BASELINE_SQL = BASE_FEATURES_SQL + ",\nbaseline as (" + "\nunion all\n".join(
    f"select familia, week_start, role, '{name}' as model, cast(target as double) as actual, "
    f"{_row_mean_sql([f'base_imponible_lag{k}' for k in lags])} as predicted from bsplit"
    for name, lags in evaluate.BASELINES.items()
) + ")"


def _baseline(spark, sf_dir):
    ft = features.feature_table(_weekly(spark, sf_dir), evaluate.BASELINE_LAGS, horizon=1)
    return evaluate.baseline_forecasts(split.split_by_week(ft, 0.8))


@query("baseline_forecasts", f"with {BASELINE_SQL} select * from baseline")
def baseline_forecasts(spark, sf_dir):
    """M1: the five naive forecasts for every family-week, labelled train/test."""
    return _baseline(spark, sf_dir)


@query(
    "baseline_metrics",
    f"with {BASELINE_SQL} " + _metrics_sql("(select * from baseline where role = 'test')", "familia, model"),
)
def baseline_metrics(spark, sf_dir):
    """A20 on M1: test-set errors per family and baseline."""
    test = _baseline(spark, sf_dir).where(F.col("role") == "test")
    return _round(evaluate.error_metrics(test, ["familia", "model"]))


@query(
    "residuals",
    f"""with {BASELINE_SQL}
select familia, week_start, role, model, actual, predicted, actual - predicted as residual from baseline""",
)
def residuals(spark, sf_dir):
    """Residual table of the baselines."""
    return evaluate.residuals(_baseline(spark, sf_dir))


@query("split_metrics", f"with {BASELINE_SQL} " + _metrics_sql("baseline", "familia, model, role"))
def split_metrics(spark, sf_dir):
    """Train vs test errors per family and baseline."""
    return _round(evaluate.error_metrics(_baseline(spark, sf_dir), ["familia", "model", "role"]))


AVP_SQL = f"""{WEEKLY},
predictions as (select familia, week_start,
                       lag(base_imponible, 1) over (partition by familia order by week_start) as predicted_base_imponible
                from weekly),
avp as (select w.familia, w.week_start, w.base_imponible as actual, p.predicted_base_imponible as predicted
        from weekly w join predictions p on w.familia = p.familia and w.week_start = p.week_start
        where p.predicted_base_imponible is not null)"""


def _avp(spark, sf_dir):
    w = _weekly(spark, sf_dir)
    preds = features.lags_positional(w.select("familia", "week_start", "base_imponible"), (1,)).select(
        "familia", "week_start", F.col("base_imponible_lag1").alias("predicted_base_imponible")
    ).where(F.col("predicted_base_imponible").isNotNull())
    return w.join(preds, ["familia", "week_start"], "inner").select(
        "familia",
        "week_start",
        F.col("base_imponible").alias("actual"),
        F.col("predicted_base_imponible").alias("predicted"),
    )


@query("actual_vs_predicted", f"with {AVP_SQL} select * from avp")
def actual_vs_predicted(spark, sf_dir):
    """Stored weeks joined with stored predictions on (family, week)."""
    return _avp(spark, sf_dir)


@query("forecast_metrics", f"with {AVP_SQL} " + _metrics_sql("avp", "familia"))
def forecast_metrics(spark, sf_dir):
    """MAE, MSE, RMSE, MAPE, R² per family."""
    return _round(evaluate.error_metrics(_avp(spark, sf_dir), ["familia"]))


@query(
    "forecast_correlation",
    f"""with {AVP_SQL}
select familia, correlation, case when correlation > 0.9 then 'strong' when correlation > 0.7 then 'moderate'
                                  when correlation is not null then 'weak' end as band
from (select familia, round(covar_pop(actual, predicted) / nullif(stddev_pop(actual) * stddev_pop(predicted), 0), 8) as correlation
      from avp group by familia)""",
)
def forecast_correlation(spark, sf_dir):
    """Correlation of actual vs predicted with its band."""
    return evaluate.forecast_correlation(_avp(spark, sf_dir), ["familia"], digits=METRIC_DIGITS["correlation"])
