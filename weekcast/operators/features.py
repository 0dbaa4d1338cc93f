"""Lag/target features over weekly family series.

The weekly series holds one row per (family, week): its size is bounded by
families × weeks whatever the raw volume, so per-family windows are cheap.
Every window is ``partitionBy(family)`` — never a global order (Q1) — and
all lags of one call share one window spec, i.e. one shuffle + one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from .joins import join_small

DEFAULT_LAGS = (1, 2, 3, 52)


def _series_window(family_col: str, order_col: str):
    return Window.partitionBy(family_col).orderBy(order_col)


def lag_name(value_col: str, k: int) -> str:
    return f"{value_col}_lag{k}"


def lags_positional(
    df: DataFrame,
    lags=DEFAULT_LAGS,
    value_col: str = "base_imponible",
    family_col: str = "familia",
    order_col: str = "week_start",
) -> DataFrame:
    """Lag k = value k rows earlier in the family's series (missing weeks are skipped)."""
    w = _series_window(family_col, order_col)
    return df.withColumns({lag_name(value_col, k): F.lag(value_col, k).over(w) for k in lags})


def lags_calendar(
    df: DataFrame,
    lags=DEFAULT_LAGS,
    value_col: str = "base_imponible",
    family_col: str = "familia",
    week_col: str = "week_start",
) -> DataFrame:
    """Lag k = value of the week exactly 7·k days earlier, null when that week is absent.

    A RANGE frame of width zero at offset −7k days on the day number does the
    self-lookup inside one window, with no self-join per lag.
    """
    day = F.unix_date(F.col(week_col))
    base = Window.partitionBy(family_col).orderBy(day)
    return df.withColumns(
        {
            lag_name(value_col, k): F.max(value_col).over(base.rangeBetween(-7 * k, -7 * k))
            for k in lags
        }
    )


def lead_target(
    df: DataFrame,
    horizon: int = 1,
    value_col: str = "base_imponible",
    family_col: str = "familia",
    order_col: str = "week_start",
    name: str = "target",
) -> DataFrame:
    """Value ``horizon`` rows ahead in the family's series."""
    w = _series_window(family_col, order_col)
    return df.withColumn(name, F.lead(value_col, horizon).over(w))


def feature_table(
    weekly: DataFrame,
    lags=DEFAULT_LAGS,
    horizon: int = 1,
    value_col: str = "base_imponible",
    exog_cols=("is_summer_peak", "is_easter"),
    family_col: str = "familia",
    order_col: str = "week_start",
    drop_nulls: bool = True,
    lag_mode: str = "positional",
) -> DataFrame:
    """Family, week, value, lags, exogenous flags and ``target`` (lead ``horizon``).

    ``horizon=1`` reproduces the training table (target = next week);
    ``horizon=0`` gives the aligned option (target = this week).  Rows with
    any missing lag or target are dropped when ``drop_nulls``.
    """
    w = _series_window(family_col, order_col)
    if lag_mode == "positional":
        with_lags = lags_positional(weekly, lags, value_col, family_col, order_col)
    elif lag_mode == "calendar":
        with_lags = lags_calendar(weekly, lags, value_col, family_col, order_col)
    else:
        raise ValueError(lag_mode)
    target = F.lead(value_col, horizon).over(w) if horizon else F.col(value_col)
    out = with_lags.select(
        family_col,
        order_col,
        value_col,
        *[lag_name(value_col, k) for k in lags],
        *exog_cols,
        target.alias("target"),
    )
    if drop_nulls:
        out = out.na.drop("any", subset=[lag_name(value_col, k) for k in lags] + ["target"])
    return out


def rolling_mean_centered(
    df: DataFrame,
    value_col: str,
    window: int = 3,
    family_col: str = "familia",
    order_col: str = "fecha",
    name: str | None = None,
) -> DataFrame:
    """Centered rolling mean over ``window`` rows; null unless the frame is full."""
    half = window // 2
    w = Window.partitionBy(family_col).orderBy(order_col).rowsBetween(-half, window - half - 1)
    full = F.count(F.col(value_col)).over(w) == window
    # sum of the full frame divided by its size, in the same order in both engines
    return df.withColumn(
        name or f"{value_col}_rolling",
        F.when(full, F.sum(F.col(value_col)).over(w) / F.lit(float(window))),
    )


def next_week_features(
    weekly: DataFrame,
    lags=DEFAULT_LAGS,
    value_col: str = "base_imponible",
    exog_cols=("is_summer_peak", "is_easter"),
    family_col: str = "familia",
    week_col: str = "week_start",
    exog: str = "carry_last",
) -> DataFrame:
    """M9: one serving row per family for the week after its last stored week.

    Lags are calendar lookups (``next − 7k``).  ``exog='carry_last'`` copies the
    last stored flags (reference behaviour, Q13); ``'calendar'`` derives them
    from the new week's dates.  ``missing_lags`` counts absent lag weeks (Q14).
    """
    w = Window.partitionBy(family_col)
    nxt = F.date_add(F.max(week_col).over(w), 7)
    hist = weekly.withColumn("_next", nxt)
    aggs = [F.first("_next").alias(week_col)]
    for k in lags:
        hit = F.col(week_col) == F.date_sub(F.col("_next"), 7 * k)
        aggs.append(F.max(F.when(hit, F.col(value_col))).alias(lag_name(value_col, k)))
    if exog == "carry_last":
        aggs += [F.max_by(F.col(c), F.col(week_col)).alias(c) for c in exog_cols]
    out = hist.groupBy(family_col).agg(*aggs)
    if exog == "calendar":
        days = F.sequence(F.col(week_col), F.date_add(F.col(week_col), 6))
        out = out.withColumns(
            {
                "is_summer_peak": F.aggregate(days, F.lit(0), lambda acc, d: F.greatest(acc, cal.is_summer_peak(d))),
                "is_easter": F.aggregate(days, F.lit(0), lambda acc, d: F.greatest(acc, cal.is_holy_week(d))),
            }
        )
    missing = sum((F.col(lag_name(value_col, k)).isNull().cast("int") for k in lags), F.lit(0))
    return out.withColumn("missing_lags", missing)


def lag_availability(
    weekly: DataFrame,
    lags=DEFAULT_LAGS,
    family_col: str = "familia",
    week_col: str = "week_start",
) -> DataFrame:
    """For each family's next week, each required lag week and whether it is stored."""
    nxt = weekly.groupBy(family_col).agg(F.date_add(F.max(week_col), 7).alias("next_week"))
    req = nxt.select(
        family_col,
        "next_week",
        F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag"),
    ).withColumn("required_week", F.date_sub(F.col("next_week"), F.col("lag") * 7))
    have = weekly.select(F.col(family_col), F.col(week_col).alias("required_week"), F.lit(1).alias("_hit"))
    return req.join(have, [family_col, "required_week"], "left").select(
        family_col,
        "next_week",
        F.col("lag").cast("int").alias("lag"),
        "required_week",
        F.col("_hit").isNotNull().alias("available"),
    )


def asof_weekly(
    entities: DataFrame,
    weekly_features: DataFrame,
    entity_date_col: str = "fecha",
    family_col: str = "familia",
    week_col: str = "week_start",
    available_after_days: int = 7,
) -> DataFrame:
    """Point-in-time join — each entity row gets the latest feature week that was complete on its date.

    A week's row sums its seven days, so it is known ``available_after_days``
    after its Monday (0: as soon as the week starts, which looks ahead).

    Feature weeks start on Mondays, so "latest week_start ≤ date" equals the
    feature row valid on the Monday of the entity's week.  Each feature row
    is expanded to the Mondays it stays valid (until the family's next
    stored week), then joined on equality: no range join, no window over the
    entity rows, and the expansion is bounded by weeks × families.
    """
    w = Window.partitionBy(family_col).orderBy(week_col)
    valid = weekly_features.withColumn("_until", F.lead(week_col).over(w))
    mondays = F.sequence(
        F.col(week_col),
        F.coalesce(F.date_sub(F.col("_until"), 7), F.col(week_col)),
        F.expr("INTERVAL 7 DAYS"),
    )
    expanded = valid.withColumn("_monday", F.explode(mondays)).drop("_until")
    # dates after a family's last stored week take that last week
    last = weekly_features.groupBy(family_col).agg(F.max(week_col).alias("_last"))
    keyed = join_small(entities, last, family_col, "left").withColumn(
        "_monday", F.least(cal.week_monday(F.date_sub(entity_date_col, available_after_days)), F.col("_last"))
    ).drop("_last")
    feat_cols = [c for c in weekly_features.columns if c != family_col]
    renamed = expanded.select(
        family_col, "_monday", *[F.col(c).alias(f"f_{c}") for c in feat_cols]
    )
    # the feature side is bounded by weeks × families: the entity rows stay where they are
    return join_small(keyed, renamed, [family_col, "_monday"], "left").drop("_monday")
