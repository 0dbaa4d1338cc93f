"""Queries: exploration reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import explore, sketches
from ..operators.joins import join_small
from ..sources import store
from . import sqltext as q
from . import views
from .catalog import query

YEARS = range(1995, 2002)  # ship years of the fixture (pivot columns of the oracle)


def _r(df, digits: dict):
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


# ---------------------------------------------------------------- seasonal totals


@query(
    "sales_by_year_month",
    f"""with {q.SALES_LINES}
select cast(year(fecha) as integer) as year, cast(month(fecha) as integer) as month,
       cast(sum(base_imponible) as double) as total_sales, cast(count(*) as bigint) as n_rows
from sales group by all""",
)
def sales_by_year_month(spark, sf_dir):
    s = views.sales(spark, sf_dir)
    return explore.totals_by(s, [F.year("fecha").cast("int").alias("year"), F.month("fecha").cast("int").alias("month")])


@query(
    "sales_by_year_week",
    f"""with {q.SALES_LINES}
select cast(isoyear(fecha) as integer) as year, cast(week(fecha) as integer) as week,
       cast(sum(base_imponible) as double) as total_sales, cast(count(*) as bigint) as n_rows
from sales group by all""",
)
def sales_by_year_week(spark, sf_dir):
    s = views.sales(spark, sf_dir)
    return explore.totals_by(
        s, [cal.iso_year("fecha").cast("int").alias("year"), cal.iso_week("fecha").cast("int").alias("week")]
    )


@query(
    "sales_by_dow",
    f"""with {q.SALES_LINES}
select cast({q.dow('fecha')} as integer) as day_of_week,
       cast(sum(base_imponible) as double) as total_sales, cast(count(*) as bigint) as n_rows
from sales group by all""",
)
def sales_by_dow(spark, sf_dir):
    s = views.sales(spark, sf_dir)
    return explore.totals_by(s, [cal.day_of_week("fecha").cast("int").alias("day_of_week")])


@query(
    "sales_by_family",
    f"""with {q.SALES_LINES}
select familia, cast(sum(base_imponible) as double) as total_sales, cast(count(*) as bigint) as n_rows
from sales group by all""",
)
def sales_by_family(spark, sf_dir):
    return explore.totals_by(views.sales(spark, sf_dir), ["familia"])


@query(
    "yoy_pivot",
    f"""with {q.SALES_LINES}
select cast(month(fecha) as integer) as month,
       {", ".join(f'cast(sum(case when year(fecha) = {y} then base_imponible end) as double) as "{y}"' for y in YEARS)}
from sales group by all""",
)
def yoy_pivot(spark, sf_dir):
    """Month × year matrix (pivot values discovered from the data)."""
    return explore.yoy_pivot(views.sales(spark, sf_dir))


# ---------------------------------------------------------------- flags and outliers

DAILY_EXACT = f"{q.SALES_LINES}, {q.daily(exact=True)}"


def _daily_exact(spark, sf_dir):
    return views.daily(spark, sf_dir, keep_decimal=True)


@query(
    "mean_by_flag",
    f"""with {DAILY_EXACT},
long as (select familia, base_imponible, flag, value from daily
         cross join lateral (values ('is_weekend', is_weekend), ('is_summer_peak', is_summer_peak),
                                    ('is_easter', is_easter), ('day_of_week', day_of_week)) t(flag, value))
select familia, flag, cast(value as integer) as value,
       cast(sum(base_imponible) as double) / cast(count(base_imponible) as double) as mean_sales,
       cast(count(*) as bigint) as n_days
from long group by all""",
)
def mean_by_flag(spark, sf_dir):
    """Mean daily sales per family and flag value (bar-plot estimator)."""
    return explore.mean_by_flag(_daily_exact(spark, sf_dir))


@query(
    "flag_uplift",
    f"""with {DAILY_EXACT},
long as (select familia, total, flag, value from daily
         cross join lateral (values ('is_summer_peak', is_summer_peak), ('is_easter', is_easter)) t(flag, value)),
m as (select familia, flag,
             cast(sum(case when value = 1 then total end) as double) / nullif(cast(count(case when value = 1 then total end) as double), 0) as mean_on,
             cast(sum(case when value = 0 then total end) as double) / nullif(cast(count(case when value = 0 then total end) as double), 0) as mean_off
      from long group by all)
select familia, flag, mean_on, mean_off, (mean_on - mean_off) / nullif(mean_off, 0) * 100 as uplift_pct from m""",
)
def flag_uplift(spark, sf_dir):
    """Summer and Easter uplift of mean daily totals per family."""
    return explore.flag_uplift(_daily_exact(spark, sf_dir))


IQR_DIGITS = {"q1": 6, "q3": 6, "iqr": 6, "lower_bound": 6, "upper_bound": 6}
DAILY = f"{q.SALES_LINES}, {q.daily()}"
IQR_SQL = f"""{DAILY},
d as (select * from daily where familia <> 'cerrado'),
b as (select familia, quantile_cont(base_imponible, 0.25) as q1, quantile_cont(base_imponible, 0.75) as q3 from d group by familia),
bounds as (select familia, q1, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_bound, q3 + 1.5 * (q3 - q1) as upper_bound from b),
outl as (select d.* from d join bounds using (familia) where d.base_imponible < lower_bound or d.base_imponible > upper_bound)"""


def _daily_clean(spark, sf_dir):
    return views.daily(spark, sf_dir).where(F.col("familia") != "cerrado")


@query(
    "iqr_outliers",
    f"""with {IQR_SQL}
select familia, round(q1, 6) as q1, round(q3, 6) as q3, round(iqr, 6) as iqr,
       round(lower_bound, 6) as lower_bound, round(upper_bound, 6) as upper_bound,
       cast((select count(*) from outl o where o.familia = bounds.familia) as bigint) as n_outliers
from bounds""",
)
def iqr_outliers(spark, sf_dir):
    """A10: 1.5·IQR fences and outlier count per family (daily series)."""
    return _r(explore.iqr_outliers(_daily_clean(spark, sf_dir)), IQR_DIGITS)


@query(
    "outlier_profile",
    f"""with {IQR_SQL}
select familia, month, day_of_week, cast(count(*) as bigint) as n_outliers from outl group by all""",
)
def outlier_profile(spark, sf_dir):
    """Outliers by month × weekday per family."""
    d = _daily_clean(spark, sf_dir)
    out = explore.flag_outliers(d, explore.iqr_bounds(d))
    return out.groupBy("familia", "month", "day_of_week").agg(F.count(F.lit(1)).cast("bigint").alias("n_outliers"))


@query(
    "outlier_flags",
    f"""with {IQR_SQL}
select familia, flag, cast(value as integer) as value, cast(count(*) as bigint) as n_outliers from outl
cross join lateral (values ('is_summer_peak', is_summer_peak), ('is_easter', is_easter), ('is_weekend', is_weekend)) t(flag, value)
group by all""",
)
def outlier_flags(spark, sf_dir):
    """Outliers by each flag value per family (one pass via stack)."""
    d = _daily_clean(spark, sf_dir)
    out = explore.unpivot_flags(explore.flag_outliers(d, explore.iqr_bounds(d)), ("is_summer_peak", "is_easter", "is_weekend"), ["familia"])
    return out.groupBy("familia", "flag", "value").agg(F.count(F.lit(1)).cast("bigint").alias("n_outliers"))


@query(
    "corr_matrix",
    f"""with {DAILY},
pairs as (select x.v as var_x, y.v as var_y from (select unnest({list(explore.CORR_VARS)}) as v) x, (select unnest({list(explore.CORR_VARS)}) as v) y),
long as (select familia, var_x, var_y,
                case var_x {" ".join(f"when '{c}' then cast({c} as double)" for c in explore.CORR_VARS)} end as xv,
                case var_y {" ".join(f"when '{c}' then cast({c} as double)" for c in explore.CORR_VARS)} end as yv
         from daily, pairs)
select familia, var_x, var_y, round(covar_pop(xv, yv) / nullif(stddev_pop(xv) * stddev_pop(yv), 0), 8) as corr
from long group by all""",
)
def corr_matrix(spark, sf_dir):
    """6×6 correlation matrix per family (NULL where a variable is constant)."""
    return explore.correlation_matrix(views.daily(spark, sf_dir)).withColumn("corr", F.round("corr", 8))


# ---------------------------------------------------------------- nulls and profiles

DIRTY = f"{q.SALES_LINES}, {q.sales_dirty(False)}"
DIRTY_COLS = ("fecha", "n_factura", "producto", "familia", "cantidad", "base_imponible", "tipo_iva", "total")


def _dirty(spark, sf_dir):
    return views.sales_dirty(spark, sf_dir).select(*DIRTY_COLS)


@query(
    "null_counts",
    f"""with {DIRTY}
select column_name, n_null from (
  select {", ".join(f"cast(count(*) - count({c}) as bigint) as {c}" for c in DIRTY_COLS)} from sales_dirty)
unpivot (n_null for column_name in ({", ".join(DIRTY_COLS)}))""",
)
def null_counts(spark, sf_dir):
    """Nulls per column of the dirty lines."""
    return explore.null_counts(_dirty(spark, sf_dir))


@query(
    "nulls_by_month_family",
    f"""with {DIRTY}
select cast(date_trunc('month', fecha) as date) as month, familia,
       cast(count(*) - count(base_imponible) as bigint) as null_base_imponible,
       cast(count(*) - count(total) as bigint) as null_total
from sales_dirty group by all""",
)
def nulls_by_month_family(spark, sf_dir):
    """Nulls per month and family."""
    d = _dirty(spark, sf_dir)
    return explore.nulls_by_group(d, [cal.month_start("fecha").alias("month"), "familia"], ["base_imponible", "total"])


def _profile_sql():
    parts = []
    numeric = {"cantidad", "base_imponible", "tipo_iva", "total"}
    for c in DIRTY_COLS:
        is_num = c in numeric
        parts.append(
            f"""select '{c}' as column_name, cast(count(distinct {c}) as bigint) as n_distinct,
       cast(count(*) - count({c}) as bigint) as n_null,
       {f"cast(min({c}) as varchar)" if not is_num else "cast(null as varchar)"} as min_text,
       {f"cast(max({c}) as varchar)" if not is_num else "cast(null as varchar)"} as max_text,
       {f"cast(min({c}) as double)" if is_num else "cast(null as double)"} as min_num,
       {f"cast(max({c}) as double)" if is_num else "cast(null as double)"} as max_num,
       {f"cast(sum({c}) as double) / nullif(cast(count({c}) as double), 0)" if is_num else "cast(null as double)"} as mean_num
from sales_dirty"""
        )
    return f"with {DIRTY} " + "\nunion all\n".join(parts)


@query("column_profile", _profile_sql())
def column_profile(spark, sf_dir):
    """Distinct and null counts and ranges of every column."""
    return explore.column_profile(_dirty(spark, sf_dir))


def _values_sql():
    parts = [f"select '{c}' as column_name, cast({c} as varchar) as value, count(*) as n from sales_dirty where {c} is not null group by {c}" for c in DIRTY_COLS]
    return f"""with {DIRTY}, v as ({" union all ".join(parts)})
select * from v where column_name in (select column_name from v group by column_name having count(*) < 10)"""


@query("value_lists", _values_sql())
def value_lists(spark, sf_dir):
    """The values of every column with fewer than ten, with counts."""
    return explore.value_lists(_dirty(spark, sf_dir))


STATS_DIGITS = {"mean": 4, "std": 4, "q25": 6, "median": 6, "q75": 6}


@query(
    "series_stats",
    f"""with {q.SALES_LINES}, {q.weekly(7)}
select familia, cast(count(base_imponible) as bigint) as n, round(avg(base_imponible), 4) as mean,
       round(stddev_samp(base_imponible), 4) as std, min(base_imponible) as min,
       round(quantile_cont(base_imponible, 0.25), 6) as q25, round(quantile_cont(base_imponible, 0.5), 6) as median,
       round(quantile_cont(base_imponible, 0.75), 6) as q75, max(base_imponible) as max,
       min(week_start) as first_period, max(week_start) as last_period
from weekly group by familia""",
)
def series_stats(spark, sf_dir):
    """describe() of each family's weekly series."""
    return _r(explore.series_stats(views.weekly(spark, sf_dir, 7)), STATS_DIGITS)


# ---------------------------------------------------------------- top-k


@query(
    "top_families",
    f"""with {q.SALES_LINES}
select familia, cast(sum(base_imponible) as double) as total_sales from sales group by familia
order by total_sales desc, familia limit 5""",
)
def top_families(spark, sf_dir):
    """O2: top-5 families by sales (a top-k report: the limit is the feature)."""
    return explore.top_k(views.sales(spark, sf_dir), 5, "base_imponible", "familia")


@query(
    "top_family_weekly",
    f"""with {q.SALES_LINES}, {q.weekly(7)},
top as (select familia from sales group by familia order by sum(base_imponible) desc, familia limit 5)
select * from weekly where familia in (select familia from top)""",
)
def top_family_weekly(spark, sf_dir):
    """O3: weekly series of the top-5 families only (semi join with the k-row key set)."""
    top = explore.top_k(views.sales(spark, sf_dir), 5, "base_imponible", "familia")
    return explore.restrict_to(views.weekly(spark, sf_dir, 7), top, "familia")


# ---------------------------------------------------------------- sketches

SKETCH_RANGE = ("1996-03-01", "1997-10-31")
#: Bounds of the sketches' errors: of a rank, and relative of a distinct count.
RANK_ERROR, DISTINCT_ERROR = 0.02, 0.06


@query(
    "sketch_profile",
    f"""with {q.SALES_LINES},
part as (select * from sales where fecha between date '{SKETCH_RANGE[0]}' and date '{SKETCH_RANGE[1]}')
select familia, cast(count(*) as bigint) as n_rows, cast(0 as bigint) as nulls, cast(min(base_imponible) as double) as least, cast(max(base_imponible) as double) as greatest,
  round(cast(sum(base_imponible) as double) / count(*), 4) as mean, true as q25_within, true as q50_within, true as q75_within, true as distinct_within
from part group by familia""",
)
def sketch_profile(spark, sf_dir):
    """A10/A16/A17 from stored sketches of each day: exact counts and extremes, quantiles and distinct counts within their bounds of the exact ones."""
    lines = views.sales(spark, sf_dir).select("fecha", "familia", "n_factura", "base_imponible")
    path = store.new_location(spark, "sketches")
    store.write_table(sketches.daily_sketches(lines, ["base_imponible"], ["n_factura"]), path)
    found = sketches.profile(spark.read.parquet(path), ["base_imponible"], ["n_factura"], *SKETCH_RANGE)
    own = lines.where(F.col("fecha").between(*(F.lit(d).cast("date") for d in SKETCH_RANGE)))
    own = join_small(own, found, "familia")  # one row a family
    v = F.col("base_imponible").cast("double")
    quarter = {25: "base_imponible_q25", 50: "base_imponible_q50", 75: "base_imponible_q75"}
    ranks = []
    for p, c in quarter.items():  # the share of values up to the estimate, and below it, enclose the wanted rank
        upto, below = F.avg((v <= F.col(c)).cast("int")), F.avg((v < F.col(c)).cast("int"))
        ranks.append(((upto >= p / 100 - RANK_ERROR) & (below <= p / 100 + RANK_ERROR)).alias(f"q{p}_within"))
    exact = F.count_distinct("n_factura")
    near = (F.abs(F.first("n_factura_distinct") - exact) <= DISTINCT_ERROR * exact).alias("distinct_within")
    checked = own.groupBy("familia").agg(*ranks, near)
    names = {"base_imponible_nulls": "nulls", "base_imponible_min": "least", "base_imponible_max": "greatest"}
    out = found.select("familia", "n_rows", *[F.col(a).alias(b) for a, b in names.items()], F.round("base_imponible_mean", 4).alias("mean"))
    return out.join(checked, "familia")
