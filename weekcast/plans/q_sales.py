"""Queries: scans, cleaning, roll-ups, calendar functions (S1–S4, S7, P*, C*, A1–A5, A18, A19, J1–J3, J7, J9, W8, F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import dates
from ..operators import clean, rollup
from ..sources import bucketed, tables
from . import sqltext as q
from . import views
from .catalog import query

# Parameters of the test fixture (FIXTURES.md): label variant, families, dirty month.
FIXTURE_FAMILIES = q.FIXTURE_FAMILIES
FIXTURE_REMAP = {"ECONOM": "ECONOMY"}
DIRTY_MONTH, NEIGHBOURS, DIRTY_YEAR = "1997-11-01", ("1997-10-01", "1997-12-01"), 1997
MONEY = ("base_imponible", "tipo_iva", "total")


def _money_double(df, cols=MONEY):
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})


def _money_sql(cols=MONEY):
    return ", ".join(f"cast({c} as double) as {c}" for c in cols)


def _homog(spark, sf_dir):
    return clean.homogenize(views.sales_dirty(spark, sf_dir), FIXTURE_FAMILIES, FIXTURE_REMAP)


def _imputed(spark, sf_dir, method="mean_of_means"):
    return clean.impute_family_month(_homog(spark, sf_dir), DIRTY_MONTH, NEIGHBOURS, DIRTY_YEAR, cols=MONEY, method=method)


def _imputed_sql(method="mean_of_means"):
    scales = {"base_imponible": 4, "tipo_iva": 2, "total": 6}
    steps = q.imputed("homog", scales, DIRTY_MONTH, NEIGHBOURS, DIRTY_YEAR, method=method)
    return f"{q.sales_lines()}, {q.sales_dirty(False)}, {q.homogenized()}, {steps}"


_IMPUTED_SQL = _imputed_sql()


# ---------------------------------------------------------------- roll-ups


@query("weekly_series", f"with {q.SALES_LINES}, {q.weekly(7)} select * from weekly")
def weekly_series(spark, sf_dir):
    """A1 with complete weeks only (7 distinct days)."""
    return views.weekly(spark, sf_dir, min_days=7)


@query("weekly_all", f"with {q.SALES_LINES}, {q.weekly(1)} select * from weekly")
def weekly_all(spark, sf_dir):
    """A1 with the flexible threshold (any week with a sale day)."""
    return views.weekly(spark, sf_dir, min_days=1)


@query("bucketed_weekly", f"with {q.SALES_LINES}, {q.weekly(7)} select * from weekly")
def bucketed_weekly(spark, sf_dir):
    """A1/J1 over lines and parts that are bucketed by part key: the join shuffles nothing."""
    return rollup.weekly_rollup(cal.add_calendar_flags(bucketed.bucketed_lines(spark, sf_dir)), min_days=7)


@query(
    "sales_to_weekly",
    f"""with {_IMPUTED_SQL}, {q.weekly(7, src="imputed")} select * from weekly""",
)
def sales_to_weekly(spark, sf_dir):
    """A2: dirty lines → homogenise → impute → flags → complete-week roll-up, all families at once."""
    return rollup.weekly_rollup(cal.add_calendar_flags(_imputed(spark, sf_dir)), min_days=7)


@query("daily_series", f"with {q.SALES_LINES}, {q.daily()} select * from daily")
def daily_series(spark, sf_dir):
    return views.daily(spark, sf_dir)


@query(
    "weekly_resample",
    f"""with {q.SALES_LINES}, {q.daily(exact=True)},
sums as (select {q.sunday_label('fecha')} as label, familia, sum(base_imponible) as base_imponible,
                sum(total) as total, sum(is_easter) as is_easter, sum(is_summer_peak) as is_summer_peak
         from daily group by all),
spine as (select familia, cast(unnest(generate_series(min(label), max(label), interval 7 day)) as date) as label
          from sums group by familia)
select s.label as fecha, s.familia,
       coalesce(cast(m.base_imponible as double), 0) as base_imponible, coalesce(cast(m.total as double), 0) as total,
       coalesce(cast(m.is_easter as double), 0) as is_easter, coalesce(cast(m.is_summer_peak as double), 0) as is_summer_peak
from spine s left join sums m on s.label = m.label and s.familia = m.familia""",
)
def weekly_resample(spark, sf_dir):
    return rollup.weekly_resample(views.daily(spark, sf_dir, keep_decimal=True))


@query(
    "monthly_spine",
    f"""with {q.SALES_LINES}, {q.daily(exact=True)},
sums as (select last_day(fecha) as label, familia, sum(base_imponible) as base_imponible,
                sum(total) as total, sum(is_easter) as is_easter, sum(is_summer_peak) as is_summer_peak
         from daily group by all),
months as (select last_day(cast(m as date)) as label from
           (select unnest(generate_series(date_trunc('month', min(fecha)), max(fecha), interval 1 month)) as m,
                   max(fecha) as hi from daily) where last_day(cast(m as date)) <= (select max(fecha) from daily)),
spine as (select label, familia from months, (select distinct familia from daily))
select s.label as fecha, s.familia,
       coalesce(cast(m.base_imponible as double), 0) as base_imponible, coalesce(cast(m.total as double), 0) as total,
       coalesce(cast(m.is_easter as double), 0) as is_easter, coalesce(cast(m.is_summer_peak as double), 0) as is_summer_peak
from spine s left join sums m on s.label = m.label and s.familia = m.familia""",
)
def monthly_spine(spark, sf_dir):
    return rollup.monthly_spine(views.daily(spark, sf_dir, keep_decimal=True))


@query(
    "week_completeness",
    f"""with {q.SALES_LINES}
select cast(isoyear(fecha) as bigint) as year, cast(week(fecha) as bigint) as week, familia,
       cast(count(distinct fecha) as bigint) as dias, min(fecha) as first_day, max(fecha) as last_day
from sales group by all""",
)
def week_completeness(spark, sf_dir):
    """Distinct days per ISO week and family with the first/last day seen."""
    s = views.sales(spark, sf_dir)
    return s.groupBy(
        cal.iso_year("fecha").cast("bigint").alias("year"), cal.iso_week("fecha").cast("bigint").alias("week"), "familia"
    ).agg(
        F.count_distinct("fecha").cast("bigint").alias("dias"),
        F.min("fecha").alias("first_day"),
        F.max("fecha").alias("last_day"),
    )


@query(
    "days_histogram",
    f"""with {q.SALES_LINES}
select dias, cast(count(*) as bigint) as n_weeks from (
  select cast(count(distinct fecha) as bigint) as dias from sales group by isoyear(fecha), week(fecha), familia)
group by dias""",
)
def days_histogram(spark, sf_dir):
    """How many family-weeks have 1…7 sale days."""
    return week_completeness(spark, sf_dir).groupBy("dias").agg(F.count("*").cast("bigint").alias("n_weeks"))


@query(
    "rows_per_day",
    f"""with {q.SALES_LINES}
select fecha, cast(count(*) as bigint) as n_rows, cast(count(distinct familia) as bigint) as n_families
from sales group by fecha""",
)
def rows_per_day(spark, sf_dir):
    return views.sales(spark, sf_dir).groupBy("fecha").agg(
        F.count("*").cast("bigint").alias("n_rows"), F.count_distinct("familia").cast("bigint").alias("n_families")
    )


@query(
    "easter_days",
    f"""with {q.SALES_LINES}
select cast(year(fecha) as integer) as year, cast(count(distinct fecha) as bigint) as n_days,
       min(fecha) as first_day, max(fecha) as last_day
from sales where {q.is_holy_week('fecha')} = 1 group by 1""",
)
def easter_days(spark, sf_dir):
    """Holy-Week days present per year (7 when no day is missing)."""
    s = views.sales(spark, sf_dir).where(cal.is_holy_week("fecha") == 1)
    return s.groupBy(F.year("fecha").alias("year")).agg(
        F.count_distinct("fecha").cast("bigint").alias("n_days"),
        F.min("fecha").alias("first_day"),
        F.max("fecha").alias("last_day"),
    )


# ---------------------------------------------------------------- scans and filters


@query(
    "scan_range",
    f"""with {q.SALES_FULL}
select fecha, n_factura, zona_de_venta, producto, familia, cantidad, {_money_sql()}
from sales where fecha between date '1997-01-01' and date '1998-12-31'""",
)
def scan_range(spark, sf_dir):
    """Nine-column projection over an inclusive date range (filter pushed to the scan)."""
    df = tables.scan_range(views.sales_full(spark, sf_dir), "1997-01-01", "1998-12-31", columns=tables.SALES_COLUMNS)
    return _money_double(df)


@query(
    "full_scan",
    f"""with {q.SALES_FULL}
select fecha, n_factura, zona_de_venta, producto, familia, cantidad, {_money_sql()}
from sales""",
)
def full_scan(spark, sf_dir):
    """Unbounded scan of the whole table."""
    return _money_double(tables.scan_range(views.sales_full(spark, sf_dir), None, None, columns=tables.SALES_COLUMNS))


@query(
    "upper_bounded_scan",
    f"""with {q.SALES_FULL}
select fecha, n_factura, zona_de_venta, producto, familia, cantidad, {_money_sql()}
from sales where fecha < date '2001-07-01'""",
)
def upper_bounded_scan(spark, sf_dir):
    """Open-ended scan with only an upper bound."""
    df = tables.scan_range(views.sales_full(spark, sf_dir), None, None, columns=tables.SALES_COLUMNS)
    return _money_double(df.where(F.col("fecha") < F.lit("2001-07-01").cast("date")))


@query(
    "history_union",
    f"""with {q.sales_lines("archive")}, {q.sales_full("live")}
select fecha, n_factura, cast(null as varchar) as zona_de_venta, producto, familia, cast(base_imponible as double) as base_imponible
from archive
union all
select fecha, n_factura, zona_de_venta, producto, familia, cast(base_imponible as double) as base_imponible
from live where fecha >= date '2000-01-01'""",
)
def history_union(spark, sf_dir):
    """The whole archive (no zone column) ∪ live table from the cutoff, by name."""
    cols = ["fecha", "n_factura", "producto", "familia", "base_imponible"]
    archive = views.sales(spark, sf_dir).select(*cols)
    live = views.sales_full(spark, sf_dir).select(*cols, "zona_de_venta")
    out = tables.history_union(archive, live, "2000-01-01")
    return _money_double(out.select("fecha", "n_factura", "zona_de_venta", "producto", "familia", "base_imponible"))


@query(
    "filter_date_range",
    f"""with {q.SALES_LINES}
select fecha, n_factura, familia, cast(base_imponible as double) as base_imponible
from sales where fecha >= date '1999-06-01'""",
)
def filter_date_range(spark, sf_dir):
    """Lower bound only; the open upper bound is the data's max."""
    df = clean.filter_date_range(views.sales(spark, sf_dir), start="1999-06-01")
    return _money_double(df.select("fecha", "n_factura", "familia", "base_imponible"))


@query(
    "family_filter",
    f"""with {q.SALES_LINES}
select fecha, n_factura, familia, cast(base_imponible as double) as base_imponible
from sales where familia = 'PROMO'""",
)
def family_filter(spark, sf_dir):
    """One family."""
    df = clean.filter_family(views.sales(spark, sf_dir), "PROMO")
    return _money_double(df.select("fecha", "n_factura", "familia", "base_imponible"))


@query(
    "homogenize",
    f"""with {q.SALES_LINES}, {q.sales_dirty(False)}, {q.homogenized()}
select fecha, n_factura, producto, familia, {_money_sql(("base_imponible", "total"))} from homog""",
)
def homogenize(spark, sf_dir):
    """C4 (P3, P5, F10): remap label, upper/trim product, family allow-list."""
    df = _homog(spark, sf_dir)
    return _money_double(df.select("fecha", "n_factura", "producto", "familia", "base_imponible", "total"))


@query(
    "deny_list",
    f"""with {q.SALES_LINES}, {q.sales_dirty(False)}
select fecha, n_factura, familia from sales_dirty where familia is not null and familia not in ('7', 'cerrado')""",
)
def deny_list(spark, sf_dir):
    """Drop junk labels and nulls (pandas ``~isin([..., None])``)."""
    df = clean.deny_list(views.sales_dirty(spark, sf_dir), ["7", "cerrado", None])
    return df.select("fecha", "n_factura", "familia")


@query(
    "fill_nulls",
    f"""with {q.SALES_LINES}, {q.sales_dirty(False)}
select fecha, n_factura, familia, cast(coalesce(base_imponible, 0) as double) as base_imponible,
       cast(coalesce(total, 0) as double) as total from sales_dirty""",
)
def fill_nulls(spark, sf_dir):
    """Per-column constant fill of the amounts."""
    df = clean.fill_nulls(views.sales_dirty(spark, sf_dir), {"base_imponible": 0, "total": 0})
    return _money_double(df.select("fecha", "n_factura", "familia", "base_imponible", "total"))


@query(
    "drop_incomplete",
    f"""with {q.SALES_LINES}, {q.sales_dirty(False)}
select fecha, n_factura, familia, {_money_sql(("base_imponible", "total"))} from sales_dirty
where familia is not null and base_imponible is not null and total is not null""",
)
def drop_incomplete(spark, sf_dir):
    """Drop rows with any null."""
    df = clean.drop_incomplete(views.sales_dirty(spark, sf_dir).select("fecha", "n_factura", "familia", "base_imponible", "total"))
    return _money_double(df)


@query(
    "trim_complete_weeks",
    f"""with {q.SALES_LINES}, cut as (select * from sales where fecha <= date '2001-10-31')
select fecha, n_factura, familia from cut
where fecha <= (select max(fecha) - cast(isodow(max(fecha)) % 7 as integer) from cut)""",
)
def trim_complete_weeks(spark, sf_dir):
    """A scan ending mid-week, trimmed to its last complete Sunday."""
    cut = clean.filter_date_range(views.sales(spark, sf_dir), end="2001-10-31")
    return clean.trim_complete_weeks(cut).select("fecha", "n_factura", "familia")


@query(
    "previous_week",
    f"""with {q.SALES_LINES}
select fecha, n_factura, familia, cast(base_imponible as double) as base_imponible from sales
where fecha between date '2001-10-22' and date '2001-10-28'""",
)
def previous_week(spark, sf_dir):
    """P10: the Mon–Sun week before the as-of date's week (as-of = 2001-10-31)."""
    df = clean.previous_week(views.sales(spark, sf_dir), "2001-10-31")
    return _money_double(df.select("fecha", "n_factura", "familia", "base_imponible"))


# ---------------------------------------------------------------- gaps and imputation


@query(
    "missing_dates",
    f"""with {q.SALES_LINES}, {q.sales_dirty(False)}
select cast(d as date) as fecha from (select unnest(generate_series(min(fecha), max(fecha), interval 1 day)) as d from sales_dirty)
where cast(d as date) not in (select fecha from sales_dirty)""",
)
def missing_dates(spark, sf_dir):
    """Dates between the data's first and last day with no invoice line."""
    return clean.missing_dates(views.sales_dirty(spark, sf_dir))


@query(
    "fill_closed_days",
    f"""with {q.SALES_LINES}, {q.sales_dirty(False)},
gaps as (select cast(d as date) as fecha from (select unnest(generate_series(min(fecha), max(fecha), interval 1 day)) as d from sales_dirty)
         where cast(d as date) not in (select fecha from sales_dirty))
select fecha, n_factura, producto, familia, cantidad, {_money_sql()}, 0 as is_closed from sales_dirty
union all
select fecha, 'cerrado', 'cerrado', 'cerrado', 0.0, 0.0, 0.0, 0.0, 1 from gaps""",
)
def fill_closed_days(spark, sf_dir):
    """Add one ``cerrado`` row per missing date; afterwards no date is missing."""
    df = views.sales_dirty(spark, sf_dir)
    out = clean.fill_closed_days(df, clean.missing_dates(df))
    return _money_double(out).withColumn("is_closed", F.col("is_closed").cast("int"))


@query(
    "impute_family_month",
    f"""with {_IMPUTED_SQL}
select fecha, n_factura, familia, {_money_sql()}, is_imputed from imputed""",
)
def impute_family_month(spark, sf_dir):
    """November-1997 nulls filled per family from Oct/Dec means, then the 1997 mean."""
    return _money_double(_imputed(spark, sf_dir).select("fecha", "n_factura", "familia", *MONEY, "is_imputed"))


@query(
    "impute_pooled",
    f"""with {_imputed_sql("pooled")}
select fecha, n_factura, familia, {_money_sql()}, is_imputed from imputed""",
)
def impute_pooled(spark, sf_dir):
    """C3 pooled: one mean over all rows of the neighbour months, then the year mean."""
    return _money_double(_imputed(spark, sf_dir, "pooled").select("fecha", "n_factura", "familia", *MONEY, "is_imputed"))


@query(
    "impute_sequential",
    f"""with {_imputed_sql("sequential")}
select fecha, n_factura, familia, {_money_sql()}, is_imputed from imputed""",
)
def impute_sequential(spark, sf_dir):
    """C3 sequential: the first neighbour month with a mean wins, then the year mean."""
    return _money_double(_imputed(spark, sf_dir, "sequential").select("fecha", "n_factura", "familia", *MONEY, "is_imputed"))


@query(
    "first_per_key",
    f"""with {q.sales_lines()}
select fecha, l_orderkey, l_linenumber, l_partkey, l_suppkey, base_imponible from (
  select fecha, cast(n_factura as bigint) as l_orderkey, l_linenumber, l_partkey, l_suppkey,
         cast(base_imponible as double) as base_imponible,
         row_number() over (partition by fecha order by cast(n_factura as bigint), l_linenumber, l_partkey, l_suppkey, base_imponible) as rn
  from sales) where rn = 1""",
)
def first_per_key(spark, sf_dir):
    """First invoice line per day under an explicit total order (partial-aggregated min of a struct)."""
    s = views.sales(spark, sf_dir, with_keys=True).select(
        "fecha",
        F.col("n_factura").cast("bigint").alias("l_orderkey"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("base_imponible").cast("double").alias("base_imponible"),
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "base_imponible"]
    return clean.first_by_order(s, ["fecha"], order)


# ---------------------------------------------------------------- scalar functions


@query(
    "calendar_features",
    f"""with days as (select distinct cast(l_shipdate as date) as fecha from lineitem)
select fecha,
       cast(isoyear(fecha) as integer) as iso_year, cast(week(fecha) as integer) as iso_week,
       {q.monday('fecha')} as week_monday,
       cast(make_date(cast(isoyear(fecha) as integer), 1, 4) - cast(isodow(make_date(cast(isoyear(fecha) as integer), 1, 4)) - 1 as integer)
            + cast(7 * (week(fecha) - 1) as integer) as date) as monday_from_iso,
       {q.sunday_label('fecha')} as week_sunday,
       cast({q.dow('fecha')} as integer) as day_of_week, cast(month(fecha) as integer) as month,
       cast(year(fecha) as integer) as year, cast({q.dow('fecha')} in (5, 6) as integer) as is_weekend,
       {q.is_summer('fecha')} as is_summer_peak, {q.easter_sunday('year(fecha)')} as easter_sunday,
       {q.is_holy_week('fecha')} as is_easter, {q.is_easter_window('fecha')} as is_easter_window,
       cast(date_trunc('month', fecha) as date) as month_start, cast(fecha + 7 as date) as next_week,
       strftime(fecha, '%Y-%m-%d') as fecha_text, concat_ws('-', isoyear(fecha), week(fecha)) as year_week
from days""",
)
def calendar_features(spark, sf_dir):
    """F1, F4–F16, F18 on every ship date."""
    days = tables.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("fecha")).distinct()
    d = F.col("fecha")
    return days.select(
        d,
        cal.iso_year(d).cast("int").alias("iso_year"),
        cal.iso_week(d).cast("int").alias("iso_week"),
        cal.week_monday(d).alias("week_monday"),
        cal.monday_of_iso_week(cal.iso_year(d), cal.iso_week(d)).alias("monday_from_iso"),
        cal.week_ending_sunday(d).alias("week_sunday"),
        cal.day_of_week(d).cast("int").alias("day_of_week"),
        F.month(d).cast("int").alias("month"),
        F.year(d).cast("int").alias("year"),
        cal.is_weekend(d).alias("is_weekend"),
        cal.is_summer_peak(d).alias("is_summer_peak"),
        cal.easter_sunday(F.year(d)).alias("easter_sunday"),
        cal.is_holy_week(d).alias("is_easter"),
        cal.is_easter_window(d).alias("is_easter_window"),
        cal.month_start(d).alias("month_start"),
        F.date_add(d, 7).alias("next_week"),
        F.date_format(d, "yyyy-MM-dd").alias("fecha_text"),
        F.concat_ws("-", cal.iso_year(d), cal.iso_week(d)).alias("year_week"),
    )


def _epoch_source(spark, sf_dir):
    """Events with their time as s/ms/us/ns epoch text, plus 0, −1, null and junk cells."""
    ev = tables.table(spark, sf_dir, "events").select("event_id", "ts")
    us = dates.wall_micros("ts")  # epoch micros of the wall-clock value (time-zone independent)
    dirt = F.col("event_id") % 100

    def col(v):
        return (
            F.when(dirt == 0, F.lit("0"))
            .when(dirt == 1, F.lit("-1"))
            .when(dirt == 2, F.lit(None).cast("string"))
            .when(dirt == 3, F.lit("n/a"))
            .otherwise(v.cast("string"))
        )

    return ev.select(
        "event_id",
        col(F.call_function("div", us, F.lit(1000000))).alias("t_s"),
        col(F.call_function("div", us, F.lit(1000))).alias("t_ms"),
        col(us).alias("t_us"),
        col(us * 1000).alias("t_ns"),
    )


def _epoch_sql():
    us = "epoch_us(ts)"

    def col(v, name):
        return (
            f"case when event_id % 100 = 0 then '0' when event_id % 100 = 1 then '-1' "
            f"when event_id % 100 = 2 then null when event_id % 100 = 3 then 'n/a' else cast({v} as varchar) end as {name}"
        )

    src = (
        f"select event_id, {col(f'{us} // 1000000', 't_s')}, {col(f'{us} // 1000', 't_ms')}, "
        f"{col(us, 't_us')}, {col(f'{us} * 1000', 't_ns')} from events"
    )
    conv = []
    for c in ("t_s", "t_ms", "t_us", "t_ns"):
        v = f"(case when try_cast({c} as bigint) > 0 then try_cast({c} as bigint) end)"
        med = f"(select median({v}) from src)"
        micros = (
            f"case when {med} >= 1e17 then {v} // 1000 when {med} >= 1e14 then {v} "
            f"when {med} >= 1e11 then {v} * 1000 else {v} * 1000000 end"
        )
        conv.append(f"make_timestamp({micros}) as {c}")
    return f"with src as ({src}) select event_id, {', '.join(conv)} from src"


@query("coerce_epoch", _epoch_sql())
def coerce_epoch(spark, sf_dir):
    """epoch columns of unknown unit → timestamps; ≤0 and junk → null."""
    return dates.coerce_epoch(_epoch_source(spark, sf_dir), ["t_s", "t_ms", "t_us", "t_ns"])


@query(
    "normalize_date",
    """select event_id,
       strftime(try_strptime(substr(cast(ts as varchar), 1, 10), '%Y-%m-%d'), '%Y-%m-%d') as from_ts,
       coalesce(strftime(try_strptime(substr(props, 1, 10), '%Y-%m-%d'), '%Y-%m-%d'), '1900-01-01') as from_props
from events""",
)
def normalize_date(spark, sf_dir):
    """text dates truncated to 10 characters and validated; a default when invalid."""
    ev = tables.table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        dates.normalize_date(F.col("ts").cast("string")).alias("from_ts"),
        dates.normalize_date(F.col("props"), default="1900-01-01").alias("from_props"),
    )


@query(
    "clean_loader",
    f"""with {q.SALES_LINES}, {q.sales_dirty(False)}
select fecha, n_factura, case when familia = 'ECONOM' then 'ECONOMY' else familia end as familia,
       cast(coalesce(base_imponible, 0) as double) as base_imponible, cast(coalesce(total, 0) as double) as total,
       {q.is_summer('fecha')} as is_summer_peak, 0 as is_easter
from sales_dirty where fecha between date '1996-01-01' and date '2000-12-31'""",
)
def clean_loader(spark, sf_dir):
    """The cleaning loader over a date range (remap, zero-fill, season flag)."""
    df = clean.clean_loader(views.sales_dirty(spark, sf_dir), "1996-01-01", "2000-12-31", FIXTURE_REMAP)
    df = df.select("fecha", "n_factura", "familia", "base_imponible", "total", "is_summer_peak", "is_easter")
    return _money_double(df)


@query(
    "parse_dates",
    """select event_id, cast(try_cast(cast(ts as varchar) as timestamp) as date) as lenient,
       cast(try_strptime(substr(cast(ts as varchar), 1, 10), '%Y-%m-%d') as date) as with_format,
       cast(try_strptime(props, '%Y-%m-%d') as date) as junk
from events""",
)
def parse_dates(spark, sf_dir):
    """lenient text → DATE (NULL on failure), with and without an explicit format."""
    ev = tables.table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        dates.parse_date(F.col("ts").cast("string")).alias("lenient"),
        dates.parse_date(F.substring(F.col("ts").cast("string"), 1, 10), "yyyy-MM-dd").alias("with_format"),
        dates.parse_date(F.col("props"), "yyyy-MM-dd").alias("junk"),
    )
