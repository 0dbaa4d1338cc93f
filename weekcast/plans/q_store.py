"""Queries: sinks, snapshots, keyed upserts, views and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features
from ..sources import clustered, keyed, store
from . import sqltext as q
from . import views
from .catalog import query

WEEKLY = f"{q.SALES_LINES}, {q.weekly(7)}"
STORE_SQL = f"""{WEEKLY},
store_old as (select * from weekly where week_start < date '2001-01-01'),
store_new as (select year, week, familia, base_imponible * 1.1 as base_imponible, is_summer_peak, is_easter,
                     dias_semana, week_start from weekly where week_start >= date '2000-12-01')"""
KEYS = ("familia", "week_start")
WEEKLY_SCHEMA = T.StructType(
    [
        T.StructField("year", T.LongType()),
        T.StructField("week", T.LongType()),
        T.StructField("familia", T.StringType()),
        T.StructField("base_imponible", T.DoubleType()),
        T.StructField("is_summer_peak", T.IntegerType()),
        T.StructField("is_easter", T.IntegerType()),
        T.StructField("dias_semana", T.LongType()),
        T.StructField("week_start", T.DateType()),
    ]
)


def _weekly(spark, sf_dir):
    return views.weekly(spark, sf_dir, 7)


def _stores(spark, sf_dir):
    w = _weekly(spark, sf_dir)
    old = w.where(F.col("week_start") < F.lit("2001-01-01").cast("date"))
    new = w.where(F.col("week_start") >= F.lit("2000-12-01").cast("date")).withColumn(
        "base_imponible", F.col("base_imponible") * F.lit(1.1)
    )
    return old, new


@query("dated_sink", f"with {WEEKLY} select *, date '2001-11-05' as run_date from weekly")
def dated_sink(spark, sf_dir):
    """Weekly table written under run_date=/familia= partitions and read back."""
    path = store.new_location(spark, "weekly")
    w = _weekly(spark, sf_dir)
    store.write_dated(w, path, "2001-11-05")
    return store.read_dated(spark, path, store.dated_schema(w))


@query("latest_snapshot", f"with {WEEKLY} select *, date '2001-11-12' as run_date from weekly")
def latest_snapshot(spark, sf_dir):
    """An older snapshot (amounts ×0.9) and a newer one; the reader picks the newest."""
    path = store.new_location(spark, "snapshots")
    w = _weekly(spark, sf_dir)
    store.write_dated(w.withColumn("base_imponible", F.col("base_imponible") * 0.9), path, "2001-11-05")
    store.write_dated(w, path, "2001-11-12")
    return store.read_latest(spark, path, store.dated_schema(w))


@query(
    "upsert_latest",
    f"""with {STORE_SQL}
select * from store_new
union all
select * from store_old o where not exists (select 1 from store_new n where n.familia = o.familia and n.week_start = o.week_start)""",
)
def upsert_latest(spark, sf_dir):
    """Keyed insert of an overlapping batch; incoming rows win."""
    old, new = _stores(spark, sf_dir)
    return store.upsert_latest(old, new, KEYS)


@query(
    "upsert_store",
    f"""with {STORE_SQL}
select * from store_new
union all
select * from store_old o where not exists (select 1 from store_new n where n.familia = o.familia and n.week_start = o.week_start)""",
)
def upsert_store(spark, sf_dir):
    """A batch that repeats every key is deduplicated by load order, upserted, written as the next version and read back."""
    old, new = _stores(spark, sf_dir)
    path = store.new_location(spark, "keyed")
    store.write_dated(old, path, "2001-10-29")
    twice = new.withColumn("base_imponible", F.col("base_imponible") * 0).withColumn("load", F.lit(1)).union(new.withColumn("load", F.lit(2)))
    batch = store.latest_of(twice, KEYS, ["load"]).drop("load")
    return store.upsert_store(spark, path, batch, KEYS, "2001-11-05")


@query(
    "keyed_store",
    f"""with {STORE_SQL}
select * from store_new
union all
select * from store_old o where not exists (select 1 from store_new n where n.familia = o.familia and n.week_start = o.week_start)""",
)
def keyed_store(spark, sf_dir):
    """The same upsert over a store with a manifest of key ranges: only the files of the batch's weeks are rewritten."""
    old, new = _stores(spark, sf_dir)
    keys = ["week_start", "familia"]
    columns = [*keys, *[c for c in old.columns if c not in keys]]
    old, new = old.select(*columns), new.select(*columns)
    path = store.new_location(spark, "keyed-files")
    keyed.upsert(spark, path, old, keys, rows_per_file=100)
    twice = new.withColumn("base_imponible", F.col("base_imponible") * 0).withColumn("load", F.lit(1)).union(new.withColumn("load", F.lit(2)))
    keyed.upsert(spark, path, store.latest_of(twice, keys, ["load"]).drop("load"), keys, rows_per_file=100)
    return keyed.read(spark, path, new.schema)


@query(
    "incremental_new_weeks",
    f"""with {STORE_SQL}
select * from store_new n where not exists (select 1 from store_old o where o.familia = n.familia and o.week_start = n.week_start)""",
)
def incremental_new_weeks(spark, sf_dir):
    """Only the weeks not stored yet."""
    old, new = _stores(spark, sf_dir)
    return store.new_rows(new, old, KEYS)


@query(
    "store_profile",
    f"""with {WEEKLY}
select familia, cast(count(*) as bigint) as n_rows, min(week_start) as first_week, max(week_start) as last_week
from weekly group by familia""",
)
def store_profile(spark, sf_dir):
    """Rows and week range of the stored weekly group."""
    return store.profile(_weekly(spark, sf_dir))


FEATURE_VIEW_COLS = ("familia", "week_start", "base_imponible_lag1", "base_imponible_lag52", "is_easter", "target")


@query(
    "feature_view",
    f"with {WEEKLY}, {q.features((1, 2, 3, 52), 1)} select {', '.join(FEATURE_VIEW_COLS)} from features",
)
def feature_view(spark, sf_dir):
    """A named view = saved column subset of the feature table."""
    ft = features.feature_table(_weekly(spark, sf_dir), (1, 2, 3, 52), 1)
    return store.register_view(ft, "weekcast_feature_view", FEATURE_VIEW_COLS)


@query(
    "batch_read",
    f"""with {WEEKLY}, {q.features((1, 2, 3, 52), 1)}
select week_start, familia, base_imponible_lag1, target from features
where week_start between date '1999-01-01' and date '2000-12-31' order by week_start""",
)
def batch_read(spark, sf_dir):
    """Ordered batch read of a view between two dates with a feature list."""
    ft = features.feature_table(_weekly(spark, sf_dir), (1, 2, 3, 52), 1)
    store.register_view(ft, "weekcast_features_all")
    return store.batch_read(
        spark, "weekcast_features_all", "1999-01-01", "2000-12-31", ["week_start", "familia", "base_imponible_lag1", "target"]
    )


@query(
    "chart_data",
    f"""with {WEEKLY},
preds as (select familia, cast(max(week_start) + 7 as date) as week_start,
                 arg_max(base_imponible, week_start) as predicted_base_imponible from weekly group by familia)
select familia, strftime(week_start, '%Y-%m-%d') as date, base_imponible as value, 'actual' as series from weekly
union all
select familia, strftime(week_start, '%Y-%m-%d') as date, predicted_base_imponible as value, 'predicted' as series from preds""",
)
def chart_data(spark, sf_dir):
    """History plus the next-week (naive lag-1) prediction as chart records."""
    w = _weekly(spark, sf_dir)
    nxt = features.next_week_features(w, (1,)).select(
        "familia", "week_start", F.col("base_imponible_lag1").alias("predicted_base_imponible")
    )
    return store.chart_data(w, nxt)


@query(
    "enforce_schema",
    f"""with {WEEKLY}
select cast(year as bigint) as year, cast(week as bigint) as week, familia, cast(base_imponible as double) as base_imponible,
       cast(is_summer_peak as integer) as is_summer_peak, cast(is_easter as integer) as is_easter,
       cast(dias_semana as bigint) as dias_semana, week_start from weekly""",
)
def enforce_schema(spark, sf_dir):
    """Required-column check and cast to the stored schema."""
    return store.enforce_schema(_weekly(spark, sf_dir), WEEKLY_SCHEMA)


@query("csv_roundtrip", f"with {WEEKLY} select * from weekly")
def csv_roundtrip(spark, sf_dir):
    """CSV sink with header, read back with the schema."""
    path = store.new_location(spark, "csv")
    w = store.enforce_schema(_weekly(spark, sf_dir), WEEKLY_SCHEMA)
    store.write_csv(w, path)
    return store.read_csv(spark, path, WEEKLY_SCHEMA)


@query("table_append", f"with {WEEKLY} select * from weekly union all select * from weekly")
def table_append(spark, sf_dir):
    """Replace, then append the same batch: every row twice."""
    path = store.new_location(spark, "table")
    w = _weekly(spark, sf_dir)
    store.write_table(w, path, "overwrite")
    store.write_table(w, path, "append")
    return spark.read.schema(w.schema).parquet(path)


@query(
    "week_reconcile",
    f"""with {q.SALES_LINES}, {q.weekly(7)}, {q.weekly(1, name="weekly_all")},
e as (select distinct familia, week_start from weekly_all),
p as (select distinct familia, week_start from weekly)
select coalesce(e.familia, p.familia) as familia, coalesce(e.week_start, p.week_start) as week_start,
       case when p.familia is null then 'missing_in_processed' else 'unexpected_in_processed' end as status
from e full outer join p on e.familia = p.familia and e.week_start = p.week_start
where e.familia is null or p.familia is null""",
)
def week_reconcile(spark, sf_dir):
    """Weeks with sales that the complete-week table dropped (and the reverse)."""
    return store.reconcile(views.weekly(spark, sf_dir, 1), _weekly(spark, sf_dir), KEYS)


@query(
    "typed_parquet_scan",
    """select l_orderkey, l_linenumber, cast(l_shipdate as date) as l_shipdate from lineitem""",
)
def typed_parquet_scan(spark, sf_dir):
    """Whole-table Parquet scan with its date column coerced to DATE."""
    from ..sources import tables

    df = tables.read_typed_parquet(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", date_cols=("l_shipdate",))
    return df.select("l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "xy_sink",
    f"""with {WEEKLY}, {q.features((1, 2, 3, 52), 1)}
select x.*, y.target from
  (select familia, week_start, base_imponible_lag1, base_imponible_lag2, base_imponible_lag3, base_imponible_lag52,
          is_summer_peak, is_easter from features) x
  join (select familia, week_start, target from features) y using (familia, week_start)""",
)
def xy_sink(spark, sf_dir):
    """The feature table written once as X, y and full datasets (dated); X and y re-joined on the key."""
    ft = features.feature_table(_weekly(spark, sf_dir), (1, 2, 3, 52), 1)
    keys = ["familia", "week_start"]
    x_cols = [c for c in ft.columns if c not in ("target", "base_imponible")]
    base = store.new_location(spark, "xy")
    parts = {"X": ft.select(*x_cols), "y": ft.select(*keys, "target"), "full": ft}
    for name, part in parts.items():
        store.write_dated(part, f"{base}/{name}", "2001-11-05")
    x = store.read_dated(spark, f"{base}/X", store.dated_schema(parts["X"])).drop("run_date")
    y = store.read_dated(spark, f"{base}/y", store.dated_schema(parts["y"])).drop("run_date")
    return x.join(y, keys)


@query(
    "sample_row",
    f"""with {WEEKLY}, {q.features((1, 2, 3, 52), 1)}
select familia, week_start, base_imponible, base_imponible_lag1, base_imponible_lag2, base_imponible_lag3, base_imponible_lag52,
       is_summer_peak, is_easter, target
from features order by md5(familia || '|' || strftime(week_start, '%Y-%m-%d')), familia, week_start limit 1""",
)
def sample_row(spark, sf_dir):
    """One reproducible sample row of the feature table (md5 order; the limit is the feature)."""
    ft = features.feature_table(_weekly(spark, sf_dir), (1, 2, 3, 52), 1)
    mark = F.md5(F.concat_ws("|", "familia", F.date_format("week_start", "yyyy-MM-dd")).cast("binary"))
    return ft.orderBy(mark, "familia", "week_start").limit(1)


def _clustered(spark, sf_dir):
    path = store.new_location(spark, "clustered")
    clustered.write_clustered(views.sales(spark, sf_dir), path)
    return path


@query(
    "clustered_scan",
    f"""with {q.SALES_LINES}
select fecha, familia, count(*) as n_rows, cast(sum(base_imponible) as double) as base_imponible, cast(sum(total) as double) as total
from sales where fecha between date '1995-06-01' and date '1996-03-31' and familia in ('PROMO', 'SMALL') group by all""",
)
def clustered_scan(spark, sf_dir):
    """A date range of two families from lines clustered by day and family."""
    found = clustered.scan(spark, _clustered(spark, sf_dir), "1995-06-01", "1996-03-31", families=["PROMO", "SMALL"])
    sums = [F.sum(c).cast("double").alias(c) for c in ("base_imponible", "total")]
    return found.groupBy("fecha", "familia").agg(F.count(F.lit(1)).alias("n_rows"), *sums)


@query(
    "clustered_lookup",
    f"""with {q.SALES_LINES}
select n_factura, fecha, familia, cast(base_imponible as double) as base_imponible
from sales where n_factura = (select n_factura from sales order by total desc, n_factura limit 1)""",
)
def clustered_lookup(spark, sf_dir):
    """The lines of the invoice with the dearest line, found by Bloom filters of row groups ordered by day and family."""
    path = _clustered(spark, sf_dir)
    dearest = spark.read.parquet(path).orderBy(F.desc("total"), "n_factura").select("n_factura").first()
    found = clustered.scan(spark, path, invoices=[r for r in dearest or []])
    return found.select("n_factura", "fecha", "familia", F.col("base_imponible").cast("double").alias("base_imponible"))
