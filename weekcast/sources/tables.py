"""Table scans and the invoice-line view over the driver tables.

The invoice-line schema (D1) is ``fecha, n_factura, zona_de_venta, producto,
familia, cantidad, base_imponible, tipo_iva, total``.  On the test tables it
is a star join of ``lineitem`` with its dimensions; money stays DECIMAL so
sums are exact and independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SALES_COLUMNS = [
    "fecha",
    "n_factura",
    "zona_de_venta",
    "producto",
    "familia",
    "cantidad",
    "base_imponible",
    "tipo_iva",
    "total",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (filters and projections are pushed down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _net_amount() -> F.Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    return (price * (F.lit(1) - discount)).cast("decimal(18,4)")


def _gross_amount() -> F.Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    return (price * (F.lit(1) - discount) * (F.lit(1) + tax)).cast("decimal(18,6)")


def sales_lines(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    """Invoice lines with family only (lineitem ⋈ part).

    The narrow variant for roll-ups: it needs no orders/customer/nation join,
    so the plan has one shuffle join (or a broadcast when ``part`` is small
    enough for AQE) and reads five lineitem columns.
    """
    return lines_of(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), with_keys)


def lines_of(li: DataFrame, part: DataFrame, with_keys: bool = False) -> DataFrame:
    """Invoice lines with family from a line table and a part table."""
    part = part.select("p_partkey", "p_type", "p_name")
    df = li.join(part, li.l_partkey == part.p_partkey)
    cols = [
        F.to_date("l_shipdate").alias("fecha"),
        F.col("l_orderkey").cast("string").alias("n_factura"),
        F.col("p_name").alias("producto"),
        F.col("p_type").alias("familia"),
        F.col("l_quantity").alias("cantidad"),
        _net_amount().alias("base_imponible"),
        F.col("l_tax").cast("decimal(4,2)").alias("tipo_iva"),
        _gross_amount().alias("total"),
    ]
    if with_keys:
        cols += ["l_partkey", "l_suppkey", "l_linenumber"]
    return df.select(*cols)


def sales(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    """Full invoice-line view (D1) including the sales zone (customer nation)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation has one row per country: a fixed-size dimension, safe to broadcast
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    df = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(orders, li.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
    )
    cols = [
        F.to_date("l_shipdate").alias("fecha"),
        F.col("l_orderkey").cast("string").alias("n_factura"),
        F.col("n_name").alias("zona_de_venta"),
        F.col("p_name").alias("producto"),
        F.col("p_type").alias("familia"),
        F.col("l_quantity").alias("cantidad"),
        _net_amount().alias("base_imponible"),
        F.col("l_tax").cast("decimal(4,2)").alias("tipo_iva"),
        _gross_amount().alias("total"),
    ]
    if with_keys:
        cols += ["l_partkey", "l_suppkey", "l_linenumber"]
    return df.select(*cols)


def dirty(df: DataFrame) -> DataFrame:
    """Inject the reference's known dirt into clean invoice lines.

    A label variant (``ECONOM``), a junk label (``7``), null families, null
    amounts in November 1997, missing days and padded lower-case product
    names.  Needs the ``with_keys`` columns.
    """
    fam = F.col("familia")
    nov97 = F.col("fecha").between(F.lit("1997-11-01").cast("date"), F.lit("1997-11-30").cast("date")) & (
        F.col("l_partkey") % 5 == 0
    )
    return df.where(F.dayofyear("fecha") % 97 != 0).select(
        "fecha",
        "n_factura",
        *(["zona_de_venta"] if "zona_de_venta" in df.columns else []),
        F.concat(F.lit("  "), F.lower("producto"), F.lit(" ")).alias("producto"),
        F.when((fam == "ECONOMY") & (F.col("l_linenumber") == 1), F.lit("ECONOM"))
        .when((fam == "PROMO") & (F.col("l_linenumber") == 7), F.lit("7"))
        .when((F.col("l_suppkey") % 50 == 0) & (F.col("l_linenumber") == 2), F.lit(None).cast("string"))
        .otherwise(fam)
        .alias("familia"),
        "cantidad",
        F.when(nov97, F.lit(None)).otherwise(F.col("base_imponible")).alias("base_imponible"),
        "tipo_iva",
        F.when(nov97, F.lit(None)).otherwise(F.col("total")).alias("total"),
    )


def sales_dirty(spark: SparkSession, sf_dir: str, with_zone: bool = True) -> DataFrame:
    base = sales(spark, sf_dir, with_keys=True) if with_zone else sales_lines(spark, sf_dir, with_keys=True)
    return dirty(base)


def scan_range(df: DataFrame, start=None, end=None, date_col: str = "fecha", columns=None) -> DataFrame:
    """Projection + inclusive date range; either bound may be open."""
    d = F.col(date_col)
    if start is not None:
        df = df.where(d >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(d <= F.lit(end).cast("date"))
    return df.select(*(columns or df.columns))


def read_typed_parquet(spark: SparkSession, path: str, date_cols=("fecha",)) -> DataFrame:
    """Parquet scan with date columns coerced to DATE (extension/str/timestamp alike)."""
    df = spark.read.parquet(path)
    return df.withColumns({c: F.to_date(F.col(c)) for c in date_cols if c in df.columns})


def history_union(archive: DataFrame, live: DataFrame, cutoff, date_col: str = "fecha", cut_archive: bool = False) -> DataFrame:
    """The whole archive ∪ live rows from ``cutoff``; by name, missing columns null.

    ``cut_archive`` also drops archive rows on or after the cutoff and those without a date.
    """
    c = F.lit(cutoff).cast("date")
    old = archive.where(F.col(date_col) < c) if cut_archive else archive
    return old.unionByName(live.where(F.col(date_col) >= c), allowMissingColumns=True)
