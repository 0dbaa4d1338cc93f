"""Line table clustered by two (or more) columns at once (P1, P2, S15): each filter alone skips most row groups.

Every column is cut into ``2 ** bits`` steps that hold about equally many
rows.  The bits of the steps are interleaved to one number, the table's
order: neighbouring rows are near each other in all the columns, so the
least and greatest values that Parquet keeps of each row group are close
together in each of them.  Sorting by (day, family) would serve days alone.
A filter on a column that does not follow this order (an invoice number) is
served by the row groups' Bloom filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..operators.positional import running_sums
from ..session import ensure_checkpoint_dir

CLUSTER_COLUMNS = ("fecha", "familia")
LOOKUP_COLUMNS = ("n_factura",)
BITS = 8

#: Rows of one file, so of one task of the write.
ROWS_PER_FILE = 5_000_000
ROW_GROUP_BYTES = 64 << 20


def interleaved(steps: Sequence[Column], bits: int) -> Column:
    """One number from the ``bits`` low bits of each step, the highest bits of all steps first."""
    if bits * len(steps) > 63:
        raise ValueError(f"{len(steps)} columns of {bits} bits do not fit a bigint")
    out = F.lit(0).cast("bigint")
    for b in range(bits):
        for j, step in enumerate(reversed(steps)):
            bit = F.shiftright(step.cast("bigint"), b).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(steps) + j))
    return out


def cells(df: DataFrame, cols: Sequence[str] = CLUSTER_COLUMNS) -> DataFrame:
    """Rows ``_n`` of each combination of ``cols`` that occurs (as day and family), kept in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).checkpoint()


def with_cluster_key(df: DataFrame, counts: DataFrame, cols: Sequence[str] = CLUSTER_COLUMNS, bits: int = BITS, name: str = "_z") -> DataFrame:
    """Add the interleaved number of ``cols``, whose steps follow from their :func:`cells`; nulls are in the first step."""
    rows = _rows(counts)
    steps = []
    for c in cols:
        values = counts.groupBy(c).agg(F.sum("_n").alias("_n"))
        before = F.col("cum__n") - F.col("_n")
        step = F.floor(before * F.lit(1 << bits) / F.lit(max(1, rows))).cast("int").alias(f"_step_{c}")
        df = join_small(df, running_sums(values, [], c, ["_n"]).where(F.col(c).isNotNull()).select(c, step), c, "left")
        steps.append(F.coalesce(F.col(f"_step_{c}"), F.lit(0)))
    return df.withColumn(name, interleaved(steps, bits)).drop(*[f"_step_{c}" for c in cols])


def _rows(counts: DataFrame) -> int:
    return int(counts.agg(F.sum("_n")).first()[0] or 0)


def write_clustered(
    df: DataFrame,
    path: str,
    cols: Sequence[str] = CLUSTER_COLUMNS,
    lookup: Sequence[str] = LOOKUP_COLUMNS,
    bits: int = BITS,
    rows_per_file: int = ROWS_PER_FILE,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write ``df`` in the interleaved order of ``cols``, with Bloom filters on ``lookup``.

    Files are ranges of (number, ``cols``, ``lookup``): one day of one
    family that holds a third of all rows is cut by its invoices.  Their
    number follows the rows.
    """
    columns = df.columns
    counts = cells(df, cols)
    files = max(1, -(-_rows(counts) // rows_per_file))
    placed = with_cluster_key(df, counts, cols, bits)
    placed = placed.repartitionByRange(files, "_z", *cols, *lookup).sortWithinPartitions("_z", *cols, *lookup)
    out = placed.select(*columns).write.option("parquet.block.size", str(row_group_bytes))
    for c in lookup:
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
    # the filter's size follows each row group's distinct values
    out.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path)


def scan(
    spark: SparkSession,
    path: str,
    start=None,
    end=None,
    families: Sequence[str] | None = None,
    invoices: Sequence[str] | None = None,
) -> DataFrame:
    """Lines of an inclusive date range, of some families and invoices; whatever is None is not filtered."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col("fecha") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("fecha") <= F.lit(end).cast("date"))
    if families is not None:
        df = df.where(F.col("familia").isin(list(families)))
    if invoices is not None:
        df = df.where(F.col("n_factura").isin(list(invoices)))
    return df
