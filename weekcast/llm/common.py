"""Helpers shared by the operators: tables, written steps, shares by hash, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.session import ensure_checkpoint_dir, shared_path

#: Text characters that one numpy pass of a Python task holds at once (a longer text is a pass of its own).
BATCH_CHARS = 1_000_000

CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once for each application), so that their Python tasks can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    path = os.path.realpath(f"{tempfile.mkdtemp()}/{top.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts lineage and survives lost executors.

    Later steps read the table, so the shuffle files of the write are removed when it ends.
    """
    path = f"{shared_path(df.sparkSession, 'llm')}/{name}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_SHUFFLES, "false")
    conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(CLEAN_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(df: DataFrame) -> None:
    """Replace a :func:`written` table, which no later step reads, by an empty one: its files leave the disk."""
    files = df.inputFiles()
    if files:
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


def kept(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, for small steps of a loop."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def id_remainder(id_col: Column, n: int) -> Column:
    """crc32 of the id's text, modulo ``n`` (null ids count as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def share_below(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) that depends on the values and the seed only (same in every run and retry)."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def by_size(sizes, limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Cut a run of sizes into ranges of at most ``limit`` in all; a larger single one stands alone."""
    first = total = 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if len(sizes) > first:
        yield first, len(sizes)


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (columns a, b): rows (node, root) with the least node of each component.

    Large-star and small-star rounds: each joins every node with the least
    of its neighbours, so the number of rounds grows with the logarithm of
    a component's width.  A hub with a third of all links is a skewed join
    key against one row, which adaptive execution splits; minima are taken
    map-side first.  Each round is checkpointed in the shared folder.
    Nodes without a link to another node have no row.
    """
    cur = kept(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = None
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        cur = kept(
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        now = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
