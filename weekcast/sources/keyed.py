"""A keyed store with a manifest of file key ranges (S12, J6): an upsert rewrites only the files that its batch touches.

Layout under ``path``:

* ``data/<batch>/…`` Parquet files, never changed once written;
* ``manifest/version=<n>`` one row a file: file, the least and greatest key, rows;
* the newest complete manifest is the table.  A manifest counts only with
  Spark's ``_SUCCESS`` mark, so a writer that dies half-way leaves the version before it.

The key of a row's place is the first of ``keys`` (e.g. the week); files
hold ranges of it, so a weekly batch meets the last files only.  Files that
no listed version needs can be removed with :func:`vacuum`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import join_small
from .store import latest_of

ROWS_PER_FILE = 5_000_000
_MANIFEST = "file string, least string, greatest string, n_rows bigint"


def _files(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions, oldest first."""
    fs, p = _files(spark, f"{path}/manifest")
    if not fs.exists(p):
        return []
    found = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("version=") and fs.exists(_files(spark, f"{path}/manifest/{name}/_SUCCESS")[1]):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row a file of a version (the newest by default)."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/version={known[-1] if version is None else version}")


def _listed(spark: SparkSession, path: str, schema: StructType, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in files])


def read(spark: SparkSession, path: str, schema: StructType, version: int | None = None, low=None, high=None) -> DataFrame:
    """The rows of a version; ``low`` and ``high`` bound the place key, and files outside are not opened."""
    m = manifest(spark, path, version)
    place = schema.fields[0]
    kind = place.dataType.simpleString()
    if low is not None:
        m = m.where(F.col("greatest").cast(kind) >= F.lit(low).cast(kind))
    if high is not None:
        m = m.where(F.col("least").cast(kind) <= F.lit(high).cast(kind))
    rows = _listed(spark, path, schema, [r.file for r in m.select("file").collect()])  # one row a file
    if low is not None:
        rows = rows.where(F.col(place.name) >= F.lit(low).cast(kind))
    return rows.where(F.col(place.name) <= F.lit(high).cast(kind)) if high is not None else rows


def _write(rows: DataFrame, path: str, place: str, rows_per_file: int) -> DataFrame:
    """Write rows as files over ranges of the place key; their manifest rows."""
    spark = rows.sparkSession
    batch = f"data/{uuid.uuid4().hex[:16]}"
    n = rows.count()
    if not n:
        return spark.createDataFrame([], _MANIFEST)
    parts = max(1, -(-n // rows_per_file))
    dealt = rows.repartitionByRange(parts, place) if parts > 1 else rows.coalesce(1)
    dealt.sortWithinPartitions(place).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/{batch}")
    written = spark.read.schema(rows.schema).parquet(f"{path}/{batch}")
    name = F.concat(F.lit(f"{batch}/"), F.regexp_extract(F.input_file_name(), "([^/]+)$", 1))
    return written.groupBy(name.alias("file")).agg(
        F.min(place).cast("string").alias("least"), F.max(place).cast("string").alias("greatest"), F.count(F.lit(1)).cast("bigint").alias("n_rows")
    )


def upsert(spark: SparkSession, path: str, batch: DataFrame, keys, order_cols=None, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write the next version: the batch's rows win over stored rows with their keys.  Returns the version.

    ``keys[0]`` must be the first column of the table and may not be null.  A
    batch that repeats keys needs ``order_cols`` (its load order).  Only files
    whose key range holds a key of the batch are read and rewritten; the
    others are listed again as they are.
    """
    keys = list(keys)
    place = batch.columns[0]
    if place != keys[0]:
        raise ValueError(f"the first column must be {keys[0]}")
    batch = latest_of(batch, keys, order_cols) if order_cols else batch
    batch = batch.checkpoint()
    if batch.where(F.col(place).isNull()).limit(1).count():
        raise ValueError(f"null {place}")
    kind = batch.schema[place].dataType.simpleString()
    current = manifest(spark, path).checkpoint()
    places = batch.select(F.col(place).alias("_place")).distinct()
    spans = current.select("file", F.col("least").cast(kind).alias("_low"), F.col("greatest").cast(kind).alias("_high"))
    touched = {r.file for r in _meeting(spans, places).collect()}  # one row a file
    old = _listed(spark, path, batch.schema, sorted(touched))
    kept = join_small(old, batch.select(*keys), keys, "left_anti")
    fresh = _write(batch.unionByName(kept), path, place, rows_per_file)
    rest = current.where(~F.col("file").isin(sorted(touched))) if touched else current
    version = (versions(spark, path) or [-1])[-1] + 1
    rest.unionByName(fresh).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
    return version


def _meeting(spans: DataFrame, places: DataFrame) -> DataFrame:
    """Files whose range holds one of the places: the least place at or above a file's low end is not above its high end.

    Both sides in one order, a running look-ahead: no join of ranges.  One row a file and a distinct place of the batch.
    """
    from pyspark.sql import Window

    both = places.select(F.col("_place"), F.lit(1).alias("_is_place"), F.lit(None).cast("string").alias("file"), F.lit(None).cast(places.schema["_place"].dataType).alias("_high"))
    both = both.unionByName(spans.select(F.col("_low").alias("_place"), F.lit(0).alias("_is_place"), "file", "_high"))
    ahead = Window.orderBy("_place", "_is_place").rowsBetween(0, Window.unboundedFollowing)
    following = F.first(F.when(F.col("_is_place") == 1, F.col("_place")), ignorenulls=True).over(ahead)
    return both.withColumn("_next", following).where("file is not null and _next <= _high").select("file")


def vacuum(spark: SparkSession, path: str, keep_versions: int = 2) -> int:
    """Remove the files that none of the last ``keep_versions`` versions lists, and older manifests; returns the number of files."""
    known = versions(spark, path)
    kept = {r.file for v in known[-keep_versions:] for r in manifest(spark, path, v).select("file").collect()}  # one row a file
    old = {r.file for v in known[:-keep_versions] for r in manifest(spark, path, v).select("file").collect()}
    for f in old - kept:
        fs, p = _files(spark, f"{path}/{f}")
        fs.delete(p, False)
    for v in known[:-keep_versions]:
        fs, p = _files(spark, f"{path}/manifest/version={v}")
        fs.delete(p, True)
    return len(old - kept)
