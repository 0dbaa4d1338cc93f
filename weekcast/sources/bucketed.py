"""Bucketed fact and dimension tables (S1, S3, J1): the join of lines and parts needs no shuffle.

Lines and parts are written once as tables bucketed and sorted by part key
with the same number of buckets, in the shared folder.  Every later roll-up
joins bucket with bucket; only its small partial aggregates are shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from . import store, tables

BUCKETS = 16


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` as an external table in the shared folder, and read the table."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    # one task a bucket: a bucket is one file, so its sort order is known to the reader
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", store.new_location(spark, table)).saveAsTable(table)
    return spark.table(table)


def bucketed_lines(spark: SparkSession, sf_dir: str, buckets: int = BUCKETS) -> DataFrame:
    """The invoice lines of :func:`tables.sales_lines` over bucketed ``lineitem`` and ``part``."""
    li = write_bucketed(tables.table(spark, sf_dir, "lineitem"), "l_partkey", buckets, "lineitem_by_part")
    part = write_bucketed(tables.table(spark, sf_dir, "part"), "p_partkey", buckets, "part_by_key")
    return tables.lines_of(li, part)
