"""Derived views over the driver tables, shared by the registered queries.

These are the Spark counterparts of the oracle CTEs in ``sqltext``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import calendar as cal
from ..operators import rollup
from ..sources import tables


def sales(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    """Invoice lines with family (lineitem ⋈ part)."""
    return tables.sales_lines(spark, sf_dir, with_keys=with_keys)


def sales_full(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    """Invoice lines with family and zone (full star join)."""
    return tables.sales(spark, sf_dir, with_keys=with_keys)


def sales_dirty(spark: SparkSession, sf_dir: str, with_zone: bool = False) -> DataFrame:
    return tables.sales_dirty(spark, sf_dir, with_zone=with_zone)


def weekly(spark: SparkSession, sf_dir: str, min_days: int = 7) -> DataFrame:
    """A1 on clean sales with Holy-Week and summer flags."""
    return rollup.weekly_rollup(cal.add_calendar_flags(sales(spark, sf_dir)), min_days=min_days)


def daily(spark: SparkSession, sf_dir: str, keep_decimal: bool = False) -> DataFrame:
    """A3 daily series with calendar columns."""
    return rollup.daily_series(sales(spark, sf_dir), keep_decimal=keep_decimal)
