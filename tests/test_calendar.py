"""Calendar expressions on hand-built dates."""

import datetime as dt

from pyspark.sql import functions as F

from weekcast.functions import calendar as cal


def _one(spark, col_expr, value):
    return spark.createDataFrame([(value,)], "d date").select(col_expr(F.col("d")).alias("x")).first()["x"]


def test_iso_year_edges(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 12, 31),), (dt.date(2021, 1, 3),), (dt.date(2024, 12, 30),)], "d date"
    )
    rows = df.select(cal.iso_year("d").alias("y"), cal.iso_week("d").alias("w"), cal.week_monday("d").alias("m")).collect()
    assert [(r.y, r.w) for r in rows] == [(2020, 53), (2020, 53), (2025, 1)]
    assert rows[2].m == dt.date(2024, 12, 30)


def test_monday_from_iso_matches_trunc(spark):
    days = spark.range(0, 13149).select(F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    bad = days.where(cal.monday_of_iso_week(cal.iso_year("d"), cal.iso_week("d")) != cal.week_monday("d")).count()
    assert bad == 0


def test_holy_week_weeks(spark):
    # Holy Week = the ISO week of Easter: (2023,14), (2024,13), (2025,16)
    days = spark.range(0, 3 * 366).select(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    weeks = (
        days.where(cal.is_holy_week("d") == 1)
        .select(cal.iso_year("d").alias("y"), cal.iso_week("d").alias("w"))
        .distinct()
        .orderBy("y")
        .collect()
    )
    assert [(r.y, r.w) for r in weeks] == [(2023, 14), (2024, 13), (2025, 16)]
    per_year = days.where(cal.is_holy_week("d") == 1).groupBy(F.year("d")).count().collect()
    assert all(r["count"] == 7 for r in per_year)


def test_easter_sundays(spark):
    known = {2022: dt.date(2022, 4, 17), 2023: dt.date(2023, 4, 9), 2024: dt.date(2024, 3, 31), 2025: dt.date(2025, 4, 20), 2026: dt.date(2026, 4, 5)}
    df = spark.createDataFrame([(y,) for y in known], "y int").select("y", cal.easter_sunday("y").alias("e"))
    assert {r.y: r.e for r in df.collect()} == known


def test_flags_and_weekdays(spark):
    assert _one(spark, cal.day_of_week, dt.date(2024, 1, 1)) == 0  # Monday
    assert _one(spark, cal.is_weekend, dt.date(2024, 1, 6)) == 1
    assert _one(spark, cal.is_summer_peak, dt.date(2024, 8, 31)) == 1
    assert _one(spark, cal.is_easter_window, dt.date(2024, 4, 10)) == 1
    assert _one(spark, cal.is_easter_window, dt.date(2024, 4, 11)) == 0
    assert _one(spark, cal.week_ending_sunday, dt.date(2024, 1, 7)) == dt.date(2024, 1, 7)
    assert _one(spark, cal.last_complete_sunday, dt.date(2024, 1, 10)) == dt.date(2024, 1, 7)


def test_previous_week_window(spark):
    lo, hi = cal.previous_week_window(F.lit("2001-10-31").cast("date"))
    r = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (r.lo, r.hi) == (dt.date(2001, 10, 22), dt.date(2001, 10, 28))


def test_the_easter_expression_stays_small(spark):
    # each use of the year is computed again for each row
    days = spark.sql("select date'2024-03-31' as d").where(cal.is_holy_week("d") == 1)
    plan = days._jdf.queryExecution().analyzed().toString()
    assert plan.count("year(") < 20 and days.count() == 1
