"""Calendar column expressions (ISO weeks, Easter, season flags).

Everything here returns a ``Column`` built from native Spark functions, so
it stays inside whole-stage codegen and needs no lookup table or join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the flags (must match the reference's rules).
SUMMER_MONTHS = (7, 8)  # July and August are the summer peak
WEEKEND_DAYS = (5, 6)  # Saturday and Sunday with Monday = 0
EASTER_WINDOW = ((3, 24), (4, 10))  # alternative rule: 24 March to 10 April, inclusive


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c) -> Column:
    """DATE from a DATE, TIMESTAMP, TIMESTAMP_NTZ or ISO string column."""
    return F.to_date(_c(c))


def day_of_week(c) -> Column:
    """Day of week with Monday = 0 … Sunday = 6."""
    return F.weekday(_c(c))


def iso_year(c) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _c(c))


def iso_week(c) -> Column:
    return F.weekofyear(_c(c))


def week_monday(c) -> Column:
    """Monday that starts the ISO week of a date."""
    d = as_date(c)
    return F.date_sub(d, F.weekday(d))


def monday_of_iso_week(year, week) -> Column:
    """Monday of ISO (year, week): the Monday of the week holding 4 January, plus 7·(week−1) days."""
    jan4 = F.make_date(_c(year).cast("int"), F.lit(1), F.lit(4))
    return F.date_add(F.date_sub(jan4, F.weekday(jan4)), (_c(week).cast("int") - 1) * 7)


def week_ending_sunday(c) -> Column:
    """Sunday that closes the week of a date (a Sunday maps to itself)."""
    return F.next_day(F.date_sub(as_date(c), 1), "SUN")


def month_start(c) -> Column:
    return F.trunc(as_date(c), "MM")


def is_summer_peak(c) -> Column:
    return F.month(_c(c)).isin(*SUMMER_MONTHS).cast("int")


def is_weekend(c) -> Column:
    return day_of_week(c).isin(*WEEKEND_DAYS).cast("int")


def easter_sunday(year) -> Column:
    """Gregorian Easter Sunday of a year column (anonymous Gregorian computus).

    An expression has no variables: every use of a part repeats it for each
    row, so parts are used as seldom as can be.
    """
    y = _c(year).cast("int")

    def div(a, b):
        return F.floor(a / b).cast("int")

    a = y % 19
    b = div(y, 100)
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = (a * 19 + b - div(b, 4) - g + 15) % 30
    # the full moon is on 21 March + h, a day less for the latest ones; Easter is the next Sunday
    moon = F.date_add(F.make_date(y, F.lit(3), F.lit(21)), h - div(a + h * 11, 319))
    return F.next_day(moon, "Sunday")


def is_holy_week(c) -> Column:
    """1 on Monday … Easter Sunday of the date's own year (the ISO week of Easter)."""
    d = as_date(c)
    return F.date_diff(easter_sunday(F.year(d)), d).isin(*range(7)).cast("int")


def is_easter_window(c) -> Column:
    """Alternative rule: 1 between 24 March and 10 April inclusive."""
    d = as_date(c)
    (m1, d1), (m2, d2) = EASTER_WINDOW
    md = F.month(d) * 100 + F.dayofmonth(d)
    return md.between(m1 * 100 + d1, m2 * 100 + d2).cast("int")


def is_easter(c, rule: str = "holy_week") -> Column:
    if rule == "holy_week":
        return is_holy_week(c)
    if rule == "window":
        return is_easter_window(c)
    raise ValueError(f"unknown Easter rule {rule!r}")


def add_calendar_flags(df, date_col: str = "fecha", easter_rule: str = "holy_week"):
    """Add ``is_summer_peak`` and ``is_easter`` (D2 flags)."""
    return df.withColumns(
        {
            "is_summer_peak": is_summer_peak(date_col),
            "is_easter": is_easter(date_col, easter_rule),
        }
    )


def add_daily_calendar(df, date_col: str = "fecha", easter_rule: str = "window"):
    """Calendar columns of the daily series (D3)."""
    d = F.col(date_col)
    return df.withColumns(
        {
            "day_of_week": day_of_week(d),
            "month": F.month(d),
            "week": iso_week(d),
            "year": F.year(d),
            "is_weekend": is_weekend(d),
            "is_summer_peak": is_summer_peak(d),
            "is_easter": is_easter(d, easter_rule),
        }
    )


def last_complete_sunday(max_date) -> Column:
    """Latest Sunday on or before a date (the date itself if it is a Sunday)."""
    d = as_date(max_date)
    return F.date_sub(d, (F.weekday(d) + 1) % 7)


def previous_week_window(as_of) -> tuple[Column, Column]:
    """(Monday, Sunday) of the Mon–Sun week before the week holding ``as_of``."""
    monday = F.date_sub(week_monday(as_of), 7)
    return monday, F.date_add(monday, 6)
