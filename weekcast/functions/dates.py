"""Date parsing and epoch coercion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Magnitude thresholds of the epoch-unit guess (median of positive values).
EPOCH_UNIT_THRESHOLDS = (("ns", 1e17), ("us", 1e14), ("ms", 1e11))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, fmt: str | None = None) -> Column:
    """lenient parse to DATE (NULL on failure); explicit format optional."""
    if fmt is None:
        return F.to_date(F.try_to_timestamp(_c(c).cast("string")))
    return F.to_date(F.try_to_timestamp(_c(c).cast("string"), F.lit(fmt)))


def normalize_date(c, default: str | None = None) -> Column:
    """``YYYY-MM-DD`` text from the first 10 characters; ``default`` when it does not parse."""
    head = F.substring(_c(c).cast("string"), 1, 10)
    parsed = F.try_to_timestamp(head, F.lit("yyyy-MM-dd"))
    out = F.date_format(parsed, "yyyy-MM-dd")
    return F.coalesce(out, F.lit(default)) if default is not None else out


def _epoch_numbers(c) -> Column:
    """Epoch candidates: numeric text or numbers → BIGINT; ≤ 0 and junk → NULL."""
    n = F.col(c).cast("string").try_cast("bigint") if isinstance(c, str) else c.cast("string").try_cast("bigint")
    return F.when(n > 0, n)


def epoch_unit_stats(df: DataFrame, col: str) -> DataFrame:
    """One-row frame with the exact facts that decide the unit of an epoch column.

    The median is compared with three thresholds.  For each threshold T one
    aggregation pass gives: how many values are below T, the largest value
    below T and the smallest value at or above T — enough to decide
    ``median ≥ T`` exactly without sorting or collecting the column.
    """
    return df.agg(*[x.alias(name) for name, x in _unit_facts(col).items()])


def _unit_facts(col: str) -> dict[str, Column]:
    v = _epoch_numbers(col)
    facts = {"n": F.count(v)}
    for unit, t in EPOCH_UNIT_THRESHOLDS:
        facts |= {
            f"below_{unit}": F.count(F.when(v < F.lit(t), v)),
            f"hi_below_{unit}": F.max(F.when(v < F.lit(t), v)),
            f"lo_above_{unit}": F.min(F.when(v >= F.lit(t), v)),
        }
    return facts


def _median_at_least(unit: str, t: float, at: str = "") -> Column:
    n = F.col(f"{at}n")
    below = F.col(f"{at}below_{unit}")
    odd = (n % 2) == 1
    # odd n: median is the ((n+1)/2)-th value; even n: mean of the (n/2)-th and (n/2+1)-th
    odd_case = below <= (n - 1) / 2
    even_case = F.when(below < n / 2, F.lit(True)).when(below > n / 2, F.lit(False)).otherwise(
        (F.col(f"{at}hi_below_{unit}").cast("double") + F.col(f"{at}lo_above_{unit}").cast("double")) / 2 >= F.lit(t)
    )
    return F.when(odd, odd_case).otherwise(even_case)


def epoch_unit(stats: DataFrame) -> Column:
    """Unit column (``ns``/``us``/``ms``/``s``) over the frame from ``epoch_unit_stats``."""
    return _unit_of("")


def _unit_of(at: str) -> Column:
    expr = F.lit("s")
    for unit, t in reversed(EPOCH_UNIT_THRESHOLDS):
        expr = F.when(_median_at_least(unit, t, at), F.lit(unit)).otherwise(expr)
    return F.when(F.col(f"{at}n") > 0, expr)


def from_epoch(value, unit) -> Column:
    """naive UTC timestamp from an epoch number in the given unit (exact integer maths)."""
    v = _epoch_numbers(value)
    micros = (
        F.when(unit == "ns", F.call_function("div", v, F.lit(1000)))
        .when(unit == "us", v)
        .when(unit == "ms", F.try_multiply(v, F.lit(1000).cast("bigint")))
        .when(unit == "s", F.try_multiply(v, F.lit(1000000).cast("bigint")))
    )
    return ntz_from_micros(micros)


def ntz_from_micros(micros) -> Column:
    """TIMESTAMP_NTZ (naive UTC wall time) from epoch microseconds, independent of the session time zone."""
    m = _c(micros)
    # beyond the years 1 to 9999 there is no timestamp: such a number (another unit's) becomes null
    m = F.when(m.between(-62135596800000000, 253402300799999999), m)
    days = F.call_function("div", m, F.lit(86400000000))
    secs = ((m - days * 86400000000).cast("decimal(18,0)") / F.lit(1000000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), secs)


def coerce_epoch(df: DataFrame, cols) -> DataFrame:
    """convert epoch columns to timestamps, guessing each column's unit from its median.

    The unit is a scalar subquery over exact aggregates, so the conversion
    stays a projection of the original rows (no join, no collect).
    """
    cols = list(cols)
    parts = {c: [x.alias(f"{x_name}") for x_name, x in _unit_facts(c).items()] for c in cols}
    # one pass for all columns; one struct of units, read once
    stats = df.agg(*[F.struct(*parts[c]).alias(f"_facts_{i}") for i, c in enumerate(cols)])
    units = stats.select(F.struct(*[_unit_of(f"_facts_{i}.").alias(f"u{i}") for i in range(len(cols))]).alias("u")).scalar()
    out = df.withColumn("_units", units)
    return out.withColumns({c: from_epoch(F.col(c), F.col(f"_units.u{i}")) for i, c in enumerate(cols)}).drop("_units")


def wall_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a timestamp's wall-clock reading (no time-zone shift)."""
    t = _c(c)
    return (
        F.unix_date(F.to_date(t)).cast("bigint") * 86400000000
        + F.hour(t).cast("bigint") * 3600000000
        + F.minute(t).cast("bigint") * 60000000
        + (F.date_part(F.lit("SECOND"), t) * 1000000).cast("bigint")
    )


def wall_instant(c) -> Column:
    """TIMESTAMP whose UTC reading equals the wall-clock reading of ``c`` (for windows/watermarks)."""
    return F.timestamp_micros(wall_micros(c))
