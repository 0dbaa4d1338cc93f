"""Cleaning operators: filters, fills, homogenisation, gap fill, imputation (P*, C1–C4, W8).

All of them are column expressions or single aggregates joined back on the
family key; no driver-side loop over families or months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import numeric as num
from .joins import join_small

# Fixed values of the reference's homogenisation step (point-of-sale families).
REFERENCE_FAMILIES = (
    "cerrado", "BEBIDAS", "BOLLERIA", "CAFES", "VARIOS", "PASTELERIA",
    "BOCADILLOS", "PAN", "AÑADIDOS", "TES & INFUSIONES", "LICORES",
    "CERVEZAS", "TOSTADAS",
)
REFERENCE_REMAP = {"BEBIDA": "BEBIDAS"}
CLOSED = "cerrado"  # label of synthetic closed-day rows


def filter_date_range(df: DataFrame, start=None, end=None, date_col: str = "fecha") -> DataFrame:
    """Inclusive range; an open bound means the data's own min/max, so a row without a date is never inside."""
    d = F.col(date_col)
    df = df.where(d.isNotNull())
    if start is not None:
        df = df.where(d >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(d <= F.lit(end).cast("date"))
    return df


def filter_family(df: DataFrame, family: str | None, family_col: str = "familia") -> DataFrame:
    """Keep one family; ``None`` keeps all."""
    return df if family is None else df.where(F.col(family_col) == F.lit(family))


def allow_list(df: DataFrame, values, col: str = "familia") -> DataFrame:
    """Keep rows whose value is in the list (null never matches)."""
    return df.where(F.col(col).isin(list(values)))


def deny_list(df: DataFrame, values, col: str = "familia", drop_null: bool = True) -> DataFrame:
    """Drop listed values; nulls are dropped too, like the pandas ``~isin([..., None])``."""
    cond = ~F.col(col).isin([v for v in values if v is not None])
    if drop_null:
        cond = F.col(col).isNotNull() & cond
    else:
        cond = F.col(col).isNull() | cond
    return df.where(cond)


def remap_values(df: DataFrame, mapping: dict, col: str = "familia") -> DataFrame:
    """P5: replace listed labels (``BEBIDA → BEBIDAS`` in the reference)."""
    expr = F.col(col)
    for old, new in mapping.items():
        expr = F.when(F.col(col) == F.lit(old), F.lit(new)).otherwise(expr)
    return df.withColumn(col, expr)


def fill_nulls(df: DataFrame, values) -> DataFrame:
    """Constant or per-column fill.  Decimal columns are filled with an exact literal."""
    if not isinstance(values, dict):
        values = {c: values for c, t in df.dtypes if t.startswith(("decimal", "double", "float", "int", "bigint"))}
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in values.items() if c in types}
    )


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a null in any (or any listed) column."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def homogenize(
    df: DataFrame,
    families=REFERENCE_FAMILIES,
    remap=REFERENCE_REMAP,
    date_col: str = "fecha",
    family_col: str = "familia",
    product_col: str = "producto",
) -> DataFrame:
    """C4: DATE cast, label remap, product upper/trim, family allow-list."""
    out = df.withColumn(date_col, cal.as_date(date_col))
    out = remap_values(out, remap, family_col)
    if product_col in out.columns:
        out = out.withColumn(product_col, F.upper(F.trim(F.col(product_col))))
    return allow_list(out, families, family_col)


def clean_loader(
    df: DataFrame,
    start=None,
    end=None,
    remap=REFERENCE_REMAP,
    fill_cols=("base_imponible", "total"),
    date_col: str = "fecha",
    family_col: str = "familia",
) -> DataFrame:
    """Range filter → label remap → zero-fill amounts → season flag; ``is_easter`` = 0 when absent.

    (The reference's loader leaves Holy-Week marking to the weekly transform.)
    """
    out = filter_date_range(df.withColumn(date_col, cal.as_date(date_col)), start, end, date_col)
    out = remap_values(out, remap, family_col)
    out = fill_nulls(out, {c: 0 for c in fill_cols})
    if "is_summer_peak" not in out.columns:
        out = out.withColumn("is_summer_peak", cal.is_summer_peak(date_col))
    if "is_easter" not in out.columns:
        out = out.withColumn("is_easter", F.lit(0))
    return out


def trim_complete_weeks(df: DataFrame, date_col: str = "fecha") -> DataFrame:
    """Keep rows up to the last Sunday on or before the data's last date."""
    until = df.agg(cal.last_complete_sunday(F.max(date_col))).scalar()  # scalar subquery
    return df.where(F.col(date_col) <= until)


def previous_week(df: DataFrame, as_of, date_col: str = "fecha") -> DataFrame:
    """P10: rows of the Mon–Sun week before the week holding ``as_of`` (a parameter, never now())."""
    lo, hi = cal.previous_week_window(F.lit(as_of).cast("date"))
    return df.where(F.col(date_col).between(lo, hi))


def missing_dates(df: DataFrame, start=None, end=None, date_col: str = "fecha") -> DataFrame:
    """Calendar dates in [start, end] (default: data min/max) with no row.

    The distinct-date set is an aggregate with map-side partial aggregation;
    the expected calendar is a ``sequence`` explode of one row.
    """
    present = df.select(F.col(date_col).alias("fecha")).distinct()
    lo = F.lit(start).cast("date") if start is not None else F.min("fecha")
    hi = F.lit(end).cast("date") if end is not None else F.max("fecha")
    expected = present.agg(lo.alias("_lo"), hi.alias("_hi")).select(
        F.explode(F.sequence("_lo", "_hi")).alias("fecha")
    )
    return expected.join(present, "fecha", "left_anti")


def fill_closed_days(df: DataFrame, missing: DataFrame, date_col: str = "fecha") -> DataFrame:
    """One ``cerrado`` row per missing date (zero amounts, ``is_closed = 1``).

    Only the missing dates are added; existing rows are kept as they are (the
    reference's date de-duplication is the separate operator ``first_per_key``).
    """
    types = dict(df.dtypes)
    fill = {}
    for c, t in types.items():
        if c == date_col:
            continue
        if t == "string":
            fill[c] = F.lit(CLOSED)
        elif t.startswith(("decimal", "double", "float", "int", "bigint")):
            fill[c] = F.lit(0).cast(t)
        else:
            fill[c] = F.lit(None).cast(t)
    closed = missing.select(F.col("fecha").alias(date_col)).withColumns(fill).withColumn("is_closed", F.lit(1))
    base = df.withColumn("is_closed", F.lit(0)) if "is_closed" not in types else df
    return base.unionByName(closed.select(*base.columns))


def first_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """First row per key under an explicit, total order (``drop_duplicates(keep='first')``)."""
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_by_order(df: DataFrame, keys, order_cols) -> DataFrame:
    """W8 at scale: first row per key as the minimum of a struct led by the order columns.

    Unlike a ``row_number`` window, this is an aggregate with map-side partial
    aggregation, so a key holding a third of all rows is reduced on every
    mapper before the shuffle instead of being sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    first = F.min(F.struct(*order_cols, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*")


def impute_family_month(
    df: DataFrame,
    target_month: str,
    neighbour_months=(),
    year: int | None = None,
    cols=("base_imponible", "tipo_iva", "total"),
    method: str = "mean_of_means",
    date_col: str = "fecha",
    family_col: str = "familia",
) -> DataFrame:
    """Fill nulls of ``target_month`` per family from neighbour months, then the year mean.

    ``method``:
      * ``mean_of_means`` – mean of the neighbour months' means; the year-mean
        fallback is computed *after* that step, so it counts imputed cells (Q10);
      * ``pooled`` – mean over all neighbour-month rows; year mean of observed cells;
      * ``sequential`` – the first neighbour month that has a mean wins; year mean after.
    Imputed rows get ``is_imputed = 1``; rows still null in ``cols`` are dropped.

    One aggregation by family, joined back on the family key.  Means are
    exact rationals of DECIMAL sums and counts, rounded half-up once at the
    column's own scale, so the filled value does not depend on the plan.
    """
    types = dict(df.dtypes)
    month = F.trunc(F.col(date_col), "MM")
    tgt = F.lit(target_month).cast("date")
    months = [F.lit(m).cast("date") for m in neighbour_months]
    year = year if year is not None else int(str(target_month)[:4])
    in_year = F.year(F.col(date_col)) == year
    in_target = month == tgt

    def scale_of(c):
        t = types[c]
        return int(t[t.index(",") + 1 : -1]) if t.startswith("decimal") else 6

    def dec(c):
        return F.col(c) if types[c].startswith("decimal") else F.col(c).cast("decimal(38,6)")

    aggs = []
    for c in cols:
        sc = scale_of(c)
        for i, m in enumerate(months):
            aggs.append(num.to_units(F.sum(F.when(month == m, dec(c))), sc).alias(f"_u{i}_{c}"))
            aggs.append(F.count(F.when(month == m, F.col(c))).alias(f"_n{i}_{c}"))
        any_month = month.isin(*months) if months else F.lit(False)
        aggs.append(num.to_units(F.sum(F.when(any_month, dec(c))), sc).alias(f"_up_{c}"))
        aggs.append(F.count(F.when(any_month, F.col(c))).alias(f"_np_{c}"))
        aggs.append(num.to_units(F.sum(F.when(in_year, dec(c))), sc).alias(f"_uy_{c}"))
        aggs.append(F.count(F.when(in_year, F.col(c))).alias(f"_ny_{c}"))
    # only the year, the neighbour months and the target month matter: the range reaches the scan
    lo = F.least(F.lit(f"{year}-01-01").cast("date"), tgt, *months)
    hi = F.greatest(F.lit(f"{year}-12-31").cast("date"), F.last_day(tgt), *[F.last_day(m) for m in months])
    stats = df.where(F.col(date_col).between(lo, hi)).groupBy(family_col).agg(*aggs)

    steps, fills = {}, {}
    for c in cols:
        sc = scale_of(c)
        us = [F.col(f"_u{i}_{c}") for i in range(len(months))]
        ns = [F.col(f"_n{i}_{c}") for i in range(len(months))]
        present = [n > 0 for n in ns]
        if method == "mean_of_means" and months:
            # (Σ U_i/n_i)/m over present months, as one fraction N/D
            factors = [F.when(p, n).otherwise(F.lit(1)).cast("decimal(38,0)") for p, n in zip(present, ns)]
            big_n = F.lit(0).cast("decimal(38,0)")
            for i, (u, p) in enumerate(zip(us, present)):
                term = u
                for j, f in enumerate(factors):
                    if j != i:
                        term = term * f
                big_n = big_n + F.when(p, term).otherwise(F.lit(0))
            m = sum((p.cast("int") for p in present), F.lit(0))
            big_d = m.cast("decimal(38,0)")
            for f in factors:
                big_d = big_d * f
            step1 = F.when(m > 0, num.half_up_div(big_n, big_d))
        elif method == "sequential" and months:
            step1 = F.coalesce(*[F.when(p, num.half_up_div(u, n)) for u, n, p in zip(us, ns, present)])
        elif method == "pooled" and months:
            step1 = F.when(F.col(f"_np_{c}") > 0, num.half_up_div(F.col(f"_up_{c}"), F.col(f"_np_{c}")))
        elif method in ("mean_of_means", "sequential", "pooled"):
            step1 = F.lit(None).cast("long")
        else:
            raise ValueError(method)
        # computed once per family, in a projection of its own
        steps[f"_s_{c}"] = step1
        step1 = F.col(f"_s_{c}")
        uy, ny = F.col(f"_uy_{c}"), F.col(f"_ny_{c}")
        # read only where step 1 gave nothing, so no cell that step 1 filled counts in it
        year_units = F.when(ny > 0, num.half_up_div(F.coalesce(uy, F.lit(0)), ny))
        fills[f"_f_{c}"] = num.from_units(F.coalesce(step1, year_units), sc, 38).cast(types[c])
    stats = stats.withColumns(steps).select(family_col, *[v.alias(k) for k, v in fills.items()])

    joined = join_small(df, stats, family_col, "left")  # one row per family
    filled = [in_target & F.col(c).isNull() & F.col(f"_f_{c}").isNotNull() for c in cols]
    any_imputed = filled[0]
    for f in filled[1:]:
        any_imputed = any_imputed | f
    prior = F.col("is_imputed") if "is_imputed" in df.columns else F.lit(0)
    out = joined.withColumns(
        {
            **{c: F.when(in_target & F.col(c).isNull(), F.col(f"_f_{c}")).otherwise(F.col(c)) for c in cols},
            "is_imputed": F.when(any_imputed, F.lit(1)).otherwise(prior).cast("int"),
        }
    ).drop(*[f"_f_{c}" for c in cols])
    return out.na.drop("any", subset=list(cols))
