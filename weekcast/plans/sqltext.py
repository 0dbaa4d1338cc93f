"""DuckDB SQL building blocks for the oracle queries.

The oracle only has the base tables registered, so every derived view is
inlined as a CTE.  Output columns are cast explicitly (BIGINT, DOUBLE, DATE,
VARCHAR, INTEGER) so both engines agree on the schema.
"""

from __future__ import annotations


def easter_sunday(y: str) -> str:
    """Gregorian Easter Sunday of integer year expression ``y`` (DuckDB)."""
    a = f"(({y}) % 19)"
    b = f"(({y}) // 100)"
    c = f"(({y}) % 100)"
    d = f"({b} // 4)"
    e = f"({b} % 4)"
    f = f"(({b} + 8) // 25)"
    g = f"(({b} - {f} + 1) // 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i = f"({c} // 4)"
    k = f"({c} % 4)"
    l_ = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {l_}) // 451)"
    n = f"({h} + {l_} - 7 * {m} + 114)"
    return f"make_date(cast({y} as integer), cast({n} // 31 as integer), cast({n} % 31 + 1 as integer))"


def is_holy_week(d: str) -> str:
    e = easter_sunday(f"year({d})")
    return f"cast({d} between {e} - 6 and {e} as integer)"


def is_easter_window(d: str) -> str:
    return f"cast(month({d}) * 100 + day({d}) between 324 and 410 as integer)"


def is_summer(d: str) -> str:
    return f"cast(month({d}) in (7, 8) as integer)"


def monday(d: str) -> str:
    return f"cast({d} - cast(isodow({d}) - 1 as integer) as date)"


def sunday_label(d: str) -> str:
    return f"cast({d} + cast((7 - isodow({d})) % 7 as integer) as date)"


def dow(d: str) -> str:
    return f"(isodow({d}) - 1)"


NET = "cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(18,4))"
GROSS = (
    "cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"
    " * (1 + cast(l_tax as decimal(4,2))) as decimal(18,6))"
)

SALES_LINES = f"""sales as (
  select cast(l_shipdate as date) as fecha, cast(l_orderkey as varchar) as n_factura,
         p_name as producto, p_type as familia, l_quantity as cantidad,
         {NET} as base_imponible, cast(l_tax as decimal(4,2)) as tipo_iva, {GROSS} as total,
         l_partkey, l_suppkey, l_linenumber
  from lineitem join part on p_partkey = l_partkey)"""

SALES_FULL = f"""sales as (
  select cast(l_shipdate as date) as fecha, cast(l_orderkey as varchar) as n_factura,
         n_name as zona_de_venta, p_name as producto, p_type as familia, l_quantity as cantidad,
         {NET} as base_imponible, cast(l_tax as decimal(4,2)) as tipo_iva, {GROSS} as total,
         l_partkey, l_suppkey, l_linenumber
  from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey
       join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)"""


def sales_dirty(with_zone: bool) -> str:
    zone = "zona_de_venta, " if with_zone else ""
    return f"""sales_dirty as (
  select fecha, n_factura, {zone}concat('  ', lower(producto), ' ') as producto,
         case when familia = 'ECONOMY' and l_linenumber = 1 then 'ECONOM'
              when familia = 'PROMO' and l_linenumber = 7 then '7'
              when l_suppkey % 50 = 0 and l_linenumber = 2 then null else familia end as familia,
         cantidad,
         case when fecha between date '1997-11-01' and date '1997-11-30' and l_partkey % 5 = 0
              then null else base_imponible end as base_imponible,
         tipo_iva,
         case when fecha between date '1997-11-01' and date '1997-11-30' and l_partkey % 5 = 0
              then null else total end as total
  from sales where dayofyear(fecha) % 97 <> 0)"""


def weekly(min_days: int = 7, src: str = "sales", name: str = "weekly") -> str:
    """A1 roll-up of ``src`` (needs fecha, familia, base_imponible)."""
    return f"""{name} as (
  select cast(isoyear(week_start) as bigint) as year, cast(week(week_start) as bigint) as week,
         familia, cast(base_imponible as double) as base_imponible,
         is_summer_peak, is_easter, cast(dias_semana as bigint) as dias_semana, week_start
  from (select {monday('fecha')} as week_start, familia, sum(base_imponible) as base_imponible,
               max({is_summer('fecha')}) as is_summer_peak, max({is_holy_week('fecha')}) as is_easter,
               count(distinct fecha) as dias_semana
        from {src} group by all)
  where dias_semana >= {min_days})"""


def daily(src: str = "sales", name: str = "daily", exact: bool = False) -> str:
    """A3 daily series with calendar columns (Easter = 24 Mar … 10 Apr window)."""
    money = "base_imponible, total" if exact else "cast(base_imponible as double) as base_imponible, cast(total as double) as total"
    return f"""{name} as (
  select fecha, familia, {money},
         cast({dow('fecha')} as integer) as day_of_week, cast(month(fecha) as integer) as month,
         cast(week(fecha) as integer) as week, cast(year(fecha) as integer) as year,
         cast({dow('fecha')} in (5, 6) as integer) as is_weekend, {is_summer('fecha')} as is_summer_peak,
         {is_easter_window('fecha')} as is_easter
  from (select fecha, familia, sum(base_imponible) as base_imponible, sum(total) as total
        from {src} group by all))"""


def features(lags=(1, 2, 3, 52), horizon: int = 1, src: str = "weekly", name: str = "features") -> str:
    lag_cols = ", ".join(
        f"lag(base_imponible, {k}) over (partition by familia order by week_start) as base_imponible_lag{k}"
        for k in lags
    )
    notnull = " and ".join([f"base_imponible_lag{k} is not null" for k in lags] + ["target is not null"])
    return f"""{name} as (
  select * from (
    select familia, week_start, base_imponible, {lag_cols},
           is_summer_peak, is_easter,
           lead(base_imponible, {horizon}) over (partition by familia order by week_start) as target
    from {src})
  where {notnull})"""


def sales_lines(name: str = "sales") -> str:
    return SALES_LINES.replace("sales as (", f"{name} as (", 1)


def sales_full(name: str = "sales") -> str:
    return SALES_FULL.replace("sales as (", f"{name} as (", 1)


FIXTURE_FAMILIES = ("cerrado", "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def homogenized(src: str = "sales_dirty", name: str = "homog") -> str:
    fams = ", ".join(f"'{f}'" for f in FIXTURE_FAMILIES)
    return f"""{name} as (
  select * from (
    select fecha, n_factura, upper(trim(producto)) as producto,
           case when familia = 'ECONOM' then 'ECONOMY' else familia end as familia,
           cantidad, base_imponible, tipo_iva, total
    from {src})
  where familia in ({fams}))"""


def half_up(n: str, d: str) -> str:
    return f"(case when ({n}) < 0 then -((2 * abs({n}) + ({d})) // (2 * ({d}))) else (2 * ({n}) + ({d})) // (2 * ({d})) end)"


def imputed(src: str, cols: dict, target: str, months: tuple, year: int, name: str = "imputed", method: str = "mean_of_means") -> str:
    """C3 imputation with exact half-up rounding (two neighbour months): mean of means, pooled or sequential."""
    m0, m1 = months
    mo = "date_trunc('month', fecha)"
    aggs = []
    for c, sc in cols.items():
        unit = 10**sc
        aggs += [
            f"cast(sum(case when {mo} = date '{m0}' then {c} end) * {unit} as hugeint) as u0_{c}",
            f"count(case when {mo} = date '{m0}' then {c} end) as n0_{c}",
            f"cast(sum(case when {mo} = date '{m1}' then {c} end) * {unit} as hugeint) as u1_{c}",
            f"count(case when {mo} = date '{m1}' then {c} end) as n1_{c}",
            f"cast(sum(case when year(fecha) = {year} then {c} end) * {unit} as hugeint) as uy_{c}",
            f"count(case when year(fecha) = {year} then {c} end) as ny_{c}",
            f"count(case when {mo} = date '{target}' and {c} is null then 1 end) as k_{c}",
        ]
    fills = []
    for c, sc in cols.items():
        f0 = f"cast(case when n0_{c} > 0 then n0_{c} else 1 end as hugeint)"
        f1 = f"cast(case when n1_{c} > 0 then n1_{c} else 1 end as hugeint)"
        big_n = f"((case when n0_{c} > 0 then u0_{c} * {f1} else 0 end) + (case when n1_{c} > 0 then u1_{c} * {f0} else 0 end))"
        m = f"(cast(n0_{c} > 0 as integer) + cast(n1_{c} > 0 as integer))"
        big_d = f"(cast({m} as hugeint) * {f0} * {f1})"
        step1 = f"(case when {m} > 0 then {half_up(big_n, big_d)} end)"
        if method == "pooled":
            step1 = f"(case when n0_{c} + n1_{c} > 0 then {half_up(f'(coalesce(u0_{c}, 0) + coalesce(u1_{c}, 0))', f'(n0_{c} + n1_{c})')} end)"
        elif method == "sequential":
            step1 = f"(case when n0_{c} > 0 then {half_up(f'u0_{c}', f'n0_{c}')} when n1_{c} > 0 then {half_up(f'u1_{c}', f'n1_{c}')} end)"
        kk = f"(case when {step1} is not null then k_{c} else 0 end)"
        yn = f"(coalesce(uy_{c}, 0) + coalesce({step1}, 0) * {kk})"
        yd = f"(ny_{c} + {kk})"
        year_units = f"(case when {yd} > 0 then {half_up(yn, yd)} end)"
        step = "0." + "0" * (sc - 1) + "1"
        fills.append(f"cast(cast(coalesce({step1}, {year_units}) as decimal(18,0)) * {step} as decimal(38,{sc})) as f_{c}")
    sel = []
    flags = []
    for c in cols:
        sel.append(f"case when {mo} = date '{target}' and s.{c} is null then f_{c} else s.{c} end as {c}")
        flags.append(f"({mo} = date '{target}' and s.{c} is null and f_{c} is not null)")
    keep = " and ".join(f"{c} is not null" for c in cols)
    others = "fecha, n_factura, producto, s.familia as familia, cantidad"
    return f"""stats as (select familia, {", ".join(aggs)} from {src} group by familia),
fills as (select familia, {", ".join(fills)} from stats),
{name} as (
  select * from (
    select {others}, {", ".join(sel)}, cast({" or ".join(flags)} as integer) as is_imputed
    from {src} s left join fills f on s.familia = f.familia)
  where {keep})"""
