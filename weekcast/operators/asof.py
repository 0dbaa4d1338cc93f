"""Point-in-time retrieval (J12) for any event times, several feature groups and a time to live.

Entity and feature rows are one union, cut by key and time slice.  A window
inside (key, slice) carries the last row of every feature group to the
entities; one small row per (key, slice, group) with the slice's last
feature carries it over to later slices.  The window never holds more of a
key than a slice of it, so a key with a third of all rows is many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .positional import numeric_key, with_slice


@dataclass(frozen=True)
class FeatureGroup:
    """Feature rows of one source: the columns to carry, their event time, the order in which rows were loaded, and how long they hold."""

    name: str
    rows: DataFrame
    values: tuple
    time: str
    load_order: str | None = None
    ttl_seconds: int | None = None


def asof_join(entities: DataFrame, groups, keys, time: str, n_slices: int | None = None) -> DataFrame:
    """Entity rows with the latest feature row of each group at or before their time.

    Adds ``<group>_<value>`` and ``<group>_time`` for each group; null where
    there is no such row or where it is older than the group's time to live.
    Of feature rows with one key and time the last in load order counts (a
    feature at the very time of the entity is known to it).  Rows with a null
    key or time have no features and are no features; entity rows that
    repeat each have theirs; no row is dropped.  ``n_slices``: time slices,
    one for every 5 million rows unless given.
    """
    keys, groups = list(keys), list(groups)
    own = [F.col(f"`{c}`") for c in entities.columns]
    none = {g.name: F.lit(None).cast(_kind(g)) for g in groups}
    parts = [
        entities.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(time).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_is_entity"),
            F.struct(*own).alias("_e"), *[v.alias(f"_g_{n}") for n, v in none.items()],
        )
    ]
    kind = parts[0].schema["_e"].dataType
    for g in groups:
        order = F.col(g.load_order).cast("bigint") if g.load_order else F.lit(0).cast("bigint")
        t = F.col(g.time).cast("timestamp_ntz")
        value = F.struct(t.alias("t"), order.alias("o"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(g.values)])
        known = t.isNotNull()
        for k in keys:
            known = known & F.col(k).isNotNull()
        parts.append(
            g.rows.where(known).select(
                *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], t.alias("_t"), F.lit(0).alias("_is_entity"), F.lit(None).cast(kind).alias("_e"),
                *[value.alias(f"_g_{g.name}") if n == g.name else v.alias(f"_g_{n}") for n, v in none.items()],
            )
        )
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = with_slice(rows, numeric_key(rows, "_t"), n_slices)
    at = [f"_k{i}" for i in range(len(keys))]
    names = [f"_g_{g.name}" for g in groups]
    by_load = F.coalesce(*[F.col(n)["o"] for n in names], F.lit(0))
    upto = Window.partitionBy(*at, "_slice").orderBy("_t", "_is_entity", by_load).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({f"{n}_in": F.last(n, ignorenulls=True).over(upto) for n in names}).where("_is_entity = 1")
    # the last feature of each slice, carried to the slices after it: one row per key and slice
    last = rows.groupBy(*at, "_slice").agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), F.struct(F.col(n)["t"], F.col(n)["o"]))).alias(n) for n in names])
    before = Window.partitionBy(*at).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*at, "_slice", *[F.last(n, ignorenulls=True).over(before).alias(f"{n}_before") for n in names])
    both = inside.join(carried, [*at, "_slice"], "left")
    out = []
    for g, n in zip(groups, names):
        found = F.coalesce(F.col(f"{n}_in"), F.col(f"{n}_before"))
        fresh = F.col("_t").isNotNull() & _within(found["t"], F.col("_t"), g.ttl_seconds)
        out += [F.when(fresh, found[f"v{i}"]).alias(f"{g.name}_{c}") for i, c in enumerate(g.values)] + [F.when(fresh, found["t"]).alias(f"{g.name}_time")]
    return both.select(*[F.col("_e")[c].alias(c) for c in entities.columns], *out)


def _kind(g: FeatureGroup) -> str:
    types = dict(g.rows.dtypes)
    fields = ["t:timestamp_ntz", "o:bigint", *[f"v{i}:{types[c]}" for i, c in enumerate(g.values)]]
    return f"struct<{','.join(fields)}>"


def _within(then: Column, now: Column, seconds: int | None) -> Column:
    """Whether a feature of time ``then`` is still held at ``now``."""
    if seconds is None:
        return then.isNotNull()
    return F.coalesce(then + F.make_dt_interval(secs=F.lit(float(seconds))) >= now, F.lit(False))
