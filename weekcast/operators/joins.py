"""Joining a small derived table (per-family stats, per-slice offsets) back onto big data.

Left to the planner, such a join becomes a sort-merge join that hash-shuffles
the *big* side on the key (e.g. the family): the whole table moves, and a
family holding a third of all rows lands in one task.  AQE can switch to a
broadcast at run time, but only after both sides were shuffled.

``join_small`` decides up front, with a proof of size: the small side (an
aggregate) is checkpointed in the shared folder, so that Spark knows its
size in bytes, and is broadcast only up to ``max_bytes``; otherwise it
falls back to the ordinary shuffle join.  Nothing stays in executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BROADCAST_MAX_BYTES = 64 << 20


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of a small derived table: the lengths of its rows' values as text, an upper bound of a few times the real size.

    Runs the table's job; callers checkpoint it first.
    """
    row = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return int(df.agg(F.sum(row.cast("bigint"))).first()[0] or 0)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``big.join(small, on, how)`` with ``small`` broadcast iff its measured size is bounded."""
    ensure_checkpoint_dir(small.sparkSession)
    kept = small.checkpoint()
    if size_in_bytes(kept) <= max_bytes:
        return big.join(F.broadcast(kept), on, how)
    return big.join(kept, on, how)
