"""SimHash near-duplicates: fingerprints of word shingles, joined by walking a binary trie against itself.

*Fingerprints.*  A-Z lower-cased, words are runs without ASCII blanks,
shingles of ``width`` words with repeats (fewer words: the whole sequence).
A bit is 1 if it is set in more than half of the shingles' XXH64 values.

*Join.*  Fingerprints that differ in at most ``max_bits`` bits agree in at
least one of ``max_bits + 1`` blocks.  Each distinct fingerprint is dealt to
one bucket for each block, turned so that the block comes first.  A bucket
is a path-compressed binary trie (a sorted array: a node is a range of it);
pairs of nodes are walked together from (root, root), the differing bits of
their common prefixes add up, and a pair is dropped as soon as they exceed
the budget.  A bucket over ``bucket_limit`` fingerprints is dealt again by
the blocks of its other bits, by the same argument.

Only distinct fingerprints are joined, so copies never make pairs, and a task
gives a spanning forest of its links rather than the links themselves.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SEED = 42
#: Node pairs that one numpy step of the walk holds.
PAIRS_AT_ONCE = 500_000


def fingerprint_of(text: bytes | None, width: int = 3) -> int:
    """The 64-bit fingerprint of one UTF-8 text (null or without words: 0)."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else iter([b" ".join(words)])
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 100_000):
        part = hashes[i : i + 100_000].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, width: int = 3) -> Column:
    """Fingerprint column (as signed 64-bit) of a text column."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint_of(t.as_py(), width) for t in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return of(text.cast("binary"))


def _common(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Length of the prefix that the fingerprints v[lo:hi] of each range share (64: one value)."""
    x = v[lo] ^ v[hi - 1]
    out = np.full(len(x), 64, np.int64)
    some = x > 0
    y = x[some]
    bits = np.zeros(len(y), np.int64)
    for s in (32, 16, 8, 4, 2, 1):
        high = y >> np.uint64(s) > 0
        bits += np.where(high, s, 0)
        y = np.where(high, y >> np.uint64(s), y)
    out[some] = 63 - bits
    return out


def _differ(a: np.ndarray, b: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Differing bits of two prefixes of ``depth`` bits."""
    x = a ^ b
    keep = np.where(depth == 0, np.uint64(0), x >> np.minimum(64 - depth, 63).astype(np.uint64))
    return np.bitwise_count(keep)


def trie_forest(v: np.ndarray, buckets: list[tuple[int, int]], max_bits: int) -> np.ndarray:
    """Walk the trie of each bucket (a range of ``v``, sorted) against itself.

    Returns for each position the least position of its bucket that it is
    linked with, directly or not, by steps of at most ``max_bits`` bits.
    """
    root = np.arange(len(v))
    first = np.array([b for b in buckets if b[1] - b[0] > 1], np.int64).reshape(-1, 2)
    stack = [np.hstack([part, part]) for part in np.array_split(first, max(1, len(first) // PAIRS_AT_ONCE))]
    while stack:
        pairs = stack.pop()
        if len(pairs) > PAIRS_AT_ONCE:
            stack += np.array_split(pairs, len(pairs) // PAIRS_AT_ONCE + 1)
            continue
        if not len(pairs):
            continue
        a0, a1, b0, b1 = pairs.T
        ca, cb = _common(v, a0, a1), _common(v, b0, b1)
        depth = np.minimum(ca, cb)
        same = a0 == b0
        near = same | (_differ(v[a0], v[b0], depth) <= max_bits)
        leaf = near & (depth == 64) & ~same
        if leaf.any():
            _link(root, a0[leaf], b0[leaf])
        go = near & (depth < 64)
        if not go.any():
            continue
        a0, a1, b0, b1, ca, cb, same = (x[go] for x in (a0, a1, b0, b1, ca, cb, same))
        turn = ~same & (cb < ca)  # the node that branches first is split
        a0, a1, b0, b1, ca = np.where(turn, b0, a0), np.where(turn, b1, a1), np.where(turn, a0, b0), np.where(turn, a1, b1), np.where(turn, cb, ca)
        low = (63 - ca).astype(np.uint64)
        cut = _cut(v, a0, a1, (v[a1 - 1] >> low) << low)
        one, two = np.where(same, a0, b0), np.where(same, cut, b1)
        children = [np.stack([a0, cut, one, two], 1), np.stack([cut, a1, np.where(same, cut, b0), np.where(same, a1, b1)], 1)]
        children.append(np.stack([a0, cut, cut, a1], 1)[same])
        out = np.concatenate(children)
        single = (out[:, 1] - out[:, 0] == 1) & (out[:, 0] == out[:, 2])  # one value against itself
        stack.append(out[~single])
    return _settled(root)


def _cut(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """First position of each range whose value is at least the bound (binary search over all ranges at once)."""
    lo, hi = lo.copy(), hi - 1
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        less = v[mid] < bound
        lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
    return lo


def _settled(root: np.ndarray) -> np.ndarray:
    while (up := root[root]).tobytes() != root.tobytes():
        root = up
    return root


def _link(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        root[:] = _settled(root)
        a, b = root[a], root[b]
        open_ = a != b
        a, b = a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))


def links(distinct: DataFrame, max_bits: int = 3, bucket_limit: int = 50_000) -> DataFrame:
    """A spanning forest (a, b) of the links between ``distinct.fp`` values."""
    blocks = max_bits + 1
    width = 64 // blocks
    turned = distinct.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), _turn(F.col("fp"), i * width).alias("v")) for i in range(blocks)])).alias("t")
    ).select("t.*")
    block = F.shiftrightunsigned("v", 64 - width)
    turned = turned.withColumn("bucket", F.concat_ws(":", "turn", block))
    hot = turned.groupBy("bucket").count().where(F.col("count") > bucket_limit).select("bucket", F.lit(True).alias("hot"))
    rest = (64 - width) // blocks
    again = F.array(
        *[
            F.concat_ws(":", "bucket", F.lit(i), F.shiftrightunsigned("v", 64 - width - (i + 1) * rest).bitwiseAND((1 << rest) - 1))
            for i in range(blocks)
        ]
    )
    dealt = turned.join(hot, "bucket", "left").select(
        "turn", "v", F.explode(F.when(F.col("hot"), again).otherwise(F.array("bucket"))).alias("bucket")
    )
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "v")

    def walk(batches):
        """Buckets come whole and in order; a bucket that goes on in the next batch waits for it."""
        turn, v, name = [], [], []

        def done(upto: int):
            if not upto:
                return None
            values, names = np.array(v[:upto], np.int64).view(np.uint64), name[:upto]
            edges = [0, *(i for i in range(1, upto) if names[i] != names[i - 1]), upto]
            ranges = list(zip(edges, edges[1:]))
            for lo, hi in ranges:  # the sort was by signed values
                values[lo:hi].sort()
            root = trie_forest(values, ranges, max_bits)
            moved = np.flatnonzero(root != np.arange(upto))
            back = np.array(turn[:upto], np.int64) * width
            un = [_turn_back(values[i], back[moved]) for i in (moved, root[moved])]
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in un], names=["a", "b"])

        for batch in batches:
            turn += batch.column(0).to_pylist()
            v += batch.column(1).to_pylist()
            name += batch.column(2).to_pylist()
            upto = len(name)
            while upto and name[upto - 1] == name[-1]:
                upto -= 1
            if upto:
                yield done(upto)
                del turn[:upto], v[:upto], name[:upto]
        if name:
            yield done(len(name))

    return dealt.mapInArrow(walk, "a bigint, b bigint")


def _turn(fp: Column, by: int) -> Column:
    """Bits rotated left."""
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def _turn_back(v: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64)
    return np.where(by == 0, v, (v >> by) | (v << ((np.uint64(64) - by) % np.uint64(64))))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row per input row: doc_id, fp (signed 64-bit fingerprint), component_id.

    ``component_id`` is the smallest id reachable by links of at most
    ``max_bits`` differing bits, the row's own id included.  Null and empty
    texts have fingerprint 0 and are linked with each other; repeated rows
    stay; a null id is never the smallest unless a component has no other.
    Columns besides id and text are not read.  An empty table gives no rows.
    """
    rows = common.written(docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col), width).alias("fp")), "fingerprints")
    least = common.kept(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = common.components(links(least, max_bits))
    rooted = least.join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    per_fp = common.kept(rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id"))
    return rows.join(per_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, one for each group of near-duplicates.

    The row with the group's smallest id stays (null ids come last).  Of
    rows that repeat that id the one with the least hash of its columns
    stays, and one of rows that are equal throughout.
    """
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), mark.alias("mark"))
    near = near_duplicates(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", width, max_bits)
    lead = common.kept(near.where("doc_id = component_id").groupBy("doc_id").count().select("doc_id.id", "doc_id.mark", "count"))

    def rows_of(keys: DataFrame) -> DataFrame:
        keys = keys.select(F.col("id").alias("_lead_id"), F.col("mark").alias("_lead_mark"))
        return docs.join(keys, (mark == F.col("_lead_mark")) & docs[id_col].eqNullSafe(F.col("_lead_id")), "left_semi")

    return rows_of(lead.where("count = 1")).union(rows_of(lead.where("count > 1")).distinct())
