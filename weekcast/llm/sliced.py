"""Ranked lexical search over bit-sliced Bloom signatures; results are exact.

*Index.*  Documents of like size stand together in blocks.  A block's
signature is a table of bits, one row for each place of a Bloom filter and
one column for each document.  A document sets ``PROBES`` rows for each of
its terms, and again for the term at each count of 2, 4, 8 ... that it
reaches.  Next to the bits the block holds the documents' terms and counts.

*Bounds.*  The rows of a term (and count step), cut with each other, are a
bitmap of the documents that may hold it: too many at times, never too few.
For each step the bitmaps are summed, weighted by the terms' weights: a slice
sum.  A document's slice sums times the greatest impact that a count of
that step has at its length are an upper bound of its score.

*Search.*  Blocks come one after the other; a document is left out only if
its bound is below the score of the k-th best document found so far.  All
others are scored exactly from their counts.  Statistics are those of all
documents, so the best k of all tasks' best k are exact.

Terms are the runs of ASCII letters and digits and of all other characters
beyond ASCII, A-Z in lower case, as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common
from .bytespans import flat, hashes
from .topk import _ranges

#: Bits of signature for each key (a term at a count step) of a block's largest document; bits that a key sets.
BITS_A_KEY, PROBES = 12, 3
#: Count steps 1, 2, 4, ... 2**(STEPS - 1).
STEPS = 6
#: A block's documents, keys and bits at most (a larger document is a block of its own), and how much larger its largest document is than its least.
BLOCK_DOCS, BLOCK_KEYS, BLOCK_BITS, SPREAD = 1024, 1 << 19, 1 << 25, 1.5
#: Documents and keys from which blocks are cut at once.
POOL_DOCS, POOL_KEYS = 8192, 1 << 21
QUERIES_AT_ONCE, QUERY_CHARS, QUERY_GROUP = 4096, 20_000_000, 32
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every term, number of its text), in text order."""
    inside = _TERM[data]
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    first = np.flatnonzero(inside & (~before | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    last = np.flatnonzero(inside & (~after | edge[1:])) + 1 if len(data) else first
    return hashes(data, first, last), np.searchsorted(at, first, side="right") - 1


def counted(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of texts i to j: (i, j, distinct terms by text and hash, counts, offsets by text, terms with repeats by text)."""
    data, at = flat(column)
    for i, j in common.by_size(np.diff(at).tolist()):
        h, doc = terms_of(data[at[i] : at[j]], at[i : j + 1] - at[i])
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else np.zeros(0, np.int64)
        yield i, j, h[new], np.diff(np.append(new, len(h))), np.searchsorted(doc[new], np.arange(j - i + 1)), np.bincount(doc, minlength=j - i)


def _places(h: np.ndarray, step: np.ndarray | int, rows: int) -> np.ndarray:
    """The PROBES rows of each key."""
    key = (h + np.uint64(1)) * _ODD[1] + np.asarray(step, np.uint64) * _ODD[2]
    key ^= key >> np.uint64(31)
    mixed = key[..., None] * _ODD
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(rows)).astype(np.int64)


def signature(term: np.ndarray, tf: np.ndarray, at: np.ndarray) -> tuple[int, np.ndarray]:
    """(rows, packed bits rows x documents) of a block's documents."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    step = np.minimum(np.log2(tf).astype(np.int64), STEPS - 1) if len(tf) else tf
    keys = np.bincount(doc, step + 1, minlength=len(at) - 1)
    rows = max(64, int(BITS_A_KEY * keys.max(initial=0)))
    bits = np.zeros((rows, len(at) - 1), bool)
    for j in range(STEPS):
        own = step >= j
        if own.any():
            bits[_places(term[own], j, rows), doc[own, None]] = True
    return rows, np.packbits(bits, axis=1)


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index, one row a block: ids, docs, words (terms with repeats), n, at, terms, tf, rows, bits.

    Documents without a term are not in it.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    arrow = pa.schema([
        ("ids", pa.list_(id_type)), ("docs", pa.int64()), ("words", pa.int64()), ("n", pa.binary()), ("at", pa.binary()),
        ("terms", pa.binary()), ("tf", pa.binary()), ("rows", pa.int64()), ("bits", pa.binary()),
    ])
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"ids array<{kind}>, docs bigint, words bigint, n binary, at binary, terms binary, tf binary, rows bigint, bits binary"

    def cut(pool: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids = pa.concat_arrays([p[0] for p in pool])
        term, tf = np.concatenate([p[1] for p in pool]), np.concatenate([p[2] for p in pool])
        size, n = np.concatenate([np.diff(p[3]) for p in pool]), np.concatenate([p[4] for p in pool])
        start = np.cumsum(size) - size
        step = np.minimum(np.log2(tf).astype(np.int64), STEPS - 1) + 1 if len(tf) else tf
        keys = np.add.reduceat(step, start[size > 0]) if len(tf) else size
        full = np.zeros(len(size), np.int64)
        full[size > 0] = keys if len(tf) else 0
        order = np.argsort(full, kind="stable")
        order = order[n[order] > 0]
        first = 0
        while first < len(order):
            most = np.cumsum(full[order[first : first + BLOCK_DOCS]])
            own = full[order[first : first + BLOCK_DOCS]]
            fits = (most <= BLOCK_KEYS) & (own <= max(16, SPREAD * own[0])) & (BITS_A_KEY * own * np.arange(1, len(own) + 1) <= BLOCK_BITS)
            last = first + max(1, len(own) if fits.all() else int(np.argmin(fits)))
            part = order[first:last]
            post = _ranges(start[part], start[part] + size[part])
            at = np.concatenate([[0], np.cumsum(size[part])])
            rows, bits = signature(term[post], tf[post], at)
            small = np.min_scalar_type(int(tf[post].max()))
            cells = [
                ids.take(pa.array(part)).to_pylist(), len(part), int(n[part].sum()), n[part].astype(np.int64).tobytes(), at.astype(np.int64).tobytes(),
                term[post].tobytes(), tf[post].astype(small).tobytes(), rows, bits.tobytes(),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, arrow)], schema=arrow)
            first = last

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, held, keys = [], 0, 0
        for batch in batches:
            for i, j, term, tf, at, n in counted(batch.column(1)):
                pool.append((batch.column(0).slice(i, j - i), term, tf, at, n))
                held, keys = held + j - i, keys + len(term)
                if held >= POOL_DOCS or keys >= POOL_KEYS:
                    yield from cut(pool)
                    pool, held, keys = [], 0, 0
        if pool:
            yield from cut(pool)

    return common.written(rows.mapInArrow(blocks, schema), "sliced-index")


class Block:
    """One row of the index, with the counts of the terms in ``vocabulary`` (sorted hashes) alone."""

    def __init__(self, row: dict, vocabulary: np.ndarray, n_docs: int, n_words: int):
        self.ids = row["ids"]
        n = np.frombuffer(row["n"], np.int64)
        self.m = 10 + 90 * n * n_docs // max(1, n_words)
        at = np.frombuffer(row["at"], np.int64)
        term = np.frombuffer(row["terms"], np.uint64)
        tf = np.frombuffer(row["tf"], f"<u{len(row['tf']) // max(1, len(term))}") if len(term) else np.zeros(0, np.uint8)
        tid = np.minimum(np.searchsorted(vocabulary, term), max(0, len(vocabulary) - 1))
        known = np.flatnonzero(vocabulary[tid] == term) if len(vocabulary) else np.zeros(0, np.int64)
        self.tid, tf = tid[known], tf[known].astype(np.int64)
        self.at = np.searchsorted(known, at)
        self.impact = impact(tf, np.repeat(self.m, np.diff(self.at)))
        self.rows = row["rows"]
        self.bits = np.frombuffer(row["bits"], np.uint8).reshape(self.rows, -1)

    def bounds(self, vocabulary: np.ndarray, groups: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Upper bounds queries x documents.  A group is (its term numbers, weights queries x terms)."""
        docs = len(self.ids)
        total = np.zeros((sum(len(w) for _, w in groups), docs), np.int64)
        below, reached = np.zeros(docs, np.int64), None
        for j in range(STEPS):
            most = impact(np.int64(2 ** (j + 1) - 1), self.m) if j + 1 < STEPS else np.full(docs, 1_000_000)
            places = _places(vocabulary, j, self.rows)
            held = self.bits[places[:, 0]]
            for p in range(1, PROBES):
                held = held & self.bits[places[:, p]]
            reached = held if reached is None else held & reached  # a count step needs all before it
            some = reached.any(axis=1)
            if not some.any():
                break
            first = 0
            for tid, weight in groups:
                own = some[tid]
                if own.any():
                    may = np.unpackbits(reached[tid[own]], axis=1, count=docs).astype(weight.dtype)
                    total[first : first + len(weight)] += (weight[:, own] @ may).astype(np.int64) * (most - below)
                first += len(weight)
            below = most
        return total

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of some documents for a query with these ``weight`` by term number."""
        post = _ranges(self.at[docs], self.at[docs + 1])
        own = np.repeat(np.arange(len(docs)), self.at[docs + 1] - self.at[docs])
        return np.bincount(own, weight[self.tid[post]] * self.impact[post], minlength=len(docs)).astype(np.int64)  # below 2**53


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


class Searcher:
    """The best ``k`` documents so far of a block of queries (lists of term numbers)."""

    def __init__(self, vocabulary: np.ndarray, queries: list[np.ndarray], weight: np.ndarray, k: int):
        self.vocabulary, self.queries, self.weight, self.k = vocabulary, queries, weight, k
        self.best: list[list] = [[] for _ in queries]
        self.floor = np.ones(len(queries), np.int64)  # a score above 0
        self.groups, self.scored = [], 0
        for i in range(0, len(queries), QUERY_GROUP):
            part = queries[i : i + QUERY_GROUP]
            tid = np.unique(np.concatenate(part))
            table = np.zeros((len(part), len(tid)), np.float64)
            for row, q in zip(table, part):
                row[np.searchsorted(tid, q)] = weight[q]
            small = table.sum(axis=1).max(initial=0) < 1 << 24  # such sums are exact in single precision
            self.groups.append((tid, table.astype(np.float32) if small else table))

    def read(self, block: Block) -> None:
        bound = block.bounds(self.vocabulary, self.groups)
        open_ = bound >= self.floor[:, None]
        for q in np.flatnonzero(open_.any(axis=1)):
            weight = np.zeros(len(self.vocabulary), np.int64)
            weight[self.queries[q]] = self.weight[self.queries[q]]
            may = np.flatnonzero(open_[q])
            may = may[np.argsort(-bound[q, may], kind="stable")]
            at, step = 0, 2 * self.k
            while at < len(may) and bound[q, may[at]] >= self.floor[q]:
                part = may[at : at + step]
                part = part[bound[q, part] >= self.floor[q]]
                score = block.scores(part, weight)
                self.scored += len(part)
                for d in np.flatnonzero(score >= self.floor[q]).tolist():
                    i = block.ids[part[d]]
                    self.best[q].append((-int(score[d]), i is None, i))
                self.best[q].sort(key=lambda x: x if not x[1] else x[:2])
                del self.best[q][self.k :]
                if len(self.best[q]) == self.k:
                    self.floor[q] = max(1, -self.best[q][-1][0])
                at, step = at + step, 4 * step


def search(found: DataFrame, items: DataFrame, k: int = 10, at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """The best ``k`` documents of the index ``found`` for each row (item_id, text) of ``items``: item_id, rank, doc_id, score."""
    spark = found.sparkSession
    id_type = found.schema["ids"].dataType.elementType
    item_type = items.schema["item_id"].dataType
    n_docs, n_words = found.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    items = common.kept(items.distinct())
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // at_once), -(-chars // QUERY_CHARS))
    arrow = pa.schema([("item", pa.int64()), ("item_id", to_arrow_type(item_type)), ("doc_id", to_arrow_type(id_type)), ("score", pa.int64())])
    schema = f"item bigint, item_id {item_type.simpleString()}, doc_id {id_type.simpleString()}, score bigint"
    best = None
    for number in range(blocks):  # a bounded number of queries: collected and broadcast
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).select("item_id", "text").toArrow()
        names = rows["item_id"].to_pylist()
        text = rows["text"].combine_chunks() if rows.num_rows else pa.array([], pa.string())
        lists = [term[a:b] for _, _, term, _, at, _ in counted(text if isinstance(text, pa.Array) else text.chunk(0)) for a, b in zip(at[:-1], at[1:])]
        vocabulary = np.unique(np.concatenate([*lists, np.zeros(0, np.uint64)]))
        asked = spark.sparkContext.broadcast(vocabulary)

        def frequency(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            vocabulary = asked.value
            count = np.zeros(len(vocabulary) + 1, np.int64)
            for batch in batches:
                for packed in batch.column(0).to_pylist():
                    term = np.frombuffer(packed, np.uint64)
                    at = np.searchsorted(vocabulary, term)
                    count += np.bincount(at[np.append(vocabulary, 0)[at] == term], minlength=len(count))[: len(count)]
            some = np.flatnonzero(count[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["t", "n"])

        got = found.select("terms").mapInArrow(frequency, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
        df = np.zeros(len(vocabulary), np.int64)
        df[np.asarray(got["t"])] = np.asarray(got["n"])
        queries = [np.searchsorted(vocabulary, q) for q in lists]
        shared = spark.sparkContext.broadcast((vocabulary, names, queries, term_weights(df, n_docs)))

        def answers(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            vocabulary, names, queries, weight = shared.value
            search = Searcher(vocabulary, queries, weight, k)
            for batch in batches:
                for row in batch.to_pylist():
                    search.read(Block(row, vocabulary, n_docs, n_words))
            out = [(number << 32 | q, names[q], i, -s) for q, own in enumerate(search.best) for s, _, i in own]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        hits = found.select("ids", "n", "at", "terms", "tf", "rows", "bits").mapInArrow(answers, schema)
        best = hits if best is None else best.union(hits)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))  # k rows of each task, cut to k before the shuffle
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``k`` best documents of each item, equal scores by ascending id (null ids last).

    Scores are whole numbers: the sum over the item's distinct terms of
    weight times impact (:func:`term_weights`, :func:`impact`).  Documents
    that score 0 are no results, so an item may have fewer than ``k`` or, if
    null, empty or without a known term, none.  Documents without a term
    don't count in the statistics.  Rows that repeat an id or a text are
    documents of their own; items that share an id but not the text each
    have their ranks, equal items have them once.  Texts of any length are
    read whole.  Without items or documents there are no rows.  Other
    columns aren't read.
    """
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    return search(index(docs, id_col, text_col), asked, k)


def sql(k: int = 10) -> str:
    """DuckDB SQL of the ranking over ``documents`` and ``benchmark``."""
    terms = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
with i as (select row_number() over () as q, item_id, text from (select distinct item_id, text from benchmark)),
a as (select distinct q, item_id, unnest({terms}) as term from i),
d as (select row_number() over () as r, doc_id, {terms} as parts from documents),
s as (select count(*) as big_n, cast(sum(len(parts)) as bigint) as big_l from d where len(parts) > 0),
p as (select r, doc_id, len(parts) as n, unnest(parts) as term from d),
t as (select r, doc_id, n, term, count(*) as tf from p where term in (select term from a) group by all),
f as (select term, cast(floor(1000 * ln(cast(2 * (select big_n from s) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w from t group by term),
x as (select q, item_id, r, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * (select big_n from s)) // (select big_l from s))))) as bigint) as score
      from a join t using (term) join f using (term) group by all),
o as (select item_id, cast(row_number() over (partition by q order by score desc, doc_id) as int) as rank, doc_id, score from x where score > 0)
select item_id, rank, doc_id, score from o where rank <= {k}"""
