"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

*Passages.*  A text is cut into windows of twice the longest item's words
that overlap by half, so an item that a text quotes lies whole in one of them.

*Retrieval.*  The items are a block-max WAND index (:mod:`.bm25`), impacts
scaled by each item's score for itself.  A passage gets all items that score
at least ``threshold``.

*Check.*  An item's answer is its last sentence (of one sentence: its last
third), the question what stands before.  Both must lie in the passage: a
share of at least ``overlap`` of their five-word shingles (a shorter part: the whole part).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common, wordhash
from .bm25 import BlockMaxIndex

SHINGLE = 5
#: Characters of items in one index: a larger benchmark is searched in several, one after the other.
INDEX_CHARS = 20_000_000
#: Passages times blocks whose bounds are held at once.
BOUNDS_AT_ONCE = 4_000_000


def parts(text: str) -> tuple[str, str]:
    """(question, answer) of a test item."""
    found = re.findall(r"[^.?!\n]*\w[^.?!\n]*", text)
    if len(found) > 1:
        return " ".join(found[:-1]), found[-1]
    words = text.split()
    cut = len(words) - max(1, len(words) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


@dataclass
class Items:
    """The index over the items' numbers and, by number, their ids and the shingles of question and answer."""

    index: BlockMaxIndex
    ids: list
    question: dict
    answer: dict
    size: dict
    window: int
    is_word: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[object, str]]) -> Items:
        ids, rows = [i for i, _ in rows], list(enumerate(t for _, t in rows))  # items may share an id
        words = {i: wordhash.hashed([t or ""])[0] for i, t in rows}
        rows = [(i, t) for i, t in rows if len(words[i])]
        halves = {i: [wordhash.hashed([x])[0] for x in parts(t)] for i, t in rows}
        sh = {i: [np.unique(wordhash.shingles(h, SHINGLE)) for h in two] for i, two in halves.items()}
        names = list(sh)
        index = BlockMaxIndex.build(names, [words[i] for i in names], block=4, scale=True)
        size = {i: [min(SHINGLE, len(h)) for h in two] for i, two in halves.items()}
        longest = max([len(words[i]) for i in names], default=1)
        return cls(index, ids, {i: s[0] for i, s in sh.items()}, {i: s[1] for i, s in sh.items()}, size, longest, wordhash.word_characters())

    def overlaps(self, item: int, words: np.ndarray) -> tuple[float, float]:
        out = []
        for own, width in zip((self.question[item], self.answer[item]), self.size[item]):
            there = wordhash.shingles(words, width) if len(words) >= width > 0 else words[:0]
            out.append(float(np.isin(own, there).mean()) if len(own) else 1.0)
        return out[0], out[1]

    def hits(self, texts: list[str], threshold: float, overlap: float) -> list[tuple[int, object, float, float, float]]:
        """(index of the text, item, score, question overlap, answer overlap): the best passage of each text and item."""
        h, doc = wordhash.hashed(texts, self.is_word)
        tid = self.index.term_ids(h)
        pos = np.arange(len(h)) - np.searchsorted(doc, np.arange(len(texts)))[doc] if len(h) else np.zeros(0, np.int64)
        n = np.bincount(doc, minlength=len(texts))
        last = np.maximum(0, -(-n // self.window) - 2)  # a text's last passage: the windows before cover the rest
        base = np.cumsum(last + 1) - (last + 1)
        own = np.minimum(pos // self.window, last[doc])
        known = tid >= 0
        passage = base[doc] + own
        second = known & (pos // self.window > 0) & (pos // self.window - 1 < own)
        second |= known & (own > 0) & (pos // self.window == own)
        terms = len(self.index.terms) + 1
        keys = np.unique(np.concatenate([passage[known] * terms + tid[known], (passage[second] - 1) * terms + tid[second]]))
        p, t = np.divmod(keys, terms)
        first = np.flatnonzero(np.diff(p, prepend=-1))
        found: dict[tuple[int, object], tuple[float, float, float]] = {}
        text_of = np.repeat(np.arange(len(texts)), last + 1)
        start_of = np.searchsorted(doc, np.arange(len(texts)))
        step = max(1, BOUNDS_AT_ONCE // self.index.blocks)
        for lo in range(0, len(first), step):  # passages at once
            part = first[lo : lo + step]
            end = first[lo + step] if lo + step < len(first) else len(p)
            open_ = self.index.bounds(t[part[0] : end], part - part[0]) >= threshold
            for i in np.flatnonzero(open_.any(axis=1)):
                a, b = part[i], part[i + 1] if i + 1 < len(part) else end
                d = int(text_of[p[a]])
                s = start_of[d] + (p[a] - base[d]) * self.window
                words = h[s : min(s + 2 * self.window, start_of[d] + n[d])]
                for item, score in self.index.search(t[a:b], threshold, np.flatnonzero(open_[i])):
                    q, r = self.overlaps(item, words)
                    if q >= overlap and r >= overlap:
                        found[d, item] = max(found.get((d, item), (0.0, 0.0, 0.0)), (min(1.0, score), q, r))
        return [(d, self.ids[item], *best) for (d, item), best in found.items()]


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", threshold: float = 0.6, overlap: float = 0.8,
) -> DataFrame:
    """Rows (doc_id, item_id, score, question_overlap, answer_overlap), one for each document and item that it holds.

    Scores are BM25 as a share of the item's score for itself.  Null, empty
    and wordless texts and items have no rows; items with the same text each
    have their own, as have items with one id and several texts (a repeated
    item counts once); repeated documents each have theirs; texts of any
    length are searched whole, passage by passage; equal scores are all
    given; other columns aren't read; with no items or documents there are no rows.
    """
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_overlap double, answer_overlap double"
    arrow = to_arrow_type(items.schema[item_id].dataType)
    size = items.agg(F.sum(F.length(item_text))).first()[0] or 0
    shards = size // INDEX_CHARS + 1
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for shard in range(shards):  # one but for benchmarks beyond INDEX_CHARS; each shard's index fits a broadcast
        own = items.where(F.pmod(F.xxhash64(item_id, item_text), F.lit(shards)) == shard) if shards > 1 else items
        index = spark.sparkContext.broadcast(Items.of([tuple(r) for r in own.select(item_id, item_text).distinct().collect()]))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, texts = batch.column(0), [x or "" for x in batch.column(1).to_pylist()]
                for i, j in common.by_size([len(x) for x in texts]):
                    found = index.value.hits(texts[i:j], threshold, overlap)
                    if found:
                        at, item, score, q, a = zip(*found)
                        columns = [ids.take(pa.array([i + x for x in at])), pa.array(item, arrow), pa.array(score), pa.array(q), pa.array(a)]
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        hits = rows.mapInArrow(search, schema)
        out = hits if out is None else out.union(hits)
    return out


def without(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id has no hit (rows with a null id are matched with hits of null ids)."""
    bad = common.kept(hits.select(F.col("doc_id").alias("_hit_id")).distinct())
    return docs.join(bad, docs[id_col].eqNullSafe(F.col("_hit_id")), "left_anti")
