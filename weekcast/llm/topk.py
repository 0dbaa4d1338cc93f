"""Exact top-k BM25 search: a table of common words and an inverted index of the others per shard, merged with global statistics.

*Index.*  Documents are written as (distinct word hashes, counts, length), and
once the number of documents of each word.  A shard is what a task reads of the documents, of
bounded size.  Its common words, those that many pairs of a document and a
query share, are the columns of a table of impacts; the others have postings, ordered by word and document.

*Search.*  Queries come in blocks of bounded number; each is one pass over all
shards.  A query of whole texts has hundreds of words and shares a few with every document,
so bounds of blocks of documents rule out next to none: all documents are
scored, by one product of the table with ``PRODUCT`` queries and the sums of the other
words' postings.  The product is in single precision; the documents that may be among
the best k by it, whatever its rounding, are scored again exactly.  Of a task's
later shards only documents that reach the k-th best score of the earlier ones are looked at.

*Merge.*  Impacts use the global document count, mean length and
frequencies, so shard scores are final, and the best k of all tasks' best k are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common, wordhash
from .bm25 import B, K1, idf

SHARD_DOCS = 16_384
SHARD_WORDS = 2_000_000
#: Shards of a task, if there are so many that all cores have tasks.
TASK_SHARDS = 8
#: Documents that a task is given at once.
BATCH_DOCS = 1024
QUERIES_AT_ONCE = 16_384
#: Queries whose scores by a shard's common words are one product.
PRODUCT = 256
#: A word is a column of that product if so large a share of all pairs of a document and a query hold it; at most so many are.
COMMON_SHARE = 0.006
COMMON_WORDS = 1024
#: Queries whose postings are gathered together.
GATHERED = 16
#: Documents whose k-th best score is a first floor.
FIRST_DOCS = 2048


def _word_order(words: np.ndarray) -> np.ndarray:
    """The stable order of hashes.  A sort of the upper bits with the place below is several times quicker than ``argsort``."""
    bits = np.uint64(len(words).bit_length())
    key = words >> bits << bits | np.arange(len(words), dtype=np.uint64)
    key.sort()
    order = (key & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    found = words[order]
    if (found[1:] < found[:-1]).any():  # words that differ in the lower bits only
        return np.argsort(words, kind="stable")
    return order


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers from lo to hi - 1 of each pair, one after the other."""
    n = hi - lo
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


class Shard:
    """Impacts of the words in ``terms`` (sorted hashes, with their idf and the number of queries that ask for them) in some documents."""

    def __init__(self, ids: np.ndarray, words: list[np.ndarray], counts: list[np.ndarray], length: np.ndarray, terms: np.ndarray, weight: np.ndarray, asked: np.ndarray, queries: int, mean: float):
        self.ids, size = ids, len(terms)
        n = np.array([len(w) for w in words], np.int64)
        every = np.concatenate([*words, np.zeros(0, np.uint64)])
        order = _word_order(every)
        every = every[order]
        new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
        held, many = every[new], np.diff(np.append(new, len(every)))
        del every
        t = np.minimum(np.searchsorted(terms, held), max(0, size - 1))
        known = terms[t] == held if size else np.zeros(len(held), bool)
        # by document, words as they come; those that no query asks for are one term more
        self.tid = np.empty(len(order), np.int32)
        self.tid[order] = np.repeat(np.where(known, t, size).astype(np.int32), many)
        self.doc_at = np.concatenate([[0], np.cumsum(n)])
        tf, doc = np.concatenate([*counts, np.zeros(0, np.int32)]).astype(float), np.repeat(np.arange(len(ids), dtype=np.int32), n)
        self.impact = np.append(weight, 0.0)[self.tid]
        self.impact *= tf
        self.impact *= K1 + 1
        tf += np.repeat(K1 * (1 - B + B * length / max(mean, 1e-9)), n)
        self.impact /= tf
        del tf
        # the words that most pairs of a document and a query share are columns of a table
        df = np.zeros(size + 1, np.int64)
        df[t[known]] = many[known]
        shared = df[:size] * asked
        common = np.flatnonzero(shared >= max(1, COMMON_SHARE * len(ids) * queries))
        common = common[np.argsort(-shared[common], kind="stable")[:COMMON_WORDS]]
        self.column = np.full(size + 1, -1, np.int32)
        self.column[common] = np.arange(len(common))
        self.table = np.zeros((len(common), len(ids)), np.float32)
        column = self.column[self.tid]
        self.table[column[column >= 0], doc[column >= 0]] = self.impact[column >= 0]
        # all others have postings, by word: a document and its impact in single precision, side by side
        known[known] = self.column[t[known]] < 0
        order = order[np.repeat(known, many)]
        self.posts = np.empty((len(order), 2), np.int32)
        self.posts[:, 0], self.posts[:, 1] = doc[order], self.impact[order].astype(np.float32).view(np.int32)
        self.posts = self.posts.reshape(-1).view(np.int64)
        df[common] = 0
        self.term_at = np.concatenate([[0], np.cumsum(df[:size])])

    @property
    def post_doc(self) -> np.ndarray:
        return self.posts.view(np.int32)[::2]

    def search(self, queries: list[np.ndarray], k: int, floors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query of term numbers: (documents, scores) of its best ``k``, best first; ties by id; only scores above 0.

        ``floors``: for each query a score that at least ``k`` documents of all shards are known to reach.
        """
        inside = np.zeros(len(self.column), bool)
        for first in range(0, len(queries), PRODUCT):
            part = queries[first : first + PRODUCT]
            ask = np.zeros((len(part), len(self.table)), np.float32)
            for i, query in enumerate(part):
                column = self.column[query]
                ask[i, column[column >= 0]] = 1
            for query, dense, total, floor in zip(part, ask @ self.table, self._sparse(part), floors[first : first + PRODUCT]):
                total = total + dense
                # impacts are not negative: a sum of so many rounded ones is off by no more than this share
                slack = (1e-9 + (len(self.table) + 8) * 2.0**-23) * max(1.0, float(total.max(initial=0)))
                least = max(floor - slack, 0.0)
                if floor <= 0 and len(total) > FIRST_DOCS >= k:
                    least = max(least, np.partition(total[:FIRST_DOCS], FIRST_DOCS - k)[FIRST_DOCS - k] - 2 * slack)
                may = np.flatnonzero(total >= least)
                if len(may) > k:
                    least = max(least, np.partition(total[may], len(may) - k)[len(may) - k] - 2 * slack)
                    may = may[total[may] >= least]
                # the exact scores of all documents that may be among the best
                inside[query] = True
                lo, hi = self.doc_at[may], self.doc_at[may + 1]
                own = _ranges(lo, hi)
                hit = inside[self.tid[own]]
                score = np.bincount(np.repeat(np.arange(len(may)), hi - lo)[hit], self.impact[own[hit]], minlength=len(may))
                inside[query] = False
                may, score = may[score > 0], score[score > 0]
                best = np.lexsort((self.ids[may], -score))[:k]
                yield self.ids[may[best]], score[best]

    def _sparse(self, queries: list[np.ndarray]) -> Iterator[np.ndarray]:
        """For each query the sums of the impacts of its words that are no columns, for each document."""
        for first in range(0, len(queries), GATHERED):
            part = queries[first : first + GATHERED]
            every = np.concatenate(part)
            lo, hi = self.term_at[every], self.term_at[every + 1]
            post = self.posts[_ranges(lo, hi)].view(np.int32)
            doc, impact = post[::2], post.view(np.float32)[1::2]
            at = np.concatenate([[0], np.cumsum(hi - lo)])[np.cumsum([0, *(len(q) for q in part)])].tolist()
            for i, j in zip(at, at[1:]):
                yield np.bincount(doc[i:j], impact[i:j], minlength=len(self.ids))


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: doc_id, words (distinct hashes, ascending), counts, length."""
    is_word = docs.sparkSession.sparkContext.broadcast(wordhash.word_characters())
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for i, j in common.by_size([len(t) for t in texts]):
                h, doc = wordhash.hashed(texts[i:j], is_word.value)
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else np.zeros(0, int)
                count = np.diff(np.append(new, len(h))).astype(np.int32)
                at = np.searchsorted(doc[new], np.arange(j - i + 1)).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(at), pa.array(h[new].view(np.int64)))
                counts = pa.ListArray.from_arrays(pa.array(at), pa.array(count))
                length = np.bincount(doc, minlength=j - i).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), words, counts, pa.array(length)], names=["doc_id", "words", "counts", "length"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(terms, f"doc_id {kind}, words array<bigint>, counts array<int>, length int")
    return common.written(out, "index")


def search(found: DataFrame, queries: DataFrame, k: int = 10, at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """The best ``k`` documents of the index ``found`` for each query (query_id, words): query_id, rank, doc_id, score.

    Ties go to the least doc_id; a document without a word of the query is
    no result, so a query may have fewer than ``k`` or none.
    """
    spark = found.sparkSession
    kinds = dict(found.dtypes)["doc_id"], dict(queries.dtypes)["query_id"]
    n, total, entries = found.agg(F.count(F.lit(1)), F.sum("length"), F.sum(F.size("words"))).first()
    found = found.coalesce(max(4 * spark.sparkContext.defaultParallelism, -(-(entries or 0) // (TASK_SHARDS * SHARD_WORDS))))
    arrow = [to_arrow_type(queries.schema["query_id"].dataType), to_arrow_type(found.schema["doc_id"].dataType), pa.float64()]
    blocks = max(1, -(-queries.count() // at_once))
    mean = (total or 0) / max(1, n)
    frequency = _frequencies(found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))  # k rows of each task
    best = None
    for block in range(blocks):  # a block's queries are a bounded number: they are broadcast while it is answered
        rows = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).select("query_id", "words").toArrow()
        names, lists = rows["query_id"].to_pylist(), rows["words"].combine_chunks() if rows.num_rows else []
        words = [np.unique(np.asarray(x.values).view(np.uint64)) for x in lists]
        terms = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
        asked = spark.sparkContext.broadcast(terms)

        def of_terms(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = np.asarray(batch.column(0)).view(np.uint64)
                at = np.searchsorted(asked.value, own)
                yield batch.filter(pa.array(np.append(asked.value, 0)[at] == own) if len(asked.value) else pa.array(np.zeros(len(own), bool)))

        got = frequency.mapInArrow(of_terms, frequency.schema).toArrow()
        df = np.zeros(len(terms))
        df[np.searchsorted(terms, np.asarray(got["word"]).view(np.uint64))] = np.asarray(got["n"])
        asked.unpersist()
        shared = spark.sparkContext.broadcast((terms, names, [np.searchsorted(terms, w).astype(np.int32) for w in words], idf(df, n)))

        schema = f"query_id {kinds[1]}, doc_id {kinds[0]}, score double"
        hits = found.mapInArrow(_searcher(shared, mean, k, arrow), schema).withColumn("score", F.round("score", 6)).withColumn("rank", rank)
        hits = _written(hits.where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score"), "answers")
        shared.unpersist()
        best = hits if best is None else best.union(hits)
    return best


def _written(df: DataFrame, name: str) -> DataFrame:
    """:func:`common.written`, with small batches of documents, as each has hundreds of words."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(BATCH_DOCS))
    try:
        return common.written(df, name)
    finally:
        conf.set(key, before)


def _frequencies(found: DataFrame) -> DataFrame:
    """The number of documents of each word (word, n), written: one pass for all blocks of queries."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counts() -> pa.RecordBatch:
            words = np.sort(np.concatenate(held).view(np.uint64))
            new = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(words[new].view(np.int64)), pa.array(np.diff(np.append(new, len(words))))], names=["word", "n"])

        for batch in batches:
            held.append(np.asarray(batch.column(0).flatten()))
            size += len(held[-1])
            if size >= SHARD_WORDS:
                yield counts()
                held, size = [], 0
        if held:
            yield counts()

    return _written(found.select("words").mapInArrow(counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "frequencies")


def _searcher(shared, mean: float, k: int, kinds: list):
    """The function that answers a block of queries on one shard after the other, and gives the best of all at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a task reads is a shard, or several of at most SHARD_DOCS documents and SHARD_WORDS entries."""
        terms, names, lists, weight = shared.value
        asked = np.bincount(np.concatenate([*lists, np.zeros(0, np.int32)]), minlength=len(terms))
        floors = np.full(len(names), -np.inf)
        best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(names)

        def look(ids: list, parts: list[pa.RecordBatch]) -> None:
            words = [np.asarray(x.values).view(np.uint64) for p in parts for x in p.column(1)]
            counts = [np.asarray(x.values) for p in parts for x in p.column(2)]
            length = np.concatenate([np.asarray(p.column(3)) for p in parts]).astype(float)
            shard = Shard(np.asarray(ids), words, counts, length, terms, weight, asked, len(names), mean)
            for i, (found, score) in enumerate(shard.search(lists, k, floors)):
                if not len(score):
                    continue
                if (before := best[i]) is not None:
                    found, score = np.concatenate([before[0], found]), np.concatenate([before[1], score])
                    order = np.lexsort((found, -score))[:k]
                    found, score = found[order], score[order]
                best[i] = found, score
                if len(score) == k:
                    floors[i] = score[-1]

        ids, parts, words = [], [], 0
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_DOCS):
                batch = whole.slice(i, BATCH_DOCS)
                ids += batch.column(0).to_pylist()
                parts.append(batch)
                words += len(batch.column(1).flatten())
                if len(ids) >= SHARD_DOCS or words >= SHARD_WORDS:
                    look(ids, parts)
                    ids, parts, words = [], [], 0
        if ids:
            look(ids, parts)
        out: list[list] = [[], [], []]
        for name, held in zip(names, best):
            if held is not None:
                out[0] += [name] * len(held[0])
                out[1] += held[0].tolist()
                out[2] += held[1].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=["query_id", "doc_id", "score"])

    return run


def like_documents(docs: DataFrame, every: int = 50, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document whose id is divisible by ``every``, as a query of all its distinct words, against all documents (itself too).

    Null ids are neither queries nor results; null, empty and wordless texts
    find nothing and are not found; rows that repeat an id are documents of
    their own, and as a query one with the words of all; other columns are not read.
    """
    found = index(docs, id_col, text_col)
    queries = found.where(F.col("doc_id") % every == 0).groupBy(F.col("doc_id").alias("query_id")).agg(F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"))
    return search(found, common.written(queries, "queries"), k)
