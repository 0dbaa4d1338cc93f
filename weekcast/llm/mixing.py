"""Mixing to target weights with soft domains.

*Classifier.*  The labelled table gives a domain to some documents; softmax
regression over hashed words (counts over the square root of the text's
words) and a few shares of characters learns it from about ``max_docs``
labelled rows, and gives every document a posterior over the domains.

*Rates.*  Document d gets a rate r_d >= 0, such that the expected tokens of
domain k, the sum of r_d * tokens_d * p_dk, meet the target T_k.  Weighted
least squares, by projected gradient from r = 1; each step moves r_d
against p_d . g (the gradient divided by the document's tokens) and cuts at
0.  As r_d depends on its own p_d and on the few vectors g alone, a step is one
distributed sum of as many numbers as there are domains; no rate is kept
between steps, and none goes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, wordhash

BINS = 1 << 15
DENSE = 6  # shares of characters and the like, after the bins


def features(texts: list[str], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of every word, index of its text, dense features of each text)."""
    h, doc = wordhash.hashed(texts, is_word)
    n = np.bincount(doc, minlength=len(texts))
    dense = np.zeros((len(texts), DENSE))
    for i, t in enumerate(texts):
        size = max(1, len(t))
        words = t.split()
        marks = t.translate(_DROPPED)
        dense[i] = (
            1.0, np.log1p(n[i]) / 10, len(marks) / size, upper_case(t) / size,
            len(set(words)) / max(1, len(words)), len(set(t.split("\n"))) / (t.count("\n") + 1),
        )
    return (h >> np.uint64(64 - 15)).astype(np.int64), doc, dense


@lru_cache(1)
def _upper() -> np.ndarray:
    """For each code point: is it an upper-case letter."""
    return np.fromiter((chr(i).isupper() for i in range(0x110000)), bool, 0x110000)


def upper_case(text: str) -> int:
    """Upper-case letters of a whole text."""
    return int(np.count_nonzero(_upper()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]))


#: Everything but plain punctuation marks is dropped when marks are counted: ASCII letters, digits and blanks.
_DROPPED = {c: None for c in [*range(48, 58), *range(65, 91), *range(97, 123), 32, 10]}


@dataclass
class Domains:
    names: list[str]
    weights: np.ndarray  # (BINS + DENSE) x domains
    is_word: np.ndarray

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, posterior over the domains) of each text."""
        b, doc, dense = features(texts, self.is_word)
        n = np.bincount(doc, minlength=len(texts))
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        z = dense @ self.weights[BINS:]
        if len(first):
            z[doc[first]] += np.add.reduceat(self.weights[b], first, axis=0) / np.sqrt(n[doc[first]])[:, None]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return n, e / e.sum(axis=1, keepdims=True)


def fit(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
    domain_col: str = "domain", max_docs: int = 4000, steps: int = 100, penalty: float = 1e-4,
) -> Domains:
    """Learn domains from about ``max_docs`` labelled rows (the bound of the sample, chosen by a hash of the id).

    Rows with a null domain are left out.  No labelled document is a ValueError.
    """
    spark = docs.sparkSession
    labelled = labelled.where(F.col(domain_col).isNotNull()).select(F.col(label_id).alias("_label_id"), F.col(domain_col).alias("_domain"))
    total = labelled.count()
    if total > max_docs:
        labelled = labelled.where(common.share_below(8, F.col("_label_id")) < max_docs / total)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    sample = rows.join(F.broadcast(labelled), F.col("_id") == F.col("_label_id")).select("_domain", "_text")
    is_word = spark.sparkContext.broadcast(wordhash.word_characters())

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            domain, texts = (c.to_pylist() for c in batch.columns)
            b, doc, dense = features(texts, is_word.value)
            at = np.searchsorted(doc, np.arange(len(texts) + 1))
            bins = [b[i:j].astype(np.int32) for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(domain), pa.array(bins, pa.list_(pa.int32())), pa.array(list(dense), pa.list_(pa.float64()))], names=["d", "bins", "dense"])

    got = sample.mapInArrow(describe, "d string, bins array<int>, dense array<double>").toArrow()  # bounded by max_docs
    if not got.num_rows:
        raise ValueError("no labelled documents")
    names = sorted(set(got["d"].to_pylist()))
    y = np.array([names.index(x) for x in got["d"].to_pylist()])
    bins = [np.asarray(x.as_py(), np.int64) for x in got["bins"]]
    dense = np.array(got["dense"].to_pylist())
    n = np.array([len(x) for x in bins])
    doc, col = np.repeat(np.arange(len(y)), n), np.concatenate(bins)
    value = 1 / np.sqrt(np.maximum(n, 1))[doc]
    key, back = np.unique(doc * BINS + col, return_inverse=True)  # one entry for a document's word
    doc, col, value = key // BINS, key % BINS, np.bincount(back, value)
    w = np.zeros((BINS + DENSE, len(names)))
    target = np.eye(len(names))[y]
    speed = np.full_like(w, 1e-8)
    for _ in range(steps):  # gradient steps scaled per weight
        z = dense @ w[BINS:]
        for k in range(len(names)):
            z[:, k] += np.bincount(doc, value * w[col, k], minlength=len(y))
        e = np.exp(z - z.max(axis=1, keepdims=True))
        off = (e / e.sum(axis=1, keepdims=True) - target) / len(y)
        grad = np.vstack([np.stack([np.bincount(col, value * off[doc, k], minlength=BINS) for k in range(len(names))], 1), dense.T @ off])
        grad += penalty * w / len(y)
        speed += grad**2
        w -= 0.5 * grad / np.sqrt(speed)
    return Domains(names, w, is_word.value)


def scored(text: Column, model: Domains, spark) -> Column:
    """struct(tokens bigint, p array<double>) of a text column: its words, and its posterior in the order of ``model.names``."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<tokens: bigint, p: array<double>>")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            texts, tokens, p = [t or "" for t in part.to_pylist()], [], []
            for i, j in common.by_size([len(t) for t in texts]):
                a, b = shared.value.posteriors(texts[i:j])
                tokens.append(a)
                p.append(b)
            k = len(shared.value.names)
            flat = np.concatenate([*p, np.zeros((0, k))])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * k, pa.int32()), pa.array(flat.ravel()))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)])), lists], names=["tokens", "p"])

    return of(text)


@dataclass
class Rates:
    """What a document's rate follows from: the step vectors, one for each step made."""

    steps: np.ndarray
    target: np.ndarray
    reached: np.ndarray

    def rate(self, p: Column) -> Column:
        """Rate of a document with posterior ``p``."""
        out = F.lit(1.0)
        if not len(self.steps):
            return out
        moves = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in self.steps])
        k = self.steps.shape[1]

        def move(r: Column, g: Column) -> Column:
            return F.greatest(F.lit(0.0), r - sum((p[i] * g[i] for i in range(1, k)), p[0] * g[0]))

        return F.aggregate(moves, out, move)


def fit_rates(
    rows: DataFrame, shares: np.ndarray, tokens: Column, p: Column, budget: float | None = None, max_steps: int = 60, tolerance: float = 1e-3
) -> Rates:
    """Projected gradient over ``rows`` until all domains are within ``tolerance`` of their targets, or ``max_steps``.

    ``shares``: target share of each domain.  ``budget``: expected tokens in
    all; by default the least for which no domain has to lose any.  A
    domain that no document may belong to can't be filled: then the nearest totals are
    reached.
    """
    k = len(shares)
    shares = np.asarray(shares, float) / np.sum(shares)
    sums = [F.sum(tokens * p[i]) for i in range(k)] + [F.sum(tokens * p[i] * p[j]) for i in range(k) for j in range(k)]
    got = np.array([x or 0.0 for x in rows.agg(*sums).first()], float)
    now, gram = got[:k], got[k:].reshape(k, k)
    if not now.sum():
        return Rates(np.zeros((0, k)), np.zeros(k), now)
    if budget is None:
        budget = max(a / s for a, s in zip(now, shares) if s > 0)
    target = budget * shares
    weight = 1 / np.maximum(target, 1e-6 * budget)
    root = np.sqrt(weight)
    step = 1 / np.linalg.eigvalsh(root[:, None] * gram * root[None, :]).max()
    found = Rates(np.zeros((0, k)), target, now)
    for _ in range(max_steps):
        if np.all(np.abs(found.reached - target) <= tolerance * np.maximum(target, 1e-6 * budget)):
            break
        steps = np.vstack([found.steps, step * weight * (found.reached - target)])
        found = Rates(steps, target, found.reached)
        r = found.rate(p)
        found.reached = np.array([x or 0.0 for x in rows.select(tokens.alias("n"), p.alias("p"), r.alias("r")).agg(*[F.sum(F.col("n") * F.col("r") * F.col("p")[i]) for i in range(k)]).first()], float)
    return found


def domain_of(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labelled table's domains: one for each pair of quality and toxic (a null in either: no domain)."""
    return labels.select(F.col(id_col).alias("doc_id"), F.concat(F.lit("q"), F.col("quality"), F.lit("t"), F.col("toxic")).alias("domain"))


def document_rates(
    docs: DataFrame, labelled: DataFrame, shares: dict[str, float], id_col: str = "doc_id", text_col: str = "text", budget: float | None = None, **fitting
) -> DataFrame:
    """One row for each document: doc_id, tokens (words), p (posterior by domain, in order of name), rate.

    Null and empty texts have no tokens and the posterior of the constant
    features; domains without a share get share 0; ties and repeated rows
    have equal rates; other columns are not read.  Without labelled documents every rate is 1 and p empty.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    try:
        model = fit(docs, labelled, id_col, text_col, **fitting)
    except ValueError:
        return rows.select("doc_id", F.lit(None).cast("bigint").alias("tokens"), F.array().cast("array<double>").alias("p"), F.lit(1.0).alias("rate"))
    known = common.written(rows.select("doc_id", scored(F.col("text"), model, docs.sparkSession).alias("s")), "posteriors").select("doc_id", "s.tokens", "s.p")
    rates = fit_rates(known, [shares.get(x, 0.0) for x in model.names], F.col("tokens"), F.col("p"), budget)
    return known.select("doc_id", "tokens", "p", rates.rate(F.col("p")).alias("rate"))


def mixed(
    docs: DataFrame, labelled: DataFrame, shares: dict[str, float], id_col: str = "doc_id", text_col: str = "text", budget: float | None = None, **fitting
) -> DataFrame:
    """The rows of ``docs``, each as many times as its rate says: the whole part, and once more with the chance of the rest.

    The chance is a hash of id and text, so a retry repeats it.  See :func:`document_rates` for the cases.
    """
    try:
        model = fit(docs, labelled, id_col, text_col, **fitting)
    except ValueError:
        return docs
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), scored(F.col(text_col), model, docs.sparkSession).alias("s"))
    judged = common.written(judged, "scored")
    rates = fit_rates(judged, [shares.get(x, 0.0) for x in model.names], F.col("s.tokens"), F.col("s.p"), budget)
    chance = common.share_below(9, F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`"))
    times = F.floor(rates.rate(F.col("s.p")) + chance).cast("int")
    again = judged.select("row", times.alias("times")).where("times > 0")
    return again.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
