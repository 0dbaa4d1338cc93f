"""Language identification of mixed text: scripts narrow the languages, Viterbi labels spans of words.

*Learning.*  Labelled rows give counts of character trigrams per language
(word ends count as a character), added up by Spark in hashed bins.  At most
about ``max_docs`` rows of each language are used, chosen by a hash of the id.

*Words.*  A word is a run of letters and marks.  A language is a candidate
for a word only if it is written in the word's script (Unicode ranges).  A
word's score for a language is the sum of its trigrams' log probabilities,
less that of the best candidate, and not below ``floor``.

*Spans.*  Viterbi over the words of a text, with a penalty for each switch
of language, labels spans.  The language with most letters is the text's;
the share of the letters in its spans is the score.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BINS = 1 << 16
UNKNOWN = "und"
MARK = 255

# First and last code point of Unicode script ranges.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF),
    ("arabic", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("han", 0x20000, 0x3FFFF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


def character_classes() -> np.ndarray:
    """For each code point: 0 no letter, 255 a mark, else 1 + the index of its script."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(len(out)):
        kind = unicodedata.category(chr(i))[0]
        out[i] = MARK if kind == "M" else kind == "L"
    for name, first, last in SCRIPTS:
        part = out[first : last + 1]
        part[part == 1] = 1 + SCRIPT_NAMES.index(name)
    return out


@dataclass
class Words:
    """The words of some texts: trigram bin of every character, and per word its first character, size, script and text."""

    bins: np.ndarray
    first: np.ndarray
    size: np.ndarray
    script: np.ndarray
    doc: np.ndarray
    has_letter: np.ndarray


def words_of(texts: list[str], classes: np.ndarray) -> Words:
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    kind = classes[codes]
    word = kind > 0
    letters = np.where(word, codes, 0).astype(np.uint32)
    before = np.concatenate([[0], letters[:-1]]).astype(np.uint32)
    after = np.concatenate([letters[1:], [0]]).astype(np.uint32)
    at = np.flatnonzero(word)
    mixed = (before * np.uint32(2654435761) ^ letters * np.uint32(2246822519) ^ after * np.uint32(3266489917))[at]
    bins = ((mixed * np.uint32(668265263)) >> np.uint32(16)).astype(np.int32)
    start = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    first = np.searchsorted(at, start)
    size = np.diff(np.append(first, len(at)))
    doc = np.searchsorted(ends, start, side="right")
    own = kind[at]
    script = np.maximum.reduceat(np.where(own == MARK, 0, own), first) - 1 if len(first) else np.zeros(0, np.int64)
    script = np.where(script > 250, 0, script).astype(np.int64)
    seen = np.zeros(len(texts), bool)
    seen[np.unique(np.searchsorted(ends, np.flatnonzero(word & (kind != MARK)), side="right"))] = True
    return Words(bins, first, size, script, doc, seen)


@dataclass
class Model:
    """Log probabilities per trigram bin and language, and which scripts each language is written in."""

    langs: list[str]
    log_p: np.ndarray  # BINS x languages
    scripts: np.ndarray  # scripts x languages, bool
    classes: np.ndarray
    switch: float = 8.0
    floor: float = -6.0

    def word_scores(self, w: Words) -> np.ndarray:
        if not len(w.first):
            return np.zeros((0, len(self.langs)), np.float32)
        total = np.add.reduceat(self.log_p[w.bins], w.first, axis=0)
        fits = self.scripts[w.script]
        fits = fits | ~fits.any(axis=1, keepdims=True)  # a script that no language uses says nothing
        total = np.where(fits, total, -np.inf)
        return np.maximum(total - total.max(axis=1, keepdims=True), self.floor).astype(np.float32)

    def label(self, w: Words, n_docs: int) -> np.ndarray:
        """Viterbi over the words of all texts at once, the longest texts first."""
        score = self.word_scores(w)
        n = np.bincount(w.doc, minlength=n_docs)
        start = np.cumsum(n) - n
        order = np.argsort(-n, kind="stable")
        n, start = n[order], start[order]
        open_at = np.searchsorted(-n, -np.arange(n[0] if len(n) else 0), side="left")  # texts with more than t words
        best = np.zeros(len(score), np.int32)
        stay = np.ones(score.shape, bool)
        value = np.zeros((n_docs, score.shape[1]), np.float32)
        last = np.zeros(n_docs, np.int64)
        for t, k in enumerate(open_at):
            at = start[:k] + t
            now = value[:k]
            if t:
                lead = now.argmax(axis=1)
                moved = now[np.arange(k), lead][:, None] - self.switch
                kept = now >= moved
                best[at], stay[at] = lead, kept
                now = np.where(kept, now, moved)
            value[:k] = now + score[at]
        last = value.argmax(axis=1)
        out = np.zeros(len(score), np.int32)
        for t in range(len(open_at) - 1, -1, -1):
            k = open_at[t]
            at = start[:k] + t
            own = last[:k]
            out[at] = own
            last[:k] = np.where(stay[at, own], own, best[at])
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int, int]]]:
        """For each text its spans (language, first word, words, letters)."""
        w = words_of(texts, self.classes)
        label = self.label(w, len(texts))
        out: list[list] = [[] for _ in texts]
        new = np.flatnonzero((np.diff(w.doc, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
        doc_first = np.searchsorted(w.doc, np.arange(len(texts)))
        letters = np.add.reduceat(w.size, new) if len(new) else []
        for i, j, k in zip(new, np.append(new[1:], len(label)), letters):
            out[w.doc[i]].append((self.langs[label[i]], int(i - doc_first[w.doc[i]]), int(j - i), int(k)))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        w = words_of(texts, self.classes)
        label = self.label(w, len(texts))
        share = np.zeros((len(texts), len(self.langs)))
        np.add.at(share, (w.doc, label), w.size)
        total = share.sum(axis=1)
        lead = share.argmax(axis=1)
        score = np.where(w.has_letter, share[np.arange(len(texts)), lead] / np.maximum(total, 1), 0.0)
        return [self.langs[i] if ok else UNKNOWN for i, ok in zip(lead, w.has_letter)], score


def fit(
    rows: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    max_docs: int = 1500, switch: float = 8.0, min_script: float = 0.01,
) -> Model:
    """Learn from labelled rows (null texts or labels are left out).

    About ``max_docs`` rows of each language are used, whole: the bound of
    the labelled sample.  No labelled row at all is a ValueError.
    """
    spark = rows.sparkSession
    labelled = rows.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), common.share_below(1, F.col(id_col)).alias("u")
    )
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        raise ValueError("no labelled rows")
    langs = sorted(counts)
    rate = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, max_docs / counts[lang]))])
    sample = labelled.where(F.col("u") < rate[F.col("lang")]).select("lang", "text")
    classes = spark.sparkContext.broadcast(character_classes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Trigram and script counts of a partition, added up before the shuffle."""
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            lang, text = (c.to_pylist() for c in batch.columns)
            for one in set(lang):
                own = [t for t, x in zip(text, lang) if x == one]
                into = found.setdefault(one, np.zeros(BINS + len(SCRIPT_NAMES), np.int64))
                for i, j in common.by_size([len(t) for t in own]):
                    w = words_of(own[i:j], classes.value)
                    into[:BINS] += np.bincount(w.bins, minlength=BINS)
                    into[BINS:] += np.bincount(w.script, w.size, minlength=len(SCRIPT_NAMES)).astype(np.int64)
        for one, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([one] * len(at)), pa.array(at), pa.array(n[at])], names=["lang", "bin", "n"])

    seen = np.zeros((BINS + len(SCRIPT_NAMES), len(langs)))
    # at most bins x languages rows
    for r in sample.mapInArrow(count, "lang string, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")).collect():
        seen[r["bin"], langs.index(r["lang"])] = r["n"]
    grams, scripts = seen[:BINS] + 0.1, seen[BINS:]
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    log_p = np.log(grams / grams.sum(axis=0)).astype(np.float32)
    return Model(langs, log_p, share >= min_script, classes.value, switch)


def predict(model: Model, text: Column, spark) -> Column:
    """Column of struct(lang_pred string, score double) for a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            texts = [t or "" for t in part.to_pylist()]
            lang, score = [], []
            for i, j in common.by_size([len(t) for t in texts]):
                a, b = shared.value.predict(texts[i:j])
                lang += a
                score += b.tolist()
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    return of(text)


def language_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and its spans (lang, first_word, words, letters), in text order.

    Null and empty texts, and texts without a letter, have no spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<struct<lang: string, first_word: int, words: int, letters: int>>")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32()), ("letters", pa.int32())]))
        for part in parts:
            texts, out = [t or "" for t in part.to_pylist()], []
            for i, j in common.by_size([len(t) for t in texts]):
                out += [[dict(zip(("lang", "first_word", "words", "letters"), s)) for s in spans] for spans in shared.value.spans(texts[i:j])]
            yield pa.array(out, kind)

    return docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("spans"))


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out_of: int = 5, **fitting
) -> DataFrame:
    """Learn from the rows that are not held out and predict all: doc_id, held_out, lang_pred, score.

    A row is held out if crc32(id as text) is divisible by ``held_out_of``.
    Null, empty and letterless texts are ``und`` with score 0; equal scores
    go to the first language in order; repeated rows are judged alike; texts
    of any length and any number of languages are judged whole; an empty
    table gives no rows; other columns are not read.  A table without any labelled row predicts ``und`` with score 0.
    """
    held = common.id_remainder(F.col(id_col), held_out_of) == 0
    try:
        model = fit(docs.where(~held), text_col, lang_col, id_col, **fitting)
    except ValueError:
        return docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), predict(model, F.col(text_col), docs.sparkSession).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, least_share: float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fitting) -> DataFrame:
    """The rows, with all their columns, whose text has a language with at least ``least_share`` of the letters.

    The model is learned from all labelled rows of ``docs`` (a sample, see
    :func:`fit`).  Texts that are null, empty or without letters are dropped;
    with no labelled row at all every text counts as unknown.
    """
    spark = docs.sparkSession
    try:
        model = fit(docs, text_col, lang_col, id_col, **fitting)
    except ValueError:
        return docs.limit(0)
    found = predict(model, F.col(text_col), spark)
    judged = docs.select(F.struct("*").alias("row"), found.alias("p"))
    return judged.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= least_share)).select("row.*")
