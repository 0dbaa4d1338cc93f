"""Toxicity: a support vector machine with a subsequence string kernel over Nyström landmarks.

*Kernel.*  Two windows of one to three words are compared by the letter
triples that both hold in order, not only side by side: a triple within
``SPAN`` characters counts ``DECAY`` for each character that it stretches
over, so inserted and left out characters lower a match but do not undo it.
Triples lie within a word or cross one blank, so phrases are seen.  The
vectors that are learned from have length 1; one that is scored is divided
by the root of its triples' squared weights, each occurrence for itself
(the same but for triples that a window holds twice).

*Learning.*  The samples are the sentences of labelled texts, each by its
most toxic window.  A text's label holds for one of its sentences only, so
rounds alternate: a toxic text gives its most toxic sentence under the
machine so far, a clean text its most toxic ones and another; then the
machine (squared hinge on the Nyström features) is fitted anew.  The first
round starts from words and windows that are met in toxic texts more than
chance would give, with copies that have a letter put in; where there are
none, from sentences of all texts.

*Scoring.*  Nyström features are linear in the triples, so the machine is a
weight for each triple.  A window's decision is the sum over its triples,
scaled; single letters that stand apart are read as one word; a sentence has
its greatest decision, a text that of its sentences, mapped to (0, 1).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

DECAY = 0.8
SPAN = 5
#: Words of a window at most.
WORDS = 3
LETTERS = 64  # classes of characters: 0 for all that are no letters of the alphabet learned
TRIPLES = LETTERS**3
_PAIRS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


@dataclass
class Alphabet:
    """Class of each code point below 2**16 (higher ones: 0)."""

    table: np.ndarray

    @classmethod
    def of(cls, counts: dict[str, int]) -> Alphabet:
        table = np.zeros(1 << 16, np.int32)
        usual = sorted((c for c in counts if ord(c) < 1 << 16), key=lambda c: (-counts[c], c))
        for i, c in enumerate(usual[: LETTERS - 1]):
            table[ord(c)] = i + 1
        return cls(table)


class Units:
    """The words of some texts as classes of characters, with triples that lie within one word."""

    def __init__(self, texts: list[str], alphabet: Alphabet):
        lowered = [t.lower() for t in texts]
        ends = np.cumsum([len(t) + 1 for t in lowered])
        codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 160)
        solid = ~blank
        alone = solid.copy()  # a character with blanks on both sides
        alone[1:] &= blank[:-1]
        alone[:-1] &= blank[1:]
        bridge = np.zeros(len(codes), bool)  # a single blank between two such characters of one text
        if len(codes) > 2:
            bridge[1:-1] = (codes[1:-1] == 32) & alone[:-2] & alone[2:]
        inside = solid | bridge
        self.chars = np.where(codes < 1 << 16, alphabet.table[np.minimum(codes, (1 << 16) - 1)], 0).astype(np.int32)
        self.first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        self.last = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
        self.doc = np.searchsorted(ends, self.first, side="right")
        self.inside = inside

        # a word that is followed by the next one of its text after a single blank
        self.joined = np.zeros(len(self.first), bool)
        if len(self.first) > 1:
            gap = self.first[1:] - self.last[:-1] == 1
            self.joined[:-1] = gap & (self.doc[1:] == self.doc[:-1])

    def triples(self) -> Iterator[tuple[np.ndarray, np.ndarray, float, bool]]:
        """(place of the first character, triple, weight, whether it crosses a blank) for each shape of triple."""
        word = np.cumsum(self.inside & ~np.concatenate([[False], self.inside[:-1]]), dtype=np.int32)
        letter = self.inside & (self.chars > 0)
        on_at = np.concatenate([[False], self.joined])[word]  # words are numbered from 1
        n = len(word)
        for j, k in _PAIRS:
            if n <= k:
                continue
            three = letter[: n - k] & letter[k:] & letter[j : n - k + j]
            ends = word[k:] - word[: n - k]
            for cross in (False, True):
                own = np.flatnonzero(three & (ends == 1) & on_at[: n - k]) if cross else np.flatnonzero(three & (ends == 0))
                yield own, (self.chars[own] * LETTERS + self.chars[own + j]) * LETTERS + self.chars[own + k], DECAY ** (k + 1), cross


def vectors(windows: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, triple, value) entries of the vectors of windows (words with single blanks between them)."""
    u = Units([" ".join(w.split()) or "?" for w in windows], alphabet)
    row, col, val = [], [], []
    for at, triple, weight, _ in u.triples():
        row.append(u.doc[np.searchsorted(u.first, at, side="right") - 1])
        col.append(triple)
        val.append(np.full(len(at), weight))
    row, col, val = (np.concatenate(x) if x else np.zeros(0, int) for x in (row, col, val))
    key, back = np.unique(row * TRIPLES + col, return_inverse=True)
    val = np.bincount(back, val) if len(key) else np.zeros(0)
    row, col = key // TRIPLES, key % TRIPLES
    size = np.sqrt(np.bincount(row, val**2, minlength=len(windows)))
    return row, col, val / np.maximum(size[row], 1e-6)


@dataclass
class Machine:
    alphabet: Alphabet
    weight: np.ndarray  # of each triple
    bias: float
    slope: float = 4.0
    shift: float = 0.0

    def windows(self, texts: list[str]) -> tuple[Units, list[np.ndarray]]:
        """The words of the texts and, for windows of 1, 2, ... words, the decision of the one that begins at each word (-inf: none)."""
        u = Units(texts, self.alphabet)
        n = len(u.first)
        if not n:
            return u, []
        edges = np.stack([u.first, u.last], 1).ravel()
        # sums by first character: triples within a word, then those across a blank
        size = len(u.chars) + 1
        total, square = np.zeros(2 * size, np.float32), np.zeros(2 * size, np.float32)
        for at, triple, weight, crosses in u.triples():
            at = at + size if crosses else at
            total[at] += np.float32(weight) * self.weight[triple]
            square[at] += np.float32(weight * weight)
        sums = [np.add.reduceat(x[a : a + size], edges, dtype=np.float64)[::2] for a in (0, size) for x in (total, square)]
        s, q, s_on, q_on = sums
        whole, norm, ok = s.copy(), q.copy(), np.ones(n, bool)
        out = [whole / np.maximum(np.sqrt(norm), 1e-6) + self.bias]
        for k in range(1, WORDS):
            if n <= k:
                break
            ok[-k:] = False
            ok[: n - k] &= u.joined[k - 1 : n - 1]
            whole[: n - k] += s_on[k - 1 : n - 1] + s[k:]
            norm[: n - k] += q_on[k - 1 : n - 1] + q[k:]
            out.append(np.where(ok, whole / np.maximum(np.sqrt(norm), 1e-6) + self.bias, -np.inf))
        return u, out

    def decisions(self, texts: list[str]) -> np.ndarray:
        """The greatest decision among the windows of each text, cut at the margin (without words: that of an empty vector)."""
        u, found = self.windows(texts)
        out = np.full(len(texts), self.bias)
        for d in found:
            np.maximum.at(out, u.doc, d)
        return np.minimum(out, 1.0)

    def strongest(self, texts: list[str], most: int) -> list[list[str]]:
        """The windows with the greatest decisions of each text, at most one for each sentence."""
        u, found = self.windows(texts)
        out: list[list[str]] = [[] for _ in texts]
        if not found:
            return out
        best = np.max(found, axis=0)
        size = np.argmax(found, axis=0)
        whole = "\n".join(t.lower() for t in texts) + "\n"
        edge = np.searchsorted(u.doc, np.arange(len(texts) + 1))
        for d, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
            seen: set[int] = set()
            for w in a + np.argsort(-best[a:b], kind="stable")[: 20 * most]:
                first, last = int(u.first[w]), int(u.last[w + size[w]])
                sentence = max(whole.rfind(c, int(u.first[a]), first) for c in ".!?\n")
                if sentence not in seen:
                    seen.add(sentence)
                    out[d].append(whole[first:last])
                    if len(out[d]) == most:
                        break
        return out

    def word_decisions(self, words: list[str]) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self.decisions(words[i : i + 20_000]) for i in range(0, len(words), 20_000))])

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.decisions(texts) + self.shift, -30, 30)))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic",
    max_docs: int = 4000, landmarks: int = 300, rounds: int = 3,
) -> Machine:
    """Learn from about ``max_docs`` labelled rows of each class (the bound of the sample; by a hash of the id), whole texts.

    Rows with a null text or label are left out.  Without rows of both classes: ValueError.
    """
    spark = docs.sparkSession
    own = labels.where(F.col(label_col).isNotNull()).select(F.col(label_id).alias("_label_id"), F.col(label_col).cast("int").alias("_toxic"))
    n = {r["_toxic"]: r["n"] for r in own.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        raise ValueError("no labelled rows of both classes")
    rate = {y: min(1.0, max_docs / n[y]) for y in (0, 1)}
    own = own.where(common.share_below(4, F.col("_label_id")) < F.when(F.col("_toxic") == 1, rate[1]).otherwise(rate[0]))
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    sample = rows.join(F.broadcast(own), F.col("_id") == F.col("_label_id")).select("_toxic", "_text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of a text's sentences, each once: a word with its first neighbours, several words with the text (both as one hash)."""
        for batch in batches:
            toxic, window, beside = [], [], []
            for y, text in zip(*(c.to_pylist() for c in batch.columns)):
                seen: dict[str, int] = {}
                own = zlib.crc32(text.encode("utf-8", "surrogatepass"))
                for sentence in re.split(r"[.!?\n]+", text.lower()):
                    w = re.findall(r"[^\W\d_]+", sentence)
                    for a, b, c in zip(w, ["", *w], [*w[1:], ""]):
                        seen.setdefault(a, zlib.crc32(f"{b} {c}".encode()))
                    for k in range(2, WORDS + 1):
                        for i in range(len(w) - k + 1):
                            seen[" ".join(w[i : i + k])] = own
                toxic += [y] * len(seen)
                window += seen
                beside += seen.values()
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(window, pa.string()), pa.array(beside, pa.int64())], names=["toxic", "word", "beside"])

    met = sample.mapInArrow(words, "toxic int, word string, beside bigint").where("length(word) > 2")
    met = met.groupBy("word", "beside").agg(F.min("toxic").alias("toxic"))
    counts = met.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    prior = rate[1] * n[1] / (rate[0] * n[0] + rate[1] * n[1])
    # of words all, of windows those met in toxic texts more than chance gives: from a bounded sample
    got = counts.where(~F.col("word").contains(" ") | ((F.col("bad") >= 3) & (F.col("good") <= F.col("bad") * (0.5 * (1 - prior) / prior)))).orderBy("word").toArrow()
    word, bad, good = got["word"].to_pylist(), *(np.asarray(got[c]).astype(np.int64) for c in ("bad", "good"))
    proposed, clean = proposals(word, bad, good, prior)

    def mined(machine: Machine | None, round_: int) -> tuple[list[str], list[str]]:
        """Windows of toxic and of clean texts: the strongest of the strongest sentences (without a machine: any), and of clean texts another."""
        shared = spark.sparkContext.broadcast(machine)

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                y, texts = (c.to_pylist() for c in batch.columns)
                found = []
                for i, j in common.by_size([len(t) for t in texts]):
                    part = texts[i:j]
                    top = shared.value.strongest(part, 4) if shared.value else [[] for _ in part]
                    for toxic, text, own in zip(y[i:j], part, top):
                        w, h = text.lower().split(), zlib.crc32(f"{round_}{text}".encode("utf-8", "surrogatepass"))
                        any_ = [" ".join(w[(h // (p + 1)) % len(w) :][: 1 + (h + p) % WORDS]) for p in range(3)] if w else []
                        found += [(toxic, x) for x in (own[:1] if toxic and own else any_ if not own else own + any_[:1])]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.int32()), pa.array([x for _, x in found], pa.string())], names=["toxic", "window"])

        rows = sample.mapInArrow(pick, "toxic int, window string").orderBy("toxic", "window").toArrow()  # a few windows of each text of the sample
        found = list(zip(rows["toxic"].to_pylist(), rows["window"].to_pylist()))
        return [x for t, x in found if t], [x for t, x in found if not t]

    if proposed:
        machine = learn(proposed, clean, landmarks)
    else:
        toxic, other = mined(None, 0)
        if not toxic or not other:
            raise ValueError("no words of both classes")
        machine = _machine(toxic, other, landmarks)
    for round_ in range(1, rounds + 1):
        toxic, other = mined(machine, round_)
        hard = [clean[i] for i in np.argsort(-machine.word_decisions(clean), kind="stable")[: max(1, len(other) // 2)]] if clean else []
        machine = _machine(toxic + proposed + disguised(proposed), other + hard, landmarks)

    # the map from decisions to scores, on the same sample
    shared = spark.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def decide(texts: pa.Array) -> pa.Array:
        own = texts.to_pylist()
        return pa.array(np.concatenate([np.zeros(0), *(shared.value.decisions(own[i:j]) for i, j in common.by_size([len(t) for t in own]))]))

    found = sample.select("_toxic", decide("_text").alias("d")).toArrow()  # two numbers for each row of the bounded sample
    machine.slope, machine.shift = _sigmoid(np.asarray(found["d"]), np.asarray(found["_toxic"]))
    return machine


def disguised(words: list[str], times: int = 2) -> list[str]:
    """Each longer word with a letter put in, at places and with letters that follow from a hash, and each word with its letters apart."""
    out = [" ".join(w) for w in words if len(w) > 3 and " " not in w]
    for w in words:
        for i in range(times if len(w) > 4 else 0):
            h = zlib.crc32(f"{i}{w}".encode())
            at = 1 + h % (len(w) - 1)
            out.append(w[:at] + chr(97 + h // 64 % 26) + w[at:])
    return out


def proposals(word: list[str], bad: np.ndarray, good: np.ndarray, prior: float, most: int = 400) -> tuple[list[str], list[str]]:
    """(words and windows to start from, clean words) from the numbers of contexts in toxic and in clean texts.

    A start is met in toxic texts so much more than their share that chance
    would give less than one such word in ten such lists (a normal bound),
    and in most of its contexts; the strongest come first.
    """
    met = bad + good
    excess = (bad - met * prior) / np.sqrt(np.maximum(met * prior * (1 - prior), 1e-9))
    least = 2
    while least < 60 and (met >= least).sum() * prior**least >= 0.1:
        least += 1
    sure = (bad >= least) & (excess > np.sqrt(2 * np.log(10 * max(2, len(word))))) & (bad * (1 - prior) > 2 * good * prior)
    order = sorted(np.flatnonzero(sure), key=lambda i: (-excess[i], word[i]))[:most]
    rest = sorted((-int(g), w) for w, g, y in zip(word, good, sure) if not y and " " not in w)
    return [word[i] for i in order], [w for _, w in rest]


def learn(proposed: list[str], clean: list[str], landmarks: int = 300, most: int = 12_000) -> Machine:
    """The first machine, between the proposals and clean words: the commonest, an even share, and in a second round those that the first finds toxic."""
    if not clean:
        raise ValueError("no words of both classes")
    toxic = proposed + disguised(proposed)
    part = clean[: most // 3] + clean[most // 3 :: max(1, 3 * len(clean) // most)]
    machine = _machine(toxic, list(dict.fromkeys(part)), landmarks)
    hard = np.argsort(-machine.word_decisions(clean), kind="stable")[: most // 3]
    return _machine(toxic, list(dict.fromkeys(part + [clean[i] for i in hard])), landmarks)


def _machine(bad: list[str], good: list[str], landmarks: int, steps: int = 200) -> Machine:
    """The support vector machine between two lists of windows."""
    counts: dict[str, int] = {}
    for w in bad + good:
        for c in w.replace(" ", ""):
            counts[c] = counts.get(c, 0) + 1
    alphabet = Alphabet.of(counts)
    own = bad + good
    y = np.array([1.0] * len(bad) + [-1.0] * len(good))
    pick = [words[i] for words, k in ((bad, landmarks // 2), (good, landmarks // 2)) for i in np.unique(np.linspace(0, len(words) - 1, min(len(words), k)).astype(int))]
    r, c, v = vectors(pick, alphabet)
    kept, c = np.unique(c, return_inverse=True)
    used = np.zeros((len(pick), len(kept)))
    used[r, c] = v
    value, basis = np.linalg.eigh(used @ used.T)
    root = basis / np.sqrt(np.maximum(value, 1e-4)) @ basis.T  # the inverse root of the landmarks' kernel
    to_feature = used.T @ root  # triples x features
    column = np.full(TRIPLES, -1)
    column[kept] = np.arange(len(kept))
    z = np.ones((len(own), len(pick) + 1))
    for a in range(0, len(own), 2000):
        r, c, v = vectors(own[a : a + 2000], alphabet)
        some = column[c] >= 0
        x = np.zeros((min(2000, len(own) - a), len(kept)), np.float32)
        x[r[some], column[c[some]]] = v[some]
        z[a : a + 2000, :-1] = x @ to_feature
    cost = np.where(y > 0, 1 / (2 * len(bad)), 1 / (2 * len(good)))
    w = np.zeros(z.shape[1])
    for _ in range(steps):  # Newton's method on the squared hinge, over the rows inside the margin
        near = y * (z @ w) < 1
        a = z[near]
        hess = a.T @ (a * cost[near, None]) + 1e-4 * np.eye(len(w))
        new = np.linalg.solve(hess, a.T @ (cost[near] * y[near]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    weight = np.zeros(TRIPLES)
    weight[kept] = to_feature @ w[:-1]
    return Machine(alphabet, weight.astype(np.float32), float(w[-1]))


def _sigmoid(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic map from decisions to the label, both classes weighing alike (Newton's method, halved steps)."""
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    x, near = np.stack([d, np.ones(len(d))], 1), np.array([6.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(cost * (np.logaddexp(0, z) - y * z)) + 5e-4 * np.sum((w - near) ** 2))

    w = near
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = x.T @ (x * (cost * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (cost * (p - y)) + 1e-3 * (w - near))
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return float(max(w[0], 1.0)), float(w[1])


def score(text: Column, machine: Machine, spark) -> Column:
    """Score (0 to 1) of a text column; null and empty texts have a score too."""
    shared = spark.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            texts = [t or "" for t in part.to_pylist()]
            yield pa.array(np.concatenate([np.zeros(0), *(shared.value.scores(texts[i:j]) for i, j in common.by_size([len(t) for t in texts]))]))

    return of(text)


def scored(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out_of: int = 3,
    held_out_at: int = 1, limit: float = 0.7, **fitting,
) -> DataFrame:
    """Learn from labelled rows that aren't held out and score all: doc_id, held_out, score, predicted.

    A row is held out if crc32(id as text) modulo ``held_out_of`` is
    ``held_out_at``.  Null, empty and wordless texts get the score of an
    empty word; repeated rows are scored alike; texts of any length are
    scored whole; an empty table has no rows; other columns are not read;
    without labelled texts with words of both classes every score is 0.
    """
    held = common.id_remainder(F.col(id_col), held_out_of) == held_out_at
    try:
        machine = fit(docs.where(~held), labels.where(common.id_remainder(F.col("doc_id"), held_out_of) != held_out_at), id_col, text_col, label_col=label_col, **fitting)
        value = score(F.col(text_col), machine, docs.sparkSession)
    except ValueError:
        value = F.lit(0.0)
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), value.alias("score"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= limit).cast("int").alias("predicted"))
