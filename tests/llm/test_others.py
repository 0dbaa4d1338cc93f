"""op2, op4, op5, op6, op7, op8 against brute force or held-out labels, with their edge cases."""

import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weekcast.llm import common, licenses, mixing, passages, queries, topk, toxicity, url_filter, wordhash
from weekcast.llm.bm25 import idf

from given import SF_CHECK, SF_LARGE


def sentence(rnd, n, stem="w"):
    return " ".join(f"{stem}{rnd.randrange(5000)}" for _ in range(n))


# ---------------------------------------------------------------- op2


def test_passages_exact_fuzzy_and_short(spark, docs):
    rnd = random.Random(4)
    shared, short = sentence(rnd, 80).split(), sentence(rnd, 30)
    fuzzy = list(shared)
    for i in (20, 41, 62):
        fuzzy[i] = "changed"
    del fuzzy[50]
    rows = [(i, sentence(rnd, 60) + " " + " ".join(p) + " " + sentence(rnd, 45)) for i, p in ((1, shared), (2, shared), (3, fuzzy))]
    rows += [(4, sentence(rnd, 90) + " " + short), (5, short + " " + sentence(rnd, 90)), (6, sentence(rnd, 120)), (7, rows[0][1]), (8, None), (9, ""), (None, rows[0][1])]
    out = passages.repeated(docs(rows)).collect()
    links = {(r.doc_id, r.other_id) for r in out}
    assert {(2, 1), (3, 1), (7, 1)} <= links and {x for p in links for x in p} == {1, 2, 3, 7}
    exact = next(r for r in out if (r.doc_id, r.other_id) == (2, 1))
    assert (exact.first_word, exact.words, exact.other_first, exact.similarity) == (60, 80, 60, 1.0)
    assert all(r.similarity >= 0.8 and r.words >= 50 for r in out)
    assert passages.repeated(docs([])).count() == 0


def test_every_exact_repeat_of_fifty_words_is_found(spark):
    found = queries.op2_passages(spark, SF_CHECK).select("doc_id", "other_id").collect()
    got = {x for r in found for x in r}
    where = {}
    for r in common.table(spark, SF_CHECK, "documents").select("doc_id", "text").collect():
        h = wordhash.hashed([r.text or ""])[0]
        for x in np.unique(wordhash.shingles(h, 50)) if len(h) >= 50 else ():
            where.setdefault(int(x), set()).add(r.doc_id)
    assert {x for s in where.values() if len(s) > 1 for x in s} <= got


def test_chain_takes_the_best_collinear_run():
    x, y = np.array([0, 8, 16, 24, 30, 5]), np.array([100, 108, 117, 125, 3, 900])
    best = max(passages.chains(x, y), key=lambda c: c[4])
    assert best == (0, 24 + passages.K, 100, 125 + passages.K, 4)
    far = np.array([0, 8, 16, 100, 108])
    assert sorted(passages.chains(far, far, max_gap=40)) == [(0, 16 + passages.K, 0, 16 + passages.K, 3), (100, 108 + passages.K, 100, 108 + passages.K, 2)]
    rnd = random.Random(1)
    for _ in range(60):
        n = rnd.randint(1, 12)
        x, y = (np.array([rnd.randrange(60) for _ in range(n)]) for _ in range(2))
        assert sum(c[4] for c in passages.chains(x, y)) == n  # each match is in one chain
        best = _best_chain(x, y)
        assert max(_value(x, y, c) for c in passages.chains(x, y)) == pytest.approx(best)


def _best_chain(x, y):
    order = sorted(range(len(x)), key=lambda i: (x[i], y[i]))
    f = {}
    for i in order:
        f[i] = passages.K + max([0.0, *(f[j] - passages.GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in f if x[j] < x[i] and y[j] < y[i])])
    return max(f.values())


def _value(x, y, chain):
    a, b, c, d, n = chain
    return n * passages.K - passages.GAP_COST * (b - passages.K - a + d - passages.K - c)


def test_passages_between_own_words_and_with_changed_ends(spark, docs):
    rnd = random.Random(14)
    own = iter(range(10**6))
    fresh = lambda n: [f"own{next(own)}" for _ in range(n)]
    p, s, t, u = (sentence(rnd, n, "p").split() for n in (50, 15, 15, 54))
    rows = [(i, " ".join(fresh(30) + p + fresh(20) + s + fresh(20) + t + fresh(30))) for i in (1, 2)]
    rows.append((3, " ".join(fresh(70) + u + fresh(70))))
    u[2], u[-3] = "changed", "altered"
    rows.append((4, " ".join(fresh(60) + u + fresh(70))))
    got = sorted(tuple(r) for r in passages.repeated(docs(rows)).collect())
    assert got == [(2, 30, 50, 1, 30, 50, 50, 1.0), (4, 60, 54, 3, 70, 54, 52, 52 / 54)]


def test_seeds_reach_passages_of_four_fifths(spark, docs):
    rnd, rows = random.Random(16), []
    for i in range(40):
        p = sentence(rnd, 60, f"s{i}x").split()
        rows.append((2 * i, sentence(rnd, 60, f"a{i}x") + " " + " ".join(p) + " " + sentence(rnd, 60, f"b{i}x")))
        for at in rnd.sample(range(1, 59), 11):
            p[at] = "changed"
        rows.append((2 * i + 1, sentence(rnd, 60, f"c{i}x") + " " + " ".join(p) + " " + sentence(rnd, 60, f"d{i}x")))
    got = {(r.doc_id, r.other_id) for r in passages.repeated(docs(rows)).collect()}
    assert got == {(2 * i + 1, 2 * i) for i in range(40)}


def test_bit_table_alignment_and_sift_against_plain_ones():
    rnd, seen = random.Random(21), np.zeros(1 << 16, bool)
    for _ in range(400):
        v = rnd.choice([3, 20, 400])
        a = np.array([rnd.randrange(v) for _ in range(rnd.randint(0, 70))], np.int64)
        b = np.array([x if rnd.random() < 0.8 else rnd.randrange(v) for x in a[rnd.randint(0, 4) :]] + [rnd.randrange(v) for _ in range(rnd.randint(0, 8))], np.int64)
        if len(a) and len(b) and not (len(a) == len(b) and (a == b).all()):
            assert passages.equal_runs(a, b) == passages._banded_runs(a, b, 1000)
        for least in (1, 8, 50):
            short = [x.astype(np.uint16) for x in (a, b)]
            assert passages.hopeful(*short, seen, least, 0.8) >= passages.may_hold(a, b, least, 0.8) and not seen.any()


def test_short_chains_of_the_same_words_are_gathered(spark, docs):
    spans = [(4 + i, 9 + i, 124, 129) for i in range(20)] + [(0, 200, 0, 200), (300, 305, 300, 305)]
    assert sorted(passages.gathered(spans, 25)) == [(0, 200, 0, 200), (4, 28, 124, 129), (300, 305, 300, 305)]
    rnd = random.Random(22)
    p = sentence(rnd, 60)
    rows = [(1, "na " * 300 + p), (2, sentence(rnd, 30) + " " + p + " na" * 200)]
    got = {(r.doc_id, r.other_id, r.first_word, r.words) for r in passages.repeated(docs(rows)).collect()}
    assert (2, 1, 30, 60) in got and any(first >= 90 for _, _, first, _ in got)


def test_pairs_left_out_lie_between_pairs_looked_at():
    rnd, left_out, every = random.Random(23), 0, 0
    for _ in range(60):
        line = [(rnd.randrange(9), rnd.randint(1, 6)) for _ in range(rnd.randint(2, 8))]
        texts = []
        for _ in range(2):
            rows = [x if rnd.random() < 0.97 else (rnd.randrange(9), rnd.randint(1, 20)) for _ in range(rnd.randint(1, 12)) for x in line]
            texts.append((np.array([x for x, _ in rows]), np.cumsum([d for _, d in rows])))
        (a, p), (b, q) = texts
        (x, fixed), (y, _) = (passages.neighbours(*t) for t in texts)
        same = a[:, None] == b
        looked = same & (fixed[:, None] | (x[:, None] != y))
        at = {(int(p[i]), int(q[j])) for i, j in zip(*np.nonzero(looked))}
        reach = passages.CELL + passages.NEAR
        for i, j in zip(*np.nonzero(same & ~looked)):
            assert any((p[i] - d, q[j] - d) in at for d in range(1, reach + 1)) and any((p[i] + d, q[j] + d) in at for d in range(1, reach + 1))
        left_out, every = left_out + int((same & ~looked).sum()), every + int(same.sum())
    assert left_out > every / 4


def test_alignment_of_long_runs_looks_at_all_pairs_of_places(monkeypatch):
    words = np.arange(34_000, dtype=np.int64)
    shared, own, other = words[:10_000], words[10_000:22_000], words[22_000:]
    a, b = np.concatenate([own, shared]), np.concatenate([shared, other])  # more pairs than a table holds at once
    assert passages.equal_runs(a, b) == [(12_000, 0, 10_000)]
    rnd, held = random.Random(22), passages.TABLE_BITS
    for _ in range(200):
        a, b = (np.array([rnd.randrange(rnd.choice([3, 40])) for _ in range(rnd.randint(0, 50))], np.int64) for _ in range(2))
        monkeypatch.setattr(passages, "TABLE_BITS", held)
        whole = passages.equal_runs(a, b)
        for bits in (1, 30, 300):
            monkeypatch.setattr(passages, "TABLE_BITS", bits)
            assert passages.equal_runs(a, b) == whole


def test_sub_runs_of_an_alignment_against_brute_force():
    rnd = random.Random(15)
    for _ in range(200):
        a = np.array([rnd.randrange(6) for _ in range(rnd.randint(0, 25))])
        b = np.array([x if rnd.random() < 0.8 else rnd.randrange(6) for x in a[rnd.randint(0, 3) :]], int)
        runs = passages.equal_runs(a, b)
        assert sum(n for _, _, n in runs) == passages.aligned(a, b)
        assert all((a[x : x + n] == b[y : y + n]).all() for x, y, n in runs)
        assert all(x + n <= z and y + n <= w for (x, y, n), (z, w, _) in zip(runs, runs[1:]))
        at = [(x + i, y + i) for x, y, n in runs for i in range(n)]
        fits = [
            (2 * (e - s + 1) - max(at[e][0] - at[s][0], at[e][1] - at[s][1]) - 1)
            for s in range(len(at)) for e in range(s, len(at))
            if at[e][0] - at[s][0] + 1 >= 8 and e - s + 1 >= 0.8 * (max(at[e][0] - at[s][0], at[e][1] - at[s][1]) + 1)
        ]
        got = [2 * n - max(w, z) for _, w, _, z, n in passages.sub_runs(runs, 8, 0.8)]
        assert max(got, default=0) == max(fits, default=0)
        if fits:
            assert passages.may_hold(a, b, 8, 0.8)


def test_a_passage_whose_halves_have_other_first_places(spark, docs):
    rnd = random.Random(17)
    p = sentence(rnd, 60, "h").split()
    own = lambda i, n: " ".join(f"own{i}x{j}x{n}" for j in range(n))
    rows = [(1, own(1, 40) + " " + " ".join(p[:35]) + " " + own(1, 41)), (2, own(2, 40) + " " + " ".join(p[-35:]) + " " + own(2, 41))]
    rows += [(i, own(i, 40) + " " + " ".join(p) + " " + own(i, 41)) for i in range(10, 21)]
    got = sorted((r.doc_id, r.first_word, r.words, r.other_id) for r in passages.repeated(docs(rows)).collect())
    assert got == [(i, 40, 60, 10) for i in range(11, 21)]


def test_a_changed_passage_of_common_phrases_links_its_documents(spark, docs, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 3)  # several blocks a seed
    rnd = random.Random(31)
    own = lambda i, n: " ".join(f"own{i}x{j}x{n}" for j in range(n))
    phrases = [sentence(rnd, 10, f"c{i}x") for i in range(6)]
    rows = [(i, own(i, 20) + " " + phrases[i % 6] + " " + own(i, 21)) for i in range(60)]  # each phrase in ten documents
    p = " ".join(phrases).split()
    for i, at in ((100, ()), (101, (25,)), (102, (12, 44))):
        words = [f"new{i}" if n in at else w for n, w in enumerate(p)]
        rows.append((i, own(i, 30) + " " + " ".join(words) + " " + own(i, 31)))
    got = {(r.doc_id, r.other_id) for r in passages.repeated(docs(rows)).collect()}
    assert got == {(101, 100), (102, 100), (102, 101)}


def test_outside_and_likely_pairs_against_brute_force():
    rnd = np.random.default_rng(32)
    for _ in range(50):
        pos, run = rnd.integers(0, 200, 40), rnd.integers(0, 200, int(rnd.integers(0, 4)))
        assert passages.outside(pos, run, 50).tolist() == [not any(r <= p and p + passages.K <= r + 50 for r in run) for p in pos]
    seen = np.zeros(1 << 16, bool)
    a, b = ([rnd.integers(0, 60, int(n)).astype(np.uint16) for n in rnd.integers(0, 40, 30)] for _ in range(2))
    want = [(i, j) for i in range(30) for j in range(30) if passages.hopeful(a[i], b[j], seen, 8, 0.8)]
    assert want and sorted(passages.likely_pairs(a, b, np.ones((30, 30), bool), seen, 8, 0.8)) == want


def test_pairs_of_a_common_seed_are_held_in_part_only():
    """All pairs of 800 like runs are given, but never held at once."""
    rnd = np.random.default_rng(33)
    run, seen, asked = rnd.integers(0, 1 << 16, 105).astype(np.uint16), np.zeros(1 << 16, bool), np.ones((800, 800), bool)
    tracemalloc.start()
    try:
        n = sum(1 for _ in passages.likely_pairs([run] * 800, [run] * 800, asked, seen, 50, 0.8))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 640_000 and most < 25_000_000 and not seen.any()


def test_texts_that_share_an_id_are_documents_of_their_own(spark, docs):
    rnd = random.Random(21)
    x, p = sentence(rnd, 80, "x"), sentence(rnd, 70, "p")
    own = lambda s, n: " ".join(f"{s}{j}" for j in range(n))
    rows = [(3, x), (5, x), (5, own("five", 30) + " " + p), (7, own("seven", 20) + " " + p), (7, own("seven", 20) + " " + p)]
    got = sorted((r.doc_id, r.first_word, r.words, r.other_id, r.other_first) for r in passages.repeated(docs(rows)).collect())
    assert got == [(5, 0, 80, 3, 0), (7, 20, 70, 5, 30)]
    same = sorted((r.doc_id, r.words, r.other_id) for r in passages.repeated(docs([(1, own("a", 9) + " " + p), (1, own("b", 12) + " " + p)])).collect())
    assert same == [(1, 70, 1)]


def test_frequent_runs_take_all_runs_without_a_rare_seed():
    rnd = np.random.default_rng(18)
    for _ in range(50):
        h = rnd.integers(1, 2**62, int(rnd.integers(1, 90))).astype(np.uint64)
        seeds = passages.minimizers(h, np.zeros(len(h), int))[2]
        often = seeds[rnd.random(len(seeds)) < 0.9]
        got = set(passages.frequent_runs(len(h), seeds, often, 20).tolist())
        for i in range(len(h) - 19):
            inner = [s for s in seeds if i + passages.WINDOW - 1 <= s <= i + 20 - passages.K - passages.WINDOW + 1]
            assert (i in got) == (set(inner) <= set(often))
            # these seeds are the run's own, whatever stands around it
            assert {s - i for s in inner} <= set(passages.minimizers(h[i : i + 20], np.zeros(20, int))[2].tolist())


def test_a_passage_along_a_longer_one_is_left_out():
    spans = [(10, 60, 10, 60), (0, 300, 0, 302), (100, 60, 240, 60), (290, 60, 292, 60)]
    assert sorted(passages.outermost(spans)) == [1, 2, 3]


def test_alignment_counts_equal_words():
    a = np.arange(40)
    b = np.delete(a, [5, 20])
    assert passages.aligned(a, b) == 38 and passages.aligned(a, a) == 40 and passages.aligned(a[:0], a) == 0
    assert passages.aligned(a, a + 100) == 0


# ---------------------------------------------------------------- op4


def test_toxicity_held_out(spark):
    found = queries.op4_toxicity(spark, SF_LARGE).join(common.table(spark, SF_LARGE, "labels"), "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.9


def test_kernel_weights_equal_the_nystrom_machine():
    alphabet = toxicity.Alphabet.of({c: 1 for c in "abcdefghijklmnopqrstuvwxyz"})
    words = ["idiot", "idxiot", "garden", "moron"]
    r, c, v = toxicity.vectors(words, alphabet)
    k = np.zeros((4, 4))
    for i in range(4):
        for j in range(4):
            a, b = dict(zip(c[r == i], v[r == i])), dict(zip(c[r == j], v[r == j]))
            k[i, j] = sum(x * b.get(t, 0.0) for t, x in a.items())
    assert np.allclose(np.diag(k), 1) and k[0, 1] > 0.4 > k[0, 2]


def test_toxicity_tolerates_disguise_and_edge_cases(spark, docs):
    rnd = random.Random(5)
    benign = [f"{a}{b}" for a in ("gar", "riv", "hou", "tre", "mou", "flo") for b in ("den", "er", "se", "ntain", "wer", "ling", "tan")]
    rows, labels = [], []
    for i in range(240):
        w = [rnd.choice(benign) for _ in range(30)]
        if i % 3 == 0:
            w[rnd.randrange(30)] = rnd.choice(["idiot", "worthless", "pathetic"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 3 == 0), "x"))
    extra = [(1000, "garden idi.ot river"), (1001, "garden i d i o t river"), (1002, "garden wor*thless"), (1003, "garden river house"), (1004, None), (1005, ""), (None, "garden"), (1000, "garden idi.ot river")]
    lab = spark.createDataFrame(labels, "doc_id bigint, toxic int, text string")
    out = toxicity.scored(docs(rows + extra), lab)
    assert out.count() == len(rows + extra) and out.where("score is null or score < 0 or score > 1").count() == 0
    hit = {r.doc_id for r in out.where("predicted = 1").collect()}
    assert {1000, 1001, 1002} <= hit and not {1003, 1004, 1005, None} & hit
    assert toxicity.scored(docs(rows), lab.limit(0)).where("score = 0 and predicted = 0").count() == len(rows)
    assert toxicity.scored(docs([]), lab).count() == 0


def _kernel(a, b, alphabet, scored=False):
    """The kernel of two windows from its definition, triple by triple; ``scored``: a is scaled as a scored window is."""

    def entries(text, scored=False):
        out, square = Counter(), 0.0
        text = " ".join(text.split())
        for i, j, k in ((i, j, k) for i in range(len(text)) for j in range(i + 1, len(text)) for k in range(j + 1, min(len(text), i + toxicity.SPAN))):
            cls = [int(alphabet.table[ord(text[p])]) for p in (i, j, k)]
            if all(cls) and text[i:k].count(" ") <= 1:
                out[tuple(cls)] += toxicity.DECAY ** (k - i + 1)
                square += toxicity.DECAY ** (2 * (k - i + 1))
        length = square**0.5 if scored else sum(v * v for v in out.values()) ** 0.5
        return {t: v / length for t, v in out.items()}

    x, y = entries(a, scored), entries(b)
    return sum(v * y.get(t, 0.0) for t, v in x.items())


def test_machine_equals_the_nystrom_formula_on_full_kernels():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdeiorst") for _ in range(rnd.randint(3, 7)))
    bad = [f"idiot {word()}" if i % 2 else "idiot" for i in range(20)]
    good = [f"{word()} {word()}" for _ in range(40)]
    machine = toxicity._machine(bad, good, 1000)  # all samples are landmarks
    own = bad + good
    y = np.array([1.0] * len(bad) + [-1.0] * len(good))
    pick = [own[i] for i in range(len(own))]
    full = np.array([[_kernel(a, b, machine.alphabet) for b in pick] for a in own])
    value, basis = np.linalg.eigh(full)
    root = basis / np.sqrt(np.maximum(value, 1e-4)) @ basis.T
    z = np.concatenate([full @ root, np.ones((len(own), 1))], 1)
    cost = np.where(y > 0, 1 / (2 * len(bad)), 1 / (2 * len(good)))
    w = np.zeros(z.shape[1])
    for _ in range(200):
        near = y * (z @ w) < 1
        hess = z[near].T @ (z[near] * cost[near, None]) + 1e-4 * np.eye(len(w))
        new = np.linalg.solve(hess, z[near].T @ (cost[near] * y[near]))
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    texts = ["you idiot there", "idxiot", "rest of it", *own[:6]]
    for text, got in zip(texts, machine.decisions(texts)):
        parts = text.split()
        windows = [" ".join(parts[i : i + k]) for k in range(1, toxicity.WORDS + 1) for i in range(len(parts) - k + 1)]
        k = np.array([[_kernel(x, p, machine.alphabet, scored=True) for p in pick] for x in windows])
        assert got == pytest.approx(min(1.0, float((k @ root @ w[:-1] + w[-1]).max())), abs=2e-3)


def _toxic_table(spark, sentence_of, noise=0.0, n=300, seed=6):
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("gar", "riv", "hou", "tre", "mou", "flo", "sta", "win") for b in ("den", "er", "se", "ntain", "wer", "ling", "tan", "dow")]
    rows, labels, truth = [], [], {}
    for i in range(n):
        sentences = [" ".join(rnd.choice(vocabulary) for _ in range(8)) for _ in range(5)]
        truth[i] = int(i % 3 == 0)
        if truth[i]:
            sentences.insert(rnd.randrange(6), sentence_of(rnd, vocabulary))
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, truth[i] if rnd.random() >= noise else 1 - truth[i]))
    return rows, spark.createDataFrame(labels, "doc_id bigint, toxic int"), truth


def _recall(out, truth):
    held = [r for r in out.collect() if r.held_out]
    caught = [r.predicted for r in held if truth[r.doc_id]]
    clean = [r.predicted for r in held if not truth[r.doc_id]]
    return sum(caught) / len(caught), 1 - sum(clean) / len(clean)


def test_toxic_phrases_of_harmless_words(spark, docs):
    rows, labels, truth = _toxic_table(spark, lambda rnd, v: f"{v[3]} {v[17]} {v[30]} {v[9]} {v[44]}")
    out = toxicity.scored(docs(rows), labels)
    assert out.select("score").distinct().count() > 10
    recall, left_alone = _recall(out, truth)
    assert recall > 0.9 and left_alone > 0.9


def test_toxic_labels_with_noise(spark, docs):
    insult = lambda rnd, v: " ".join([*rnd.sample(v, 4), rnd.choice(["idiot", "worthless", "pathetic"]), *rnd.sample(v, 3)])
    rows, labels, truth = _toxic_table(spark, insult, noise=0.15, n=600)
    recall, left_alone = _recall(toxicity.scored(docs(rows), labels), truth)
    assert recall > 0.9 and left_alone > 0.9


def test_toxicity_of_a_very_long_text(spark, docs):
    insult = lambda rnd, v: " ".join([*rnd.sample(v, 4), "idiot", *rnd.sample(v, 3)])
    rows, labels, _ = _toxic_table(spark, insult)
    long = "river garden house. " * 80_000
    out = {r.doc_id: r.predicted for r in toxicity.scored(docs(rows + [(901, long), (902, long + "river idiot garden")]), labels).where("doc_id > 900").collect()}
    assert out == {901: 0, 902: 1}


# ---------------------------------------------------------------- op5


def test_licenses_match_brute_force(spark, docs):
    rnd = random.Random(6)
    rows = [(1, None), (2, ""), (3, "all rights"), (4, "ALL RIGHTS RESERVED"), (4, "ALL RIGHTS RESERVED"), (5, sentence(rnd, 3000))]
    for i, (name, text) in enumerate(licenses.TEMPLATES.items(), 10):
        w = text.split()
        rows += [(i, sentence(rnd, 200) + "\n" + text + "\n" + sentence(rnd, 50)), (i + 100, " ".join(w[: len(w) // 2])), (None, text)]
        w[-1] = "altered"
        rows.append((i + 200, sentence(rnd, 7) + " " + " ".join(w)))
    got = {(r.doc_id, r.license) for r in licenses.found(docs(rows)).collect()}
    want = set()
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        for name, text in licenses.TEMPLATES.items():
            p = re.findall(r"[^\W_]+", text.lower())
            k = min(5, len(p))
            own = {tuple(p[a : a + k]) for a in range(len(p) - k + 1)}
            there = [tuple(w[a : a + k]) for a in range(len(w) - k + 1)]
            n = len(p) - k + 1 + 2 * (len(p) // 10)
            if any(len(own & set(there[max(0, a) : a + n])) >= 0.8 * len(own) for a in range(-n, len(there))):
                want.add((i, name))
    assert got == want
    assert licenses.found(docs([])).count() == 0 and licenses.found(docs(rows), {}).count() == 0


def test_licenses_run_without_python(spark):
    plan = licenses.found(common.table(spark, SF_CHECK, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---------------------------------------------------------------- op6


def test_topk_equals_brute_force(spark):
    got = {}
    for r in queries.op6_topk(spark, SF_CHECK).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    rows = common.table(spark, SF_CHECK, "documents").select("doc_id", "text").collect()
    words = [Counter(wordhash.hashed([r.text or ""])[0].tolist()) for r in rows]
    size = np.array([sum(w.values()) for w in words])
    df, n = Counter(x for w in words for x in w), len(rows)
    for q, r in enumerate(rows):
        if r.doc_id % 50:
            continue
        score = [sum(float(idf(np.float64(df[x]), n)) * w[x] * 2.2 / (w[x] + 1.2 * (0.25 + 0.75 * s / size.mean())) for x in words[q] if x in w) for w, s in zip(words, size)]
        best = sorted((-round(s, 6), rows[i].doc_id) for i, s in enumerate(score) if s > 0)[:10]
        assert [d for _, d in best] == [d for d, _ in got[r.doc_id]]
        assert np.allclose([-s for s, _ in best], [s for _, s in got[r.doc_id]], atol=2e-6)


def test_topk_edge_cases_and_blocks_of_queries(spark, docs):
    rows = [(0, "a b c"), (50, "b c d"), (100, None), (150, ""), (7, "a a b"), (8, "z"), (None, "a b"), (50, "q"), (200, "nothing shared")]
    one = topk.like_documents(docs(rows)).orderBy("query_id", "rank").collect()
    found = topk.index(docs(rows))
    ask = found.where("doc_id % 50 = 0").groupBy(F.col("doc_id").alias("query_id")).agg(F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"))
    assert topk.search(found, ask, at_once=1).orderBy("query_id", "rank").collect() == one
    assert {r.query_id for r in one} == {0, 50, 200} and {r.doc_id for r in one if r.query_id == 50} == {0, 7, 50}
    assert topk.like_documents(docs([])).count() == 0


def test_topk_scores_common_words_as_a_table_and_the_rest_by_postings():
    rnd = np.random.default_rng(6)
    terms = np.sort(rnd.choice(1 << 60, 400, replace=False).astype(np.uint64))
    share = np.concatenate([np.full(40, 0.6), np.full(360, 0.02)])
    has = rnd.random((300, 400)) < share
    has[200:202], has[299] = has[7], False  # equal texts, and one without a word
    counts = [rnd.integers(1, 4, 400)[h] if not 200 <= i < 202 else np.ones(h.sum(), np.int64) for i, h in enumerate(has)]
    length = np.array([c.sum() for c in counts], float)
    weight, queries = rnd.random(400) * 5, [np.flatnonzero(h) for h in has[::3]] + [np.zeros(0, int)]
    asked = np.bincount(np.concatenate(queries), minlength=400)
    ids = rnd.permutation(300)
    shard = topk.Shard(ids, [terms[h] for h in has], counts, length, terms, weight, asked, len(queries), length.mean())
    assert len(shard.table) == 40 and len(shard.post_doc) == has[:, 40:].sum()
    impact = np.zeros((300, 400))
    for i, (h, c) in enumerate(zip(has, counts)):
        impact[i, h] = weight[h] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * length[i] / length.mean()))
    for floor in (-np.inf, 20.0):
        got = list(shard.search(queries, 10, np.full(len(queries), floor)))
        assert len(got) == len(queries)
        for query, (found, score) in zip(queries, got):
            want = sorted((-round(s, 9), i) for i, s in zip(ids.tolist(), impact[:, query].sum(axis=1).tolist()) if s > 0)[:10]
            n = sum(-s >= floor for s, _ in want)
            assert found[:n].tolist() == [i for _, i in want[:n]] and np.allclose(score[:n], [-s for s, _ in want[:n]])


def test_topk_task_gives_the_best_of_all_its_shards(monkeypatch):
    rnd = np.random.default_rng(7)
    terms = np.sort(rnd.choice(1 << 60, 300, replace=False).astype(np.uint64))
    has = rnd.random((400, 300)) < 0.1
    words, counts = pa.array([terms[h].view(np.int64) for h in has]), pa.array([rnd.integers(1, 4, h.sum()).astype(np.int32) for h in has])
    length = np.array([c.values.to_numpy().sum() for c in counts])
    batch = pa.RecordBatch.from_arrays([pa.array(rnd.permutation(400)), words, counts, pa.array(length)], names=["doc_id", "words", "counts", "length"])
    lists = [np.flatnonzero(h).astype(np.int32) for h in has[:20]]
    shared = SimpleNamespace(value=(terms, list(range(20)), lists, rnd.random(300) * 5))

    def answers():
        run = topk._searcher(shared, float(length.mean()), 5, [pa.int64(), pa.int64(), pa.float64()])
        rows = [r for b in run(iter(batch.slice(i, 50) for i in range(0, 400, 50))) for r in b.to_pylist()]
        return sorted((r["query_id"], -r["score"], r["doc_id"]) for r in rows)

    one = answers()
    monkeypatch.setattr(topk, "SHARD_DOCS", 100)
    assert len(one) == 100 and [(q, d) for q, _, d in answers()] == [(q, d) for q, _, d in one]


def test_hashes_are_ordered_also_if_only_their_lower_bits_differ():
    rnd = np.random.default_rng(8)
    for low in (1 << 3, 1 << 60):
        words = (rnd.integers(0, 4, 500).astype(np.uint64) << np.uint64(61)) + rnd.integers(0, low, 500).astype(np.uint64)
        assert topk._word_order(words).tolist() == np.argsort(words, kind="stable").tolist()
    assert not len(topk._word_order(np.zeros(0, np.uint64)))


# ---------------------------------------------------------------- op7


def test_url_filter_equals_sql(spark):
    got = queries.op7_url_filter(spark, SF_CHECK).toPandas()
    con = duckdb.connect()
    con.sql(f"create view pages as select * from read_parquet('{SF_CHECK}/pages.parquet')")
    want = con.sql(queries.ORACLE["op7_url_filter"]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert got[cols].sort_values("page_id").fillna("-").astype(str).values.tolist() == want[cols].sort_values("page_id").fillna("-").astype(str).values.tolist()


@pytest.mark.parametrize(
    "url,host,path,rule,verdict",
    [
        (None, "", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("http://A.Example.ORG/en/12?x#y", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
        ("http://notorg/", "notorg", "/", None, "allow"),
        ("http://casino-win.net/", "casino-win.net", "/", None, "block"),
        ("http://casinos.net/", "casinos.net", "/", None, "allow"),
        ("http://free.net/", "free.net", "/", None, "allow"),
        ("http://free.net/free/free", "free.net", "/free/free", None, "allow"),
        ("http://free.net/BETS", "free.net", "/BETS", None, "block"),
        ("http://a.net?q=casino", "a.net", "", None, "block"),
        ("http://a.net/go#XXX", "a.net", "/go", None, "block"),
        ("casino.example.com/xxx", "", "", None, "block"),
        ("http://a.net?q=occasion&casinos", "a.net", "", None, "allow"),
        ("http://health.net/sex-education", "health.net", "/sex-education", None, "allow"),
        ("http://a.net/sex?free=1", "a.net", "/sex", None, "block"),
        ("http://a.net/sex?sex=sex#sex", "a.net", "/sex", None, "allow"),
        ("http://a.net#/de/", "a.net", "", None, "allow"),
        ("x://y://casino", "y:", "//casino", None, "block"),
    ],
)
def test_url_rules(spark, url, host, path, rule, verdict):
    row = url_filter.judged(spark.createDataFrame([(1, url, "h")], "page_id int, url string, host string")).first()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def test_url_filter_of_an_empty_table(spark):
    assert url_filter.judged(spark.createDataFrame([], "page_id int, url string")).count() == 0


# ---------------------------------------------------------------- op8


def labelled(spark, n=300):
    rnd = random.Random(7)
    kinds = {"a": [f"alpha{i}" for i in range(40)], "b": [f"beta{i}" for i in range(40)], "c": [f"gamma{i}" for i in range(40)]}
    rows = [(i, k, " ".join(rnd.choice(kinds[k]) for _ in range(rnd.randint(5, 60)))) for i, k in enumerate(rnd.choices("abc", [6, 3, 1], k=n))]
    return [(i, t) for i, _, t in rows], spark.createDataFrame([(i, k) for i, k, _ in rows[: n // 2]], "doc_id bigint, domain string")


def test_mixing_meets_its_targets(spark, docs):
    rows, labels = labelled(spark)
    shares = {"a": 0.4, "b": 0.3, "c": 0.3}
    out = mixing.document_rates(docs(rows), labels, shares, budget=6000.0).collect()
    total = np.sum([np.array(r.p) * r.tokens * r.rate for r in out], axis=0)
    assert np.allclose(total, 6000 * np.array([0.4, 0.3, 0.3]), rtol=2e-3)
    assert min(r.rate for r in out) >= 0
    # the same rates by plain projected gradient over all documents
    p, n = np.array([r.p for r in out]), np.array([r.tokens for r in out])
    t = 6000 * np.array([0.4, 0.3, 0.3])
    w = 1 / t
    r = np.ones(len(out))
    step = 1 / np.linalg.eigvalsh(np.sqrt(w)[:, None] * ((p * n[:, None]).T @ p) * np.sqrt(w)[None]).max()
    for _ in range(60):
        reached = (r * n) @ p
        if np.all(np.abs(reached - t) <= 1e-3 * t):
            break
        r = np.maximum(0, r - p @ (step * w * (reached - t)))
    assert np.allclose(r, [x.rate for x in out], atol=1e-6)


def test_share_of_upper_case_letters_is_of_the_whole_text():
    rnd = random.Random(19)
    for n in (0, 1, 1999, 2000, 2001, 3000, 3999, 4000, 4001, 9000):
        text = "".join(rnd.choice("aBcDe É\u01c5.") for _ in range(n))
        dense = mixing.features([text], wordhash.word_characters())[2]
        assert dense[0][3] == pytest.approx(sum(c.isupper() for c in text) / max(1, n))
    assert mixing.features(["Ab" * 1500], wordhash.word_characters())[2][0][3] == 0.5


def test_mixing_edge_cases(spark, docs):
    rows, labels = labelled(spark, 120)
    extra = [(900, None), (901, ""), (None, "alpha1 alpha2"), (902, "alpha1 " * 20_000), (0, rows[0][1])]
    df = docs(rows + extra)
    out = mixing.document_rates(df, labels, {"a": 1.0, "b": 1.0, "c": 1.0})
    assert out.count() == len(rows + extra) and out.where("rate is null or rate < 0").count() == 0
    assert out.where("doc_id in (900, 901) and tokens = 0").count() == 2
    again = mixing.mixed(df, labels, {"a": 0.1, "b": 0.1, "c": 0.8})
    assert again.columns == df.columns and again.count() > df.count()
    assert mixing.mixed(df, labels.limit(0), {"a": 1.0}).count() == df.count()
    assert mixing.document_rates(df, labels.limit(0), {"a": 1.0}).where("rate = 1").count() == df.count()
    assert mixing.document_rates(docs([]), labels, {"a": 1.0}).count() == 0
    assert mixing.mixed(docs([]), labels, {"a": 1.0}).count() == 0


def test_steps_that_no_later_step_reads_leave_the_disk(spark, docs, monkeypatch):
    made, write = {}, common.written
    monkeypatch.setattr(common, "written", lambda df, name, **options: made.setdefault(name, write(df, name, **options)))
    rnd = random.Random(41)
    p = sentence(rnd, 60)
    rows = [(i, f"own{i} " * 9 + p) for i in range(8)]
    assert passages.repeated(docs(rows)).count() == 7
    held = {name: spark.read.parquet(df.inputFiles()[0].rsplit("/", 1)[0]).count() for name, df in made.items()}
    assert held["words"] == 8 and held["runs"]
    assert not any(held[s] for s in ("seeds", "places", "shared", "stretches", "common", "chains")), held
    assert spark.conf.get(common.CLEAN_SHUFFLES, "false") == "false"


def test_shuffle_files_of_a_written_step_are_removed(spark):
    # the files of another job's shuffle stay, so it is seen whether the written one's went
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    common.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "k"), "grouped")
    assert tracker.shuffleStatuses().size() <= before


def test_sorted_groups_come_whole_from_batches_of_any_size():
    rnd = random.Random(42)
    for _ in range(50):
        keys = sorted(rnd.choices(range(rnd.randint(1, 12)), k=rnd.randint(0, 40)))
        table = pa.table({"k": pa.array([{"id": k // 2, "mark": k % 2} for k in keys], pa.struct([("id", pa.int64()), ("mark", pa.int64())])), "n": list(range(len(keys)))})
        batches, at = [], 0
        while at < len(keys):
            size = rnd.randint(0, 7)
            batches.append(pa.RecordBatch.from_pylist(table.slice(at, size).to_pylist(), table.schema))
            at += size
        parts = [p.column("k").to_pylist() for p in passages.whole_groups(iter(batches), ("k",))]
        assert [k["id"] * 2 + k["mark"] for p in parts for k in p] == keys
        seen = [{(k["id"], k["mark"]) for k in p} for p in parts]
        assert sum(map(len, seen)) == len(set(keys)) and all(seen)


def test_linked_places_of_two_documents_are_one_list(spark):
    """A line that two texts repeat: its places are linked in lists, and chained as single matches are."""
    rnd = np.random.default_rng(43)
    run = rnd.integers(-9999, 9999, 60).astype(np.int16)
    rows = [{"seed": 1, "low": 0, "high": 0, "own": 0, "doc_id": {"id": d, "mark": d}, "pos": 100 * i + d, "near": run, "beside": 100 * i + d, "fixed": True} for d in (3, 5) for i in range(20)]
    kind = pa.struct([("id", pa.int64()), ("mark", pa.int64())])
    kinds = {"doc_id": kind, "pos": pa.int32(), "near": pa.list_(pa.int16())}
    table = pa.table({c: pa.array([r[c] for r in rows], kinds.get(c)) for c in rows[0]})
    got = pa.Table.from_batches(passages._linked(table, 50, 0.8)).to_pylist()
    assert len(got) == 2  # 400 matches, at most ``LISTED`` a row
    assert all((r["doc_id"]["id"], r["other_id"]["id"], r["pos"], r["other_pos"]) == (5, 3, r["xs"][0], r["ys"][0]) for r in got)
    matches = [m for r in got for m in zip(r["xs"], r["ys"])]
    assert sorted(matches) == [(100 * i + 5, 100 * j + 3) for i in range(20) for j in range(20)]
    single = [{"doc_id": {"id": 5, "mark": 5}, "other_id": {"id": 3, "mark": 3}, "pos": x, "other_pos": y, "xs": None, "ys": None} for x, y in matches]
    schema = pa.schema([("doc_id", kind), ("other_id", kind), ("pos", pa.int32()), ("other_pos", pa.int32()), ("xs", pa.list_(pa.int32())), ("ys", pa.list_(pa.int32()))])
    both = [pa.Table.from_batches(passages._chained(pa.Table.from_pylist(r, schema), 50)).to_pylist() for r in (got, single)]
    assert both[0] and both[0] == both[1]
