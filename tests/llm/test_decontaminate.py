"""op1: hits against brute force, quotes at any place, block-max WAND against plain scoring, edge cases."""

import random
import tracemalloc

import numpy as np

from weekcast.llm import common, decontaminate, queries, wordhash
from weekcast.llm.bm25 import BlockMaxIndex

from given import SF_CHECK


def shingles(text, k=5):
    w = "".join(c.lower() if c.isalnum() else " " for c in text or "").split()
    k = min(k, len(w))
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def test_hits_match_brute_force(spark):
    got = {(r.doc_id, r.item_id) for r in queries.op1_decontamination(spark, SF_CHECK).collect()}
    items = [(r.item_id, [shingles(p) for p in decontaminate.parts(r.text)]) for r in common.table(spark, SF_CHECK, "benchmark").collect()]
    want = set()
    for r in common.table(spark, SF_CHECK, "documents").select("doc_id", "text").collect():
        own = {k: shingles(r.text, k) for k in range(1, 6)}
        for item, halves in items:
            if all(not p or len(p & own[len(next(iter(p)).split())]) >= 0.8 * len(p) for p in halves):
                want.add((r.doc_id, item))
    assert got == want and got


def test_search_equals_plain_scores():
    rnd = random.Random(2)
    docs = [[f"w{min(rnd.randrange(60), rnd.randrange(60))}" for _ in range(rnd.randint(1, 40))] for _ in range(90)]
    words = [wordhash.hashed([" ".join(d)])[0] for d in docs]
    index = BlockMaxIndex.build(list(range(90)), words, block=4, scale=True)
    for _ in range(40):
        q = wordhash.hashed([" ".join(f"w{rnd.randrange(70)}" for _ in range(15))])[0]
        tid = np.unique(index.term_ids(q))
        tid = tid[tid >= 0]
        plain = np.zeros(90)
        for t in tid:
            plain[index.docs[index.at[t] : index.at[t + 1]]] += index.impacts[index.at[t] : index.at[t + 1]]
        for threshold in (0.1, 0.3, 0.6):
            open_ = np.flatnonzero(index.bounds(tid, np.array([0]))[0] >= threshold)
            got = dict(index.search(tid, threshold, open_))
            want = {index.names[i]: s for i, s in enumerate(plain) if s >= threshold}
            assert set(got) == set(want)


def test_quote_at_any_place_and_edge_cases(spark, docs):
    words = [f"q{i}" for i in range(24)]
    item = " ".join(words[:16]) + ". " + " ".join(words[16:]) + "."
    filler = [f"f{i % 97}" for i in range(400)]
    rows = [(n, " ".join(filler[:n] + words + filler[n:])) for n in range(0, 400, 7)]
    clean = [(1000, " ".join(filler)), (1001, None), (1002, ""), (1003, " ".join(words[:16])), (None, item), (1004, " ".join(reversed(words)))]
    items = spark.createDataFrame([(1, item, "x"), (2, item, "x"), (3, None, "x"), (4, "", "x")], "item_id int, text string, score string")
    hits = decontaminate.contaminated(docs(rows + clean + rows[:1]), items)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.item_id) for r in hits.collect())
    want = sorted([(False, i, k) for i, _ in rows + rows[:1] for k in (1, 2)] + [(True, 0, 1), (True, 0, 2)])
    assert got == want
    left = decontaminate.without(docs(rows + clean), hits)
    assert {r.doc_id for r in left.collect()} == {1000, 1001, 1002, 1003, 1004}
    assert decontaminate.contaminated(docs([]), items).count() == 0
    assert decontaminate.contaminated(docs(rows), items.limit(0)).count() == 0


def test_items_that_share_an_id_are_both_found(spark, docs):
    a, b = "the red fox jumps over nine lazy dogs today. what is the answer to this riddle then.", "seven blue whales swim far below the northern ice. how deep do they dive at night."
    items = spark.createDataFrame([(1, a), (1, b), (1, b)], "item_id long, text string")
    got = decontaminate.contaminated(docs([(10, "x y z " + a), (11, b + " q r s"), (12, a + " " + b)]), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(10, 1), (11, 1), (12, 1), (12, 1)]


def test_a_large_index_is_sparse():
    """10,000 items: the index grows with its postings, and bounds of many passages are cut to a bounded size."""
    rnd = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rnd.integers(0, 20_000, 40)) + ". " + " ".join(f"w{x}" for x in rnd.integers(0, 20_000, 10)) for _ in range(10_000)]
    items = decontaminate.Items.of(list(enumerate(texts)))
    held = sum(x.nbytes for x in vars(items.index).values() if isinstance(x, np.ndarray))
    assert held < 20_000_000 and items.index.blocks == 2500
    tracemalloc.start()
    found = items.hits([f"before {texts[77]} after", "nothing " * 300, *[t.upper() for t in texts[:300]]], 0.6, 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(d, i) for d, i, *_ in found} == {(0, 77), *((2 + k, k) for k in range(300))}
    assert peak < 1 << 30
