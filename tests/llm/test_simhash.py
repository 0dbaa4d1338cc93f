"""op9: fingerprints and links against brute force, null and empty texts, repeated rows, split buckets."""

import random

import numpy as np
import pytest
import xxhash

from weekcast.llm import simhash


def fingerprint(text, width=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    runs = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if len(words) >= width else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def classes(ids, fps, bits=3):
    root = dict(zip(ids, ids))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in zip(ids, fps):
        for j, b in zip(ids, fps):
            if bin(a ^ b).count("1") <= bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def texts(n=120, seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["ÄB", "É", "Ünder"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 400))) for _ in range(n // 4)]
    out = []
    for t in base:
        w = t.split()
        for k in range(4):
            copy = list(w)
            for _ in range(k):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append((" " if k % 2 else "\n").join(copy))
    return out + ["", "  \t", "one", "one two", "One TWO", None, None]


def test_fingerprint_matches_definition():
    for t in texts(40):
        assert simhash.fingerprint_of(None if t is None else t.encode()) == fingerprint(t)


def test_classes_match_brute_force(spark, docs):
    rows = list(enumerate(texts(), 5))
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs(rows)).collect()}
    fps = [fingerprint(t) for _, t in rows]
    want = classes([i for i, _ in rows], fps)
    assert got == {i: (f, want[i]) for (i, _), f in zip(rows, fps)}


@pytest.mark.parametrize("limit", [50_000, 8])
def test_links_of_close_fingerprints_with_split_buckets(spark, limit):
    rnd = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(25):
            x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp bigint")
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in simhash.links(df, 3, limit).collect():
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        assert a in root and b in root
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {x: find(x) for x in fps} == classes(fps, fps)


def test_keep_one_of_each_group(spark, docs):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(7, long), (3, long), (3, long), (9, long + " x"), (4, "other words here now"), (None, "lone text of its own"), (1, None), (2, "")]
    out = simhash.keep_one(docs(rows))
    assert out.columns == docs(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 1), (False, 3), (False, 4), (True, 0)]


def test_empty_table(spark, docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_one(docs([])).count() == 0
