"""op11 against SQL and a plain Python version, with its edge cases and the way without a broadcast."""

import random
from collections import Counter

import duckdb
import pytest

from weekcast.llm import line_dedup, queries

from given import SF_CHECK

BLANK = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, min_docs, min_chars=1, keep="none"):
    """Rows (id, text, n_lines, n_dropped)."""
    lines = [(i, (t or "").split("\n")) for i, t in rows]
    held = Counter(k for _, own in lines for k in {key_of(x) for x in own} if len(k) >= min_chars)
    first = {}
    for i, own in lines:
        for n, x in enumerate(own):
            k = key_of(x)
            first[k] = min(first.get(k, (True, 0, 0)), (i is None, i or 0, n))
    out = []
    for i, own in lines:
        stay = [x for n, x in enumerate(own) if not (held[key_of(x)] >= min_docs and len(key_of(x)) >= min_chars) or (keep == "first" and first[key_of(x)] == (i is None, i or 0, n))]
        out.append((i, "\n".join(stay), len(own), len(own) - len(stay)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def corpus():
    rnd = random.Random(3)
    common = ["Cookie Notice", "  cookie notice\t", "Ärger", "ärger", "\x0bA b C\r", "x", "", "   ", "日本", "tab\tinside"]
    rows = []
    for i in range(120):
        rows.append((i, "\n".join(rnd.choice(common) if rnd.random() < 0.5 else f"own {rnd.randrange(60)}" for _ in range(rnd.randrange(0, 9)))))
    rows += [(5, "Cookie notice\n\n"), (5, "Cookie notice\n\n"), (None, "x\nx\nx"), (None, None), (200, ""), (201, "\n"), (202, "end\n"), (203, " ".join(["long"] * 400_000) + "\nx\n" + "y" * 1_500_000)]
    return rows


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"filter_bytes": 1 << 10}])
def test_equals_plain_version(docs, keep, limits):
    rows = corpus()
    df = docs(rows).repartition(7)
    got = line_dedup.deduped(df, min_docs=6, min_chars=2, keep=keep, **limits)
    assert got.columns[: len(df.columns)] == df.columns
    assert rows_of(got) == brute(rows, 6, 2, keep)


def test_one_batch_and_many_copies(docs):
    rows = [(i, "same line\nown %d" % i) for i in range(300)] + [(1000 + i, "same line\ncopy") for i in range(300)]
    assert rows_of(line_dedup.deduped(docs(rows).coalesce(1), 10)) == brute(rows, 10)


def test_empty_and_clashing_columns(spark, docs):
    assert line_dedup.deduped(docs([]), 2).count() == 0
    df = spark.createDataFrame([(1, "a", "p", 7), (2, "a\nb", "q", 8)], "doc_id long, text string, digest string, n_lines int")
    out = line_dedup.deduped(df, 2)
    assert sorted(tuple(r) for r in out.select("doc_id", "text", "digest", "n_lines", "n_dropped").collect()) == [(1, "", "p", 1, 1), (2, "b", "q", 2, 1)]


def test_only_suspects_are_shuffled_as_digests(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "concat('own line ', id, '\\nfooter ', id % 7) as text")
    table, shards, bits = line_dedup.twice_seen(rows, 1, 1 << 20)
    assert table.size <= 1 << 20 and shards * bits >= 8 * 40_000
    shared, _ = line_dedup.shared_lines(rows, 10)
    assert {r.docs for r in shared.collect()} == {2857, 2858} and shared.count() == 7


def test_query_equals_sql(spark):
    got = {tuple(r) for r in queries.op11_line_dedup(spark, SF_CHECK).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()}
    duckdb.sql(f"create or replace view documents as select * from '{SF_CHECK}/documents.parquet'")
    want = set(duckdb.sql(queries.ORACLE["op11_line_dedup"]).fetchall())
    assert got == want and sum(r[2] for r in want) > 100
