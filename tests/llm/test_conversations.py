"""op13 against SQL, against all edit sequences of small conversations, and in parts of any size."""

import hashlib
import itertools
import random

import duckdb
import pytest

from weekcast.llm import conversations as cv
from weekcast.llm import queries

from given import SF_CHECK

BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    """For (role, text) in order: blank, duplicate, truncated or None."""
    seen, out = set(), []
    for r, t in rows:
        solid = t.rstrip(BLANKS)
        out.append("b" if not solid else "d" if (r, t) in seen else "t" if solid[-1] not in ".!?" else None)
        seen.add((r, t))
    return out


def fits(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(body) >= 2 and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit of every row, with up to two inserts between rows."""
    bad, best = faults(rows), None
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product("DKua", repeat=len(rows)):
            cost, audit, out = 0, "", []
            for i in range(len(rows) + 1):
                for g in gaps[i]:
                    cost, audit = cost + 3, audit + "I"
                    out.append(({"u": "user", "a": "assistant"}[g], ""))
                if i == len(rows):
                    continue
                if edits[i] == "D":
                    cost, audit = cost + 4, audit + "D"
                    continue
                if bad[i] in ("b", "d"):
                    break
                cost += 3 * (bad[i] == "t")
                if edits[i] == "K":
                    audit += "K"
                    out.append(rows[i])
                else:
                    cost, audit = cost + 3, audit + "R"
                    out.append(({"u": "user", "a": "assistant"}[edits[i]], rows[i][1]))
            else:
                if fits("".join(r[:1] or "-" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                    best = cost, audit, out
    return best


def plain(rows):
    """The summary of (turn, role, text) rows by a forward table that keeps the least (cost, audit) of each state."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(r, x) for _, r, x in rows]
    bad = faults(pairs)
    best = {0: (0, "", ())}

    def better(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserted(table):
        for _ in range(2):
            for s, (c, a, out) in list(table.items()):
                better(table, 3 if s == 2 else 2, (c + 3, a + "I", (*out, ("assistant" if s == 2 else "user", ""))))
        return table

    for (role, text), fault in zip(pairs, bad):
        now = {}
        for s, (c, a, out) in inserted(best).items():
            better(now, s, (c + 4, a + "D", out))
            if fault in ("b", "d"):
                continue
            more = 3 * (fault == "t")
            want = "assistant" if s == 2 else "user"
            better(now, 3 if s == 2 else 2, (c + 3 + more, a + "R", (*out, (want, text))))
            if role[:1] == want[0]:
                better(now, 3 if s == 2 else 2, (c + more, a + "K", (*out, (role, text))))
            if role[:1] == "s" and s == 0:
                better(now, 1, (c + more, a + "K", (*out, (role, text))))
        best = now
    cost, audit, out = min((v for s, v in inserted(best).items() if s in (0, 3)), key=lambda v: v[:2])
    initials = [r[:1] for r, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return gaps, bad.count("b"), bad.count("d"), bad.count("t"), illegal, cost, audit, digest


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TEXTS = ["Yes.", "No!", "well", "", " \t", "Why?", None]
ROLES = ["user", "assistant", "system", "tool", None, ""]


def random_rows(rnd, n):
    return [(rnd.choice([None, *range(8)]) if rnd.random() < 0.2 else i, rnd.choice(ROLES if rnd.random() < 0.3 else ROLES[:3]), rnd.choice(TEXTS) if rnd.random() < 0.6 else f"own {i}.") for i in range(n)]


def test_walk_equals_every_edit():
    rnd = random.Random(5)
    for _ in range(120):
        rows = [(r if r is not None else " ", x if x is not None else " ") for _, r, x in random_rows(rnd, rnd.randrange(0, 4))]
        part = cv._Part(1)
        for i, (r, x) in enumerate(rows):
            part.add(i, r, x, 1)
        got = part.row(0, True)
        cost, audit, out = cheapest(rows)
        assert (got["cost"], got["audit"], [(r["role"], r["text"]) for r in got["repaired"]]) == (cost, audit, out)


@pytest.mark.parametrize("part_rows", [1, 3, 4096])
def test_parts_of_any_size_equal_plain_version(spark, part_rows):
    rnd = random.Random(part_rows)
    convs = {c: random_rows(rnd, rnd.choice([1, 2, 5, 9, 30])) for c in range(60)}
    convs[None] = random_rows(rnd, 7)
    convs[100] = [(i // 2, ROLES[i % 2], TEXTS[i % 2] if i % 5 else f"own {i}") for i in range(300)]  # long, with repeats
    convs[101] = [(3, "user", "Same.")] * 150 + [(4, "assistant", "end")]  # one row many times
    convs[102] = [(1, "user", "x. " * 200_000), (2, "assistant", "y")]
    rows = [(c, t, r, x, 9) for c, own in convs.items() for t, r, x in own]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int").repartition(6)
    got = {r[0]: tuple(r)[1:] for r in cv.summary(cv.repaired(df, part_rows=part_rows)).select(*COLUMNS).collect()}
    assert got == {c: plain(own) for c, own in convs.items()}


def test_rows_without_copies_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "x", 0), (2, 0, "user", "Hi.", 2), (2, 1, "assistant", "Ho.", 1)], "conv_id int, turn int, role string, text string, copies int")
    got = {r[0]: tuple(r)[1:] for r in cv.summary(cv.repaired(df, copies="copies")).select(*COLUMNS).collect()}
    assert got[1] == plain([]) and got[2] == plain([(0, "user", "Hi."), (0, "user", "Hi."), (1, "assistant", "Ho.")])
    assert got[1][-1] == hashlib.sha256(b"").hexdigest() and got[2][-2] == "KDK"
    assert cv.summary(cv.repaired(df.limit(0))).count() == 0


def test_query_equals_sql(spark):
    got = {tuple(r) for r in queries.op13_conversation_repair(spark, SF_CHECK).select(*COLUMNS).collect()}
    duckdb.sql(f"create or replace view conversations as select * from '{SF_CHECK}/conversations.parquet'")
    want = set(duckdb.sql(queries.ORACLE["op13_conversation_repair"]).fetchall())
    assert got == want and len(want) >= 100
