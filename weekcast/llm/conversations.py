"""Conversation structure repair: the cheapest edits that give turns of the form system? (user assistant)+, or none.

*Edits.*  Keep (0), Rerole to user or assistant (3), Delete (4; blank and
duplicate rows must go) and Insert of an empty user or assistant row (3).  A
truncated row that stays costs 3 more.  Of the cheapest edits those whose
initials come first in ASCII order are taken.

*Method.*  Four states (nothing yet, after system, after user, after
assistant) and, for each row, a vector of what the rest costs from each of
them.  The vectors are computed backward and stored at every square root of
the rows only; walking forward, each stretch is computed again from its
checkpoint and the least letter is taken among the edits that the vectors
prove tight.  State and letter give the next state, so the walk needs one state.

*Scale.*  Rows are sorted by conversation and turn over ranges, so a long
conversation lies in many partitions, cut into parts of bounded rows and
characters.  A conversation that is one part inside one partition is
finished there.  For the others each part gives a matrix of costs from state
to state (the vector step for all ends at once); one small row a part is
folded backward into the vector at each part's end, which is a checkpoint of
the whole conversation, and forward into each part's first state; then all
parts are walked at once.  Equal rows (same turn, role and text) are
counted before they are shuffled; all but the first are duplicates.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
PART_ROWS, PART_CHARS = 4096, 4_000_000
INF = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after the next user or assistant row, by state.
NEXT = (USER, USER, ASSISTANT, USER)
#: The costs of ending in each state: inserts complete it.
END = (0, 2 * INSERT, INSERT, 0)
_BLANKS = " \t\n\x0b\x0c\r"
# a row's code: role initial (s, u, a, other), blank, duplicate, truncated
BLANK, DUPLICATE, CUT = 4, 8, 16


def code_of(role: str, text: str) -> int:
    """The code of a row, but for duplicates."""
    solid = text.rstrip(_BLANKS)
    return "sua".find(role[:1] or "-") % 4 | (0 if solid.strip(_BLANKS) else BLANK) | (CUT if solid[-1:] not in (".", "!", "?") else 0)


def _keep(code: int, state: int) -> int | None:
    """State after keeping a row, None if it doesn't fit."""
    role = code & 3
    if role == 0:
        return SYSTEM if state == START else None
    return NEXT[state] if role < 3 and NEXT[state] == (USER if role == 1 else ASSISTANT) else None


def back(code: int, copies: int, v: tuple) -> tuple:
    """The vector before a row (and ``copies`` - 1 duplicates of it) from the vector after it."""
    if copies > 1:
        v = [x + DELETE * (copies - 1) for x in v]
    b = [x + DELETE for x in v]
    if not code & (BLANK | DUPLICATE):
        more = TRUNCATED if code & CUT else 0
        for s in range(4):
            b[s] = min(b[s], REROLE + more + v[NEXT[s]])
            kept = _keep(code, s)
            if kept is not None:
                b[s] = min(b[s], KEEP + more + v[kept])
    u, a = b[USER], b[ASSISTANT]
    return (
        min(b[START], INSERT + u, 2 * INSERT + a, INF), min(b[SYSTEM], INSERT + u, 2 * INSERT + a, INF), min(u, INSERT + a, INF), min(a, INSERT + u, INF),
    )


def vector(codes, copies, v: tuple) -> tuple:
    """The vector before all rows."""
    for c, n in zip(reversed(codes), reversed(copies)):
        v = back(c, n, v)
    return v


def walk(codes, copies, end: tuple, state: int, last: bool) -> Iterator[tuple[str, int, int]]:
    """(letter, row, state before) of the least tight edits; -1 as the row of an insert.  Letters of duplicates come with their row."""
    n = len(codes)
    step = max(1, math.isqrt(n))
    marks = {n: end}  # vectors at checkpoints
    v = end
    for i in range(n - 1, -1, -1):
        v = back(codes[i], copies[i], v)
        if i % step == 0:
            marks[i] = v
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        rest = [marks[hi]]
        for i in range(hi - 1, lo - 1, -1):
            rest.append(back(codes[i], copies[i], rest[-1]))
        for i in range(lo, hi):
            now, after = rest[hi - i], rest[hi - i - 1]
            code, left = codes[i], now[state]
            twins = DELETE * (copies[i] - 1)
            more = TRUNCATED if code & CUT else 0
            free = not code & (BLANK | DUPLICATE)
            while True:
                if DELETE + twins + after[state] == left:
                    yield "D" * copies[i], i, state
                    break
                if INSERT + now[NEXT[state]] == left:
                    yield "I", -1, state
                    state = NEXT[state]
                    left = now[state]
                    continue
                kept = _keep(code, state) if free else None
                if kept is not None and KEEP + more + twins + after[kept] == left:
                    yield "K" + "D" * (copies[i] - 1), i, state
                    state = kept
                else:
                    yield "R" + "D" * (copies[i] - 1), i, state
                    state = NEXT[state]
                break
    while last and END[state]:
        yield "I", -1, state
        state = NEXT[state]
    yield "", -1, state  # the last state


def _stats(codes, copies) -> dict:
    """Counts of a part's faults and illegal neighbours, with the initials at its ends."""
    out = {"rows": sum(copies), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    before = None
    for c, n in zip(codes, copies):
        if c & BLANK:
            out["blank"] += n
        elif c & DUPLICATE:
            out["duplicate"] += n
        else:
            out["duplicate"] += n - 1
            out["truncated"] += bool(c & CUT)
        out["illegal"] += n - 1 + (before is not None and not legal(before, c & 3))
        before = c & 3
    return out | {"first_role": codes[0] & 3 if codes else None, "last_role": before}


def legal(a: int, b: int) -> bool:
    """Role initials su, ua or au next to each other."""
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _edited(rows: list, codes, copies, end: tuple, state: int, last: bool) -> tuple[str, list]:
    letters, out = [], []
    for letter, i, s in walk(codes, copies, end, state, last):
        letters.append(letter)
        kind = letter[:1]
        if kind == "K":
            out.append(rows[i])
        elif kind in ("R", "I"):
            out.append({"role": "user" if NEXT[s] == USER else "assistant", "text": rows[i]["text"] if kind == "R" else ""})
    return "".join(letters), out


_SUMS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "cost")
_RESULT = "part bigint, whole boolean, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_role int, last_role int, turns bigint, min_turn bigint, max_turn bigint, cost bigint, audit string, repaired array<struct<role:string,text:string>>"
_ROW = pa.struct([("role", pa.string()), ("text", pa.string())])
_ARROW = [
    ("part", pa.int64()), ("whole", pa.bool_()), *[(c, pa.int64()) for c in _SUMS[:5]], ("first_role", pa.int32()), ("last_role", pa.int32()), ("turns", pa.int64()),
    ("min_turn", pa.int64()), ("max_turn", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.list_(_ROW)),
]
_OPEN = ", codes binary, copies binary, seen array<struct<digest:binary,row:int>>"
_OPEN_ARROW = [("codes", pa.binary()), ("copies", pa.binary()), ("seen", pa.list_(pa.struct([("digest", pa.binary()), ("row", pa.int32())])))]


class _Part:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv):
        self.conv, self.turns, self.rows, self.copies, self.chars = conv, [], [], [], 0

    def add(self, turn, role: str, text: str, copies: int) -> bool:
        """Whether the row is in the part now; a row beyond the bounds is not."""
        if self.rows and self.turns[-1] == turn and self.rows[-1] == {"role": role, "text": text}:
            self.copies[-1] += copies
            return True
        if self.rows and (len(self.rows) >= _Part.most_rows or self.chars + len(text) > PART_CHARS):
            return False
        self.turns.append(turn)
        self.rows.append({"role": role, "text": text})
        self.copies.append(copies)
        self.chars += len(text)
        return True

    most_rows = PART_ROWS

    def row(self, part: int, whole: bool) -> dict:
        real = [i for i, n in enumerate(self.copies) if n > 0]  # a row without copies only names its conversation
        rows, copies = [self.rows[i] for i in real], [self.copies[i] for i in real]
        turns = [self.turns[i] for i in real if self.turns[i] is not None]
        codes, seen = [], {}
        for i, r in enumerate(rows):
            c = code_of(r["role"], r["text"])
            if not c & BLANK and seen.setdefault((r["role"], r["text"]), i) != i:
                c |= DUPLICATE
            codes.append(c)
        out = {"conv_id": self.conv, "part": part, "whole": whole, "turns": len(set(turns)), "min_turn": turns[0] if turns else None, "max_turn": turns[-1] if turns else None}
        if not whole:
            digests = [{"digest": hashlib.blake2b(f"{len(r)}:{r}{t}".encode("utf-8", "surrogatepass"), digest_size=16).digest(), "row": i} for (r, t), i in seen.items()]
            return out | {"repaired": rows, "codes": bytes(codes), "copies": np.array(copies, np.int64).tobytes(), "seen": digests}
        audit, repaired = _edited(rows, codes, copies, END, START, True)
        return out | _stats(codes, copies) | {"cost": vector(codes, copies, END)[START], "audit": audit, "repaired": repaired}


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one, with their number."""
    for batch in batches:
        keys = ["conv_id", "turn", "role", "text"]
        yield from pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([("copies", "sum")]).select([*keys, "copies_sum"]).rename_columns([*keys, "copies"]).to_batches()


def _batches(rows: Iterator[dict], arrow: pa.Schema, at_once: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


def _cut(kind: pa.DataType, part_rows: int):
    """Sorted rows of a partition to parts; those of conversations inside it that are one part are finished."""
    arrow = pa.schema([("conv_id", kind), *_ARROW, *_OPEN_ARROW])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        _Part.most_rows = part_rows
        number = TaskContext.get().partitionId() << 32
        cur, whole = None, False  # the first conversation may have begun in the partition before
        for batch in batches:
            for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if cur is not None and cur.conv == conv:
                    if cur.add(turn, role, text, copies):
                        continue
                    yield cur.row(number, False)
                    whole = False
                elif cur is not None:
                    yield cur.row(number, whole)
                    whole = True
                number += 1
                cur = _Part(conv)
                cur.add(turn, role, text, copies)
        if cur is not None:
            yield cur.row(number, False)  # the last one may go on in the next partition

    return lambda batches: _batches(parts(batches), arrow)


def _per_conversation(df: DataFrame, step, kind: pa.DataType, names: list[str], schema: str, arrow: list, descending: bool = False) -> DataFrame:
    """One row a part, folded in order within each conversation: ``step(row, before)`` gives (carried, output row)."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, carried = object(), None
        for batch in batches:
            for row in batch.to_pylist():
                if row["conv_id"] != conv:
                    conv, carried = row["conv_id"], None
                carried, out = step(row, carried)
                yield out

    order = F.desc("part") if descending else F.asc("part")
    rows = df.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", order)
    return rows.mapInArrow(lambda batches: _batches(fold(batches), pa.schema(arrow)), schema)


def _finish(open_: DataFrame, kind: pa.DataType, name: str) -> DataFrame:
    """The parts of conversations that lie in several parts or at an end of a partition."""
    first = open_.select("conv_id", "part", F.explode("seen").alias("s")).select("conv_id", "part", "s.digest", "s.row")
    least = first.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "row")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = first.alias("f").join(least.alias("l"), F.col("f.conv_id").eqNullSafe(F.col("l.conv_id")) & (F.col("f.digest") == F.col("l.digest")))
    later = later.where(F.col("f.part") != F.col("l.least.part")).groupBy("f.part").agg(F.collect_list("f.row").alias("later"))  # at most a part's rows

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, copies = bytearray(row["codes"]), np.frombuffer(row["copies"], np.int64).tolist()
                gone = set(row["later"] or ())
                if gone:  # so are this part's repeats of them, which are marked
                    for i in gone:
                        codes[i] |= DUPLICATE
                matrix = []
                for t in range(4):
                    matrix += vector(codes, copies, tuple(0 if s == t else INF for s in range(4)))
                yield {"conv_id": row["conv_id"], "part": row["part"], "codes": bytes(codes), "copies": row["copies"], "matrix": matrix}

    ids = ("conv_id", kind), ("part", pa.int64())
    longs = pa.list_(pa.int64())
    arrow = pa.schema([*ids, ("codes", pa.binary()), ("copies", pa.binary()), ("matrix", longs)])
    light = open_.select("conv_id", "part", "codes", "copies").join(later, "part", "left").select("conv_id", "part", "codes", "copies", "later")
    light = common.written(light.mapInArrow(lambda b: _batches(marked(b), arrow), f"conv_id {name}, part bigint, codes binary, copies binary, matrix array<bigint>"), "conversation-codes")

    def ends(row: dict, carried):
        """Backward over the parts: the vector at each part's end."""
        end = carried or END
        before = [min(min(row["matrix"][4 * t + s] + end[t] for t in range(4)), INF) for s in range(4)]
        return before, {"part": row["part"], "end": list(end), "last": carried is None}

    at_end = _per_conversation(light, ends, kind, ["conv_id", "part", "matrix"], "part bigint, end array<bigint>, last boolean", [ids[1], ("end", longs), ("last", pa.bool_())], descending=True)

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                copies, end = np.frombuffer(row["copies"], np.int64).tolist(), tuple(row["end"])
                possible = vector(row["codes"], copies, end)
                to = [list(walk(row["codes"], copies, end, s, row["last"]))[-1][2] if possible[s] < INF else 0 for s in range(4)]
                yield {"conv_id": row["conv_id"], "part": row["part"], "end": row["end"], "last": row["last"], "to": to}

    arrow_to = pa.schema([*ids, ("end", longs), ("last", pa.bool_()), ("to", longs)])
    to = light.join(at_end, "part").select("conv_id", "part", "codes", "copies", "end", "last")
    to = to.mapInArrow(lambda b: _batches(leads(b), arrow_to), f"conv_id {name}, part bigint, end array<bigint>, last boolean, to array<bigint>")

    def starts(row: dict, carried):
        state = START if carried is None else carried
        return row["to"][state], {"part": row["part"], "end": row["end"], "last": row["last"], "state": state}

    begun = _per_conversation(to, starts, kind, ["conv_id", "part", "end", "last", "to"], "part bigint, end array<bigint>, last boolean, state bigint", [ids[1], ("end", longs), ("last", pa.bool_()), ("state", pa.int64())])

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, copies, end, state = row["codes"], np.frombuffer(row["copies"], np.int64).tolist(), tuple(row["end"]), row["state"]
                audit, repaired = _edited(row["repaired"], codes, copies, end, state, row["last"])
                own = vector(codes, copies, end)[state]
                after = row["to_state"]
                yield {c: row[c] for c in ("conv_id", "part", "turns", "min_turn", "max_turn")} | _stats(codes, copies) | {
                    "whole": False, "cost": own - (0 if row["last"] else end[after]), "audit": audit, "repaired": repaired,
                }

    states = begun.join(to.select("part", "to"), "part").withColumn("to_state", F.expr("to[int(state)]")).drop("to")
    final = open_.select("conv_id", "part", "turns", "min_turn", "max_turn", "repaired").join(light.select("part", "codes", "copies"), "part").join(states, "part")
    arrow_out = pa.schema([("conv_id", kind), *_ARROW])
    return final.mapInArrow(lambda b: _batches(emitted(b), arrow_out), f"conv_id {name}, {_RESULT}")


def repaired(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Rows (conv_id, part, whole, rows, blank, duplicate, truncated, illegal, first_role, last_role, turns, min_turn, max_turn, cost, audit, repaired).

    A conversation of usual length is one row (``whole``) with its repaired
    ``array<struct<role, text>>``; others have several, in the order of
    ``part``, whose counts and letters :func:`summary` puts together.  Rows of
    a conversation stand by turn (nulls first), those of one turn by role and
    text.  Null roles and texts are one blank; a null conv_id is a conversation
    of its own.  ``copies`` names a column that says how often a row stands
    there (0: not at all, but its conversation has a result).  Very long
    texts are read whole; an empty table has no rows; other columns aren't read.
    """
    blank = F.lit(" ")
    named = lambda c: F.col(f"`{c}`")
    rows = convs.select(
        named(conv_id).alias("conv_id"), named(turn).cast("bigint").alias("turn"), F.coalesce(named(role), blank).alias("role"), F.coalesce(named(text), blank).alias("text"),
        (named(copies).cast("bigint") if copies else F.lit(1).cast("bigint")).alias("copies"),
    )
    name = convs.schema[conv_id].dataType.simpleString()
    kind = to_arrow_type(convs.schema[conv_id].dataType)
    rows = rows.mapInArrow(_combined, f"conv_id {name}, turn bigint, role string, text string, copies bigint")
    ordered = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    found = common.written(ordered.mapInArrow(_cut(kind, part_rows), f"conv_id {name}, {_RESULT}{_OPEN}"), "conversation-parts")
    names = ["conv_id", *[a for a, _ in _ARROW]]
    return found.where("whole").select(*names).unionByName(common.written(_finish(found.where("not whole"), kind, name), "conversation-finished").select(*names))


def summary(parts: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Texts of conversations in one part stay where they are; of the others the
    parts are read in order, one at a time (a hash needs the order).
    """
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    joined = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    whole = parts.where("whole").select("conv_id", gaps, *counts, "audit", F.sha2(joined, 256).alias("repaired_sha256"))
    kind = to_arrow_type(parts.schema["conv_id"].dataType)
    arrow = pa.schema([("conv_id", kind), *[(c, pa.int64()) for c in ("gaps", *counts)], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, own = object(), None

        def row():
            lo, hi = own["min_turn"], own["max_turn"]
            return {c: own[c] for c in ("conv_id", *counts)} | {"gaps": hi - lo + 1 - own["turns"] if lo is not None else 0, "audit": "".join(own["letters"]), "repaired_sha256": own["hash"].hexdigest()}

        for batch in batches:
            for part in batch.to_pylist():
                if part["conv_id"] != conv:
                    if own:
                        yield row()
                    conv = part["conv_id"]
                    own = {"conv_id": conv, "turns": 0, "min_turn": None, "max_turn": None, "role": None, "letters": [], "hash": hashlib.sha256(), "any": False} | dict.fromkeys(counts, 0)
                for c in (*counts, "turns"):
                    own[c] += part[c]
                if own["role"] is not None and part["first_role"] is not None:
                    own["illegal"] += not legal(own["role"], part["first_role"])
                own["role"] = own["role"] if part["last_role"] is None else part["last_role"]
                if part["min_turn"] is not None:
                    own["turns"] -= own["max_turn"] == part["min_turn"]
                    own["min_turn"] = part["min_turn"] if own["min_turn"] is None else own["min_turn"]
                    own["max_turn"] = part["max_turn"]
                own["letters"].append(part["audit"])
                for r in part["repaired"]:
                    own["hash"].update((("\n" if own["any"] else "") + r["role"] + ":" + r["text"]).encode("utf-8", "surrogatepass"))
                    own["any"] = True
        if own:
            yield row()

    columns = ["conv_id", "part", *counts, "turns", "min_turn", "max_turn", "first_role", "last_role", "audit", "repaired"]
    split = parts.where("not whole").select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = ", ".join([f"conv_id {parts.schema['conv_id'].dataType.simpleString()}", *[f"{c} bigint" for c in ("gaps", *counts)], "audit string", "repaired_sha256 string"])
    return whole.unionByName(split.mapInArrow(lambda b: _batches(fold(b), arrow), schema))


def damaged(convs: DataFrame) -> DataFrame:
    """``convs`` with faults by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space): copies 0 or 2, text emptied or without ``.!?``, role user."""
    own = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(own.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return convs.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault.isin(0, 1), F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, F.lit(0)).when(fault == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def _cost(state: str, more: str, letter: str) -> str:
    """A state of the SQL version (12 digits of cost, then letters; null: impossible) after an edit."""
    return f"lpad(cast(cast(left({state}, 12) as bigint) + {more} as varchar), 12, '0') || substr({state}, 13) || '{letter}'"


def sql() -> str:
    """DuckDB SQL of the summary of the damaged ``conversations``: a forward recursion over rows."""
    step = "case when cut then 3 else 0 end"
    keep = lambda s, role: f"case when free and i = '{role}' then {_cost(s, step, 'K')} end"
    change = lambda s: f"case when free then {_cost(s, f'3 + {step}', 'R')} end"
    insert = lambda s: _cost(s, "3", "I")
    delete = lambda s: _cost(s, "4", "D")
    return f"""
with recursive
crc as (select list(c order by b) as t from (select b, list_reduce(range(8), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, b::bigint) as c from range(256) r(b))),
keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations),
fault as (select conv_id, turn, role, text, xor(list_reduce(range(1, length(k) + 1), lambda c, p: xor(c >> 8, t[(xor(c, ascii(k[p])::bigint) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 20 as f from keyed, crc),
damaged as (select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case when f = 1 then '' when f = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when f = 3 then 2 else 1 end)) as copy from fault where f <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n, left(role, 1) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as solid from damaged),
rows_ as (select *, solid = '' as is_blank, right(solid, 1) not in ('.', '!', '?') as cut, not (solid = '' or again) as free,
    lag(i) over (partition by conv_id order by n) || i as pair from placed),
stats as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where is_blank) as blank, count(*) filter (where not is_blank and again) as duplicate,
    count(*) filter (where free and cut) as truncated, count(*) filter (where n > 1 and pair not in ('su', 'ua', 'au')) as illegal, count(*) as total from rows_ group by conv_id),
dp as (select conv_id, 0 as n, '000000000000' as z, cast(null as varchar) as s, '000000000003I' as u, '000000000006II' as a from stats
  union all
  select conv_id, n, z, s, u, least(a, {insert('u')}) as a from (
    select conv_id, n, z, s, least(u, {insert('z')}, {insert('s')}, {insert('a')}) as u, a from (
      select d.conv_id, r.n, {delete('z')} as z, least({delete('s')}, {keep('z', 's')}) as s,
        least({delete('u')}, {keep('z', 'u')}, {keep('s', 'u')}, {keep('a', 'u')}, {change('z')}, {change('s')}, {change('a')}) as u,
        least({delete('a')}, {keep('u', 'a')}, {change('u')}) as a
      from dp d join rows_ r on d.conv_id is not distinct from r.conv_id and r.n = d.n + 1))),
best as (select d.conv_id, least(z, a) as x from dp d join stats t on d.conv_id is not distinct from t.conv_id and d.n = t.total),
letters as (select conv_id, substr(x, 13) as audit, cast(left(x, 12) as bigint) as cost from best),
walked as (select conv_id, p, audit[p] as c, length(replace(audit[1:p], 'I', '')) as n, length(replace(audit[1:p], 'D', '')) as o from (select conv_id, audit, unnest(range(1, length(audit) + 1)) as p from letters)),
out as (select w.conv_id, w.p, w.c, w.o, r.role, r.text, max(case when w.o = 1 and w.c = 'K' and r.i = 's' then 1 else 0 end) over (partition by w.conv_id) as lead
  from walked w left join rows_ r on w.conv_id is not distinct from r.conv_id and w.n = r.n and w.c <> 'I' where w.c <> 'D'),
texts as (select conv_id, string_agg(case when c = 'K' then role when (o - lead) % 2 = 1 then 'user' else 'assistant' end || ':' || case when c = 'I' then '' else text end, chr(10) order by p) as whole from out group by conv_id)
select c.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank, cast(coalesce(duplicate, 0) as bigint) as duplicate, cast(coalesce(truncated, 0) as bigint) as truncated,
  cast(coalesce(illegal, 0) as bigint) as illegal, cast(coalesce(cost, 0) as bigint) as cost, coalesce(audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join stats t on c.conv_id is not distinct from t.conv_id left join letters l on c.conv_id is not distinct from l.conv_id left join texts x on c.conv_id is not distinct from x.conv_id"""
