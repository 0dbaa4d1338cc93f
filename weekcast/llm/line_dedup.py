"""Line deduplication with two Bloom filters: lines that many documents share are dropped.

A line's key is the line without blanks (space, 9 to 13) at its ends, A-Z in lower case.

*Filters.*  Tasks hash the distinct keys of their rows; the hashes (8 bytes,
no text) go to shards by hash.  A shard streams them into two Bloom filters:
what finds all its bits in the once-seen filter sets them in the twice-seen
one, the rest goes to the once-seen one.  A key that two documents of
different batches hold, or two of one batch, is always in the twice-seen
filter.  That filter alone is broadcast; its size follows the number of
lines up to ``filter_bytes``.  Beyond this it holds more and more keys that
occur once: more digests are shuffled (24 bytes a line at worst, summed
map-side first) and the result is the same.

*Confirmation.*  Only keys in the twice-seen filter are shuffled, as 128-bit
digests with the number of their documents.  The sums are exact, as is the
choice of the first occurrence.

*Drop.*  The confirmed digests are broadcast if they fit ``broadcast_bytes``;
otherwise the suspected lines are joined with them and each document gets
the numbers of its lines to drop.  Texts are shuffled in that case alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .bytespans import LOWER, flat, hashes

#: Filter bits for each line; bits that a key sets.
BITS_A_LINE, PROBES = 8, 3
SHARDS = 512
FILTER_BYTES = 64 << 20
BROADCAST_BYTES = 64 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Lines:
    """The lines of some texts: ``raw`` spans in ``data``, key spans, text number, number in the text, hash of the key."""

    data: np.ndarray
    raw: tuple[np.ndarray, np.ndarray]
    key: tuple[np.ndarray, np.ndarray]
    doc: np.ndarray
    number: np.ndarray
    hash: np.ndarray
    counted: np.ndarray  # keys of at least the wanted number of code points

    @classmethod
    def of(cls, data: np.ndarray, at: np.ndarray, min_chars: int) -> Lines:
        end = np.flatnonzero(data == 10)
        per_doc = 1 + np.searchsorted(end, at[1:]) - np.searchsorted(end, at[:-1])
        doc = np.repeat(np.arange(len(at) - 1), per_doc)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        first, last = np.sort(np.concatenate([at[:-1], end + 1])), np.sort(np.concatenate([end, at[1:]]))
        solid = np.append(np.flatnonzero(~_BLANK[data]), len(data))
        a = np.minimum(solid[np.searchsorted(solid, first)], last)
        b = np.maximum(np.concatenate([[-1], solid])[np.searchsorted(solid, last)] + 1, a)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return cls(data, (first, last), (a, b), doc, number, hashes(data, a, b), points[b] - points[a] >= max(1, min_chars))

    def digests(self, some: np.ndarray) -> list[bytes]:
        low = LOWER[self.data].tobytes()
        return [xxhash.xxh3_128_digest(low[i:j]) for i, j in zip(self.key[0][some].tolist(), self.key[1][some].tolist())]


def _lines(column: pa.Array, min_chars: int) -> Iterator[tuple[int, int, Lines]]:
    data, at = flat(column)
    for i, j in common.by_size(np.diff(at).tolist()):
        yield i, j, Lines.of(data[at[i] : at[j]], at[i : j + 1] - at[i], min_chars)


def _places(h: np.ndarray, shards: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, PROBES places within the shard's filter) of each hash."""
    shift = np.uint64(64 - bits.bit_length() + 1)
    return ((h >> np.uint64(20)) % np.uint64(shards)).astype(np.int64), ((h[:, None] * _ODD[None, :PROBES]) >> shift).astype(np.int64)


def twice_seen(texts: DataFrame, min_chars: int, filter_bytes: int) -> tuple[np.ndarray, int, int]:
    """(packed filter bits, one row a shard; shards; bits a shard) of the keys that two documents may share."""
    own = F.coalesce(F.col("text"), F.lit(""))
    n = texts.agg(F.sum(F.octet_length(own) - F.octet_length(F.replace(own, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    shards = int(min(SHARDS, max(1, n * BITS_A_LINE >> 15)))
    wanted = min(n * BITS_A_LINE, filter_bytes * 8) // shards
    bits = 1 << max(10, int(wanted - 1).bit_length() if wanted > 1 else 10)
    while bits > 1 << 10 and bits * shards > filter_bytes * 8:
        bits >>= 1

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, x in _lines(batch.column(0), min_chars):
                order = np.lexsort((x.doc[x.counted], x.hash[x.counted]))
                h, doc = x.hash[x.counted][order], x.doc[x.counted][order]
                fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, bool)
                h = h[fresh]  # once for each document: at most two of a key need to go on
                third = np.concatenate([[False, False], h[2:] == h[:-2]]) if len(h) > 1 else np.zeros(len(h), bool)
                h = h[~third]
                shard = ((h >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                h, shard = h[order], shard[order]
                cut = np.flatnonzero(np.diff(shard, prepend=-1))
                packed = [part.tobytes() for part in np.split(h, cut[1:])] if len(h) else []
                yield pa.RecordBatch.from_arrays([pa.array(shard[cut].astype(np.int32)), pa.array(packed, pa.binary())], names=["shard", "hashes"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard after the other: its two filters are all that is held."""
        cur, once, twice = -1, None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([cur], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())], names=["shard", "bits"])

        for batch in batches:
            for shard, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard != cur:
                    if cur >= 0:
                        yield row()
                    cur, once, twice = shard, np.zeros(bits, bool), np.zeros(bits, bool)
                h, count = np.unique(np.frombuffer(packed, np.uint64), return_counts=True)
                places = _places(h, shards, bits)[1]
                seen = once[places].all(axis=1) | (count > 1)
                twice[places[seen].ravel()] = True
                once[places.ravel()] = True
        if cur >= 0:
            yield row()

    hashed = texts.select("text").mapInArrow(keys, "shard int, hashes binary")
    found = hashed.repartition("shard").sortWithinPartitions("shard").mapInArrow(fold, "shard int, bits binary").toArrow()  # filter_bytes at most
    table = np.zeros((shards, bits // 8), np.uint8)
    for shard, packed in zip(found["shard"].to_pylist(), found["bits"].to_pylist()):
        table[shard] = np.frombuffer(packed, np.uint8)
    return table, shards, bits


def shared_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text", first: bool = False, filter_bytes: int = FILTER_BYTES,
) -> tuple[DataFrame, object]:
    """(written table of the keys that at least ``min_docs`` documents hold, test for suspects).

    Rows (digest, hash, docs), with ``first`` also the least (id, line number) that holds the key (null ids last).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(twice_seen(rows, min_chars, filter_bytes))

    def suspected(x: Lines) -> np.ndarray:
        table, shards, bits = shared.value
        some = np.flatnonzero(x.counted)
        shard, places = _places(x.hash[some], shards, bits)
        return some[((table[shard[:, None], places >> 3] >> (7 - (places & 7))) & 1).astype(bool).all(axis=1)]

    kind = docs.schema[id_col].dataType
    arrow = pa.schema([("digest", pa.binary()), ("hash", pa.int64()), ("docs", pa.int64())])
    schema = "digest binary, hash bigint, docs bigint"
    if first:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow, schema = arrow.append(pa.field("id", to_arrow_type(kind))).append(pa.field("line", pa.int64())), schema + f", id {kind.simpleString()}, line bigint"

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, x in _lines(batch.column(1), min_chars):
                some = suspected(x)
                some = some[np.lexsort((x.number[some], x.hash[some], x.doc[some]))]
                if len(some):  # a key counts once for each document, at its first line there
                    some = some[np.concatenate([[True], (np.diff(x.doc[some]) != 0) | (x.hash[some][1:] != x.hash[some][:-1])])]
                ids = batch.column(0).slice(i, j - i).to_pylist() if first else None
                found: dict[bytes, list] = {}
                for d, h, doc, line in zip(x.digests(some), x.hash[some].view(np.int64).tolist(), x.doc[some].tolist(), x.number[some].tolist()):
                    own = found.setdefault(d, [d, h, 0])
                    own[2] += 1
                    if first:
                        if len(own) == 3 or (ids[doc] is None, ids[doc], line) < (own[3] is None, own[3], own[4]):
                            own[3:] = [ids[doc], line]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found.values()), arrow)], schema=arrow)

    sums = [F.min("hash").alias("hash"), F.sum("docs").alias("docs")]
    if first:
        sums.append(F.min(F.struct(F.col("id").isNull(), "id", "line")).alias("first"))
    found = rows.mapInArrow(suspects, schema).groupBy("digest").agg(*sums).where(F.col("docs") >= min_docs)
    if first:
        found = found.select("digest", "hash", "docs", F.col("first.id").alias("first_id"), F.col("first.line").alias("first_line"))
    return common.written(found, "shared-lines"), suspected


def deduped(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none", id_col: str = "doc_id", text_col: str = "text",
    filter_bytes: int = FILTER_BYTES, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of ``docs`` without the lines that at least ``min_docs`` documents hold, with n_lines (before) and n_dropped.

    ``keep="first"`` leaves each such key's first occurrence, by id and line
    number (null ids last; rows that share this id all keep that line).  Keys
    below ``min_chars`` code points (at least 1) always stay.  A document
    counts once for a key however often it holds it; repeated rows are
    documents of their own, whatever their id.  A null or empty text is one
    empty line, and its text is empty afterwards; a text that loses all lines
    is empty too.  Texts of any length are read whole, one at a time beyond
    a million bytes.  An empty table has no rows.  Other columns are carried
    along; such named n_lines or n_dropped are replaced.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep is none or first, not {keep!r}")
    first = keep == "first"
    shared, suspected = shared_lines(docs, min_docs, min_chars, id_col, text_col, first, filter_bytes)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    own = docs.select(*[F.col(f"`{c}`") for c in names])
    fields = [f if f.name != text_col else T.StructField(text_col, T.StringType()) for f in own.schema.fields]
    out = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    id_at, text_at = names.index(id_col), names.index(text_col)

    def without(batches: Iterator[pa.RecordBatch], drop) -> Iterator[pa.RecordBatch]:
        """``drop(batch, i, lines)`` marks the lines to drop in rows from i on."""
        for batch in batches:
            for i, j, x in _lines(batch.column(text_at), min_chars):
                part = batch.slice(i, j - i)
                gone = drop(part, x)
                n = np.bincount(x.doc, minlength=j - i)
                lost = np.bincount(x.doc[gone], minlength=j - i)
                texts = part.column(text_at).fill_null("")
                if gone.any():
                    at = np.concatenate([[0], np.cumsum(n)])
                    whole, new = x.data.tobytes(), texts.to_pylist()
                    for d in np.flatnonzero(lost).tolist():
                        stay = at[d] + np.flatnonzero(~gone[at[d] : at[d + 1]])
                        new[d] = b"\n".join(whole[a:b] for a, b in zip(x.raw[0][stay].tolist(), x.raw[1][stay].tolist())).decode("utf-8", "surrogatepass")
                    texts = pa.array(new, pa.string())
                columns = [texts if k == text_at else part.column(k) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(lost)], names=[*names, "n_lines", "n_dropped"])

    if shared.count() * 64 <= broadcast_bytes:
        table = shared.toArrow()  # at most broadcast_bytes
        sorted_hashes = np.unique(np.asarray(table["hash"]).view(np.uint64)) if table.num_rows else np.zeros(0, np.uint64)
        place = [(a, b) for a, b in zip(table["first_id"].to_pylist(), table["first_line"].to_pylist())] if first else [None] * table.num_rows
        known = docs.sparkSession.sparkContext.broadcast((sorted_hashes, dict(zip(table["digest"].to_pylist(), place))))

        def confirmed(part: pa.RecordBatch, x: Lines) -> np.ndarray:
            every, digests = known.value
            gone = np.zeros(len(x.doc), bool)
            if not len(every):
                return gone
            some = np.flatnonzero(x.counted & (every[np.minimum(np.searchsorted(every, x.hash), len(every) - 1)] == x.hash))
            ids = part.column(id_at).to_pylist() if first else None
            for k, d in zip(some.tolist(), x.digests(some)):
                gone[k] = d in digests and not (first and digests[d] == (ids[x.doc[k]], x.number[k]))
            return gone

        return own.mapInArrow(lambda batches: without(batches, confirmed), out)

    # too many shared lines for a broadcast: they are joined with the suspected lines, and the texts with the numbers of their lines
    mark = F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))
    kind = docs.schema[id_col].dataType.simpleString()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, x in _lines(batch.column(2), min_chars):
                some = suspected(x)
                rows = pa.array(i + x.doc[some])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(x.number[some]), pa.array(x.digests(some), pa.binary())], names=["_id", "_mark", "_line", "digest"])

    lines = docs.select(F.col(f"`{id_col}`").alias("_id"), mark.alias("_mark"), F.col(f"`{text_col}`").alias("_text")).mapInArrow(places, f"_id {kind}, _mark string, _line bigint, digest binary")
    gone = lines.join(shared, "digest")
    if first:
        gone = gone.where(~(F.col("_id").eqNullSafe(F.col("first_id")) & (F.col("_line") == F.col("first_line"))))
    numbers = gone.groupBy("_id", "_mark").agg(F.collect_set("_line").alias("_gone"))
    both = own.join(numbers, own[f"`{id_col}`"].eqNullSafe(numbers["_id"]) & (mark == numbers["_mark"]), "left").select(*[own[f"`{c}`"] for c in names], numbers["_gone"])

    def listed(part: pa.RecordBatch, x: Lines) -> np.ndarray:
        gone = np.zeros(len(x.doc), bool)
        start = np.searchsorted(x.doc, np.arange(part.num_rows))
        for d, numbers in enumerate(part.column(len(names)).to_pylist()):
            if numbers:
                gone[start[d] + np.array(numbers)] = True
        return gone

    return both.mapInArrow(lambda batches: without(batches, listed), out)


def sql(min_docs: int = 10, table: str = "documents") -> str:
    """DuckDB SQL of the digest columns (doc_id, n_lines, n_dropped, kept_sha256)."""
    return f"""
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from {table}),
l as (select r, doc_id, unnest(parts) as line, unnest(range(len(parts))) as i from d),
k as (select *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
s as (select key from k where key <> '' group by key having count(distinct r) >= {min_docs})
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(s.key) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where s.key is null), '')) as kept_sha256
from k left join s on k.key = s.key group by r, doc_id"""
