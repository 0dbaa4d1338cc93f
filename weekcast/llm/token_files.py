"""Token ids as Parquet files that can be read in part.

Every text is encoded whole with a public tokenizer file, an end id is
appended, and rows (doc_id, n_tokens, ids) are written in ascending order of
doc_id: one file for each range of ids, ``shard`` being its number and
``row`` the place of a row in it and ``begin`` the number of ids before it there.  The ids are a list column.  With ``encoding="dictionary"`` a column chunk holds a
dictionary of its ids and bit-packed references; with ``"delta"`` the page
format is version 2 with delta-packed integers.  Row groups and pages have
set sizes, and Parquet's page indexes (always written) let a reader skip
pages by doc_id, or read n_tokens without the ids.

A byte-level BPE never merges across a blank that follows a non-blank, so a
text is looked up blank-separated word by word in a memory of words that the
library has already encoded; other texts go to the library whole.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.session import shared_path

from . import common

ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.writer.version": "v1"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "v2"},
}
COLUMNS = "doc_id {}, n_tokens bigint, ids array<int>, shard int, row bigint, begin bigint"
#: Documents of one file at most, on average.
DOCS_PER_FILE = 100_000
#: Words that a task remembers; beyond that it starts anew.
WORDS_KEPT = 700_000
_PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,!]*)")


class _Odd(Exception):
    """A word with a blank of another kind: its text is encoded whole."""


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level BPE vocabularies write for bytes: printable ones as they are, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder(dict):
    """Memory from a word (with the blank before it) to its ids as little-endian bytes, filled by the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.blank = self.letters[ord(" ")]
        self.ends: dict[str, bytes] = {}

    def word(self, letters: str) -> bytes:
        """One pre-token, in the letters of the vocabulary."""
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def by_library(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, key: str) -> bytes:
        """A bare key is a word with the blank before it, "\\n..." one after a line end, " ..." the first of a text."""
        if not key:
            raise _Odd
        stem = key.rstrip(".,!")
        if stem.isascii() and stem.isalpha():  # most words: a pre-token of a blank and letters that are written as they are
            out = self[key] = self[stem] + self.part(key[len(stem) :]) if len(stem) < len(key) else self.word(self.blank + key)
            return out
        line, bare = ("\n", key[1:]) if key[0] == "\n" else ("", key[1:] if key[0] == " " else " " + key)
        if m := _PLAIN.fullmatch(bare):  # pre-tokens: a word of letters with its blank, then punctuation
            word, end = m.groups()
            if end or line:
                out = self.part(line) + self[word[1:] if word[0] == " " else " " + word] + self.part(end)
            else:
                out = self.word(word.encode().decode("latin-1").translate(self.letters))
        else:
            own = bare.lstrip(" ")
            if own and own.split() != [own]:
                raise _Odd
            out = self.by_library(line + bare)
        self[key] = out
        return out

    def part(self, text: str) -> bytes:
        """A line end, or punctuation."""
        if text and text not in self.ends:
            self.ends[text] = self.by_library(text)
        return self.ends.get(text, b"")

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if len(self) > WORDS_KEPT:
            self.clear()
        look, out = self.__getitem__, []
        lines = text.split("\n")
        try:
            for i, line in enumerate(lines):
                if not line and len(lines) > 1:
                    raise _Odd
                words = line.split(" ")
                first = words.pop(0)
                if i:
                    out.append(look("\n" + first))
                elif first:
                    out.append(look(" " + first))
                out.extend(map(look, words))
        except _Odd:
            return self.by_library(text)
        return b"".join(out)


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    """One for each Python worker: its memory serves all tasks that the worker runs."""
    return Encoder(path)


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    files: int | None = None, encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_bytes: int = 1 << 20,
) -> None:
    """Encode all texts and write the files under ``path``, in ascending order of the ids.

    Columns: doc_id, n_tokens, ids (with the end id), shard, row, begin.  A null or
    empty text has the end id alone; null ids come first; rows that repeat
    an id are all kept, in the order of a hash of their texts; texts of any
    length are encoded whole; an empty table gives files without rows; other
    columns are not read.  ``files``: as many as shuffles have parts, or
    one for every ``DOCS_PER_FILE`` documents if that is more.
    """
    n = files or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // DOCS_PER_FILE))
    # only the few columns are moved, and as text: smaller than their ids
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end, shard, row = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        begin = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.binary_length(texts).to_pylist()
            for i, j in common.by_size(sizes):
                found = [encoder.encode(t) + end for t in texts.slice(i, j - i).to_pylist()]
                count = np.array([len(x) // 4 for x in found], np.int64)
                flat = np.frombuffer(b"".join(found), "<i4")
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(flat))
                upto = begin + np.cumsum(count)
                place = pa.array([shard] * (j - i), pa.int32()), pa.array(np.arange(row, row + j - i)), pa.array(upto - count)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(count), lists, *place], names=["doc_id", "n_tokens", "ids", "shard", "row", "begin"])
                row, begin = row + j - i, int(upto[-1])

    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(encode, COLUMNS.format(kind))
    options = ENCODINGS[encoding] | {
        "compression": "zstd", "parquet.block.size": str(row_group_bytes), "parquet.page.size": str(page_bytes),
        "parquet.dictionary.page.size": str(4 << 20),
    }
    out.write.options(**options).parquet(path)


def read(spark, path: str, kind: str = "bigint") -> DataFrame:
    """The files: doc_id, n_tokens, ids, shard, row, begin.  Selecting or filtering columns reads their pages alone."""
    return spark.read.schema(COLUMNS.format(kind)).parquet(path)


def checksums(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start``: ids of all documents before it: those of its shard (stored
    with the row) and of earlier shards (one row for each, so bounded by
    the number of files).  The crc32 is over the ids as little-endian
    unsigned 32-bit integers.  Every row of the files has a result, also
    rows of one id or of texts of any length; files without rows have none.
    """

    @F.arrow_udf("bigint")
    def crc(lists: pa.Array) -> pa.Array:
        flat, at = np.asarray(lists.values).astype("<u4", copy=False), np.asarray(lists.offsets)
        return pa.array([zlib.crc32(flat[i:j]) for i, j in zip(at, at[1:])], pa.int64())

    total = files.groupBy("shard").agg(F.max(F.col("begin") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = total.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(base), "shard").select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", crc("ids").alias("ids_crc32"))


def encoded(docs: DataFrame, tokenizer: str, **writing) -> DataFrame:
    """Write the files in a new shared folder and read them back."""
    path = f"{shared_path(docs.sparkSession, 'llm')}/tokens-{uuid.uuid4().hex}"
    write(docs, path, tokenizer, **writing)
    return read(docs.sparkSession, path, docs.schema[writing.get("id_col", "doc_id")].dataType.simpleString())
