"""op3: exact round trip against the library, order and starts, layout of the files."""

import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weekcast.llm import common, queries, token_files

from given import SF_SMALL

ODD = ["", "a", "a ", "  a", " \n a", "a\n\nb", "a\tb c", "it's don't", "x.!?,(y) _z_ 1.5,3 v2.0.", "a\u00a0b c", "día ß Ⅷ x² 北京", "<|endoftext|> a<|endoftext|>",
       "😀 a😀b", "\x1c a\x1cb", "a.'s b!'ll", "a\r\nb\r\n", "x \t y", "\u2028 a", "Ünder. THE,!! end.\n"]


def library():
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_encoder_equals_library():
    enc, lib = token_files.Encoder(queries.tokenizer_path()), library()
    for t in ODD + [a + b for a in ODD for b in ODD]:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_plain_words_are_told_without_a_pattern(monkeypatch):
    """Words of A-Z with their punctuation, most of a text, take the short way; the ids are the library's."""

    class Never:
        def fullmatch(self, text):
            raise AssertionError(text)

    enc, lib = token_files.Encoder(queries.tokenizer_path()), library()
    monkeypatch.setattr(token_files, "_PLAIN", Never())
    text = " said nothing, Haanth. Reoush! enbeschst.,!! A a. ZZZ,a".rsplit(",", 1)[0]
    words = text.split(" ")[1:]
    assert np.frombuffer(b"".join(map(enc.__getitem__, words)), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_digest_of_the_given_table(spark):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op3_token_files(spark, SF_SMALL).collect()}
    lib, start = library(), 0
    rows = common.table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()
    for r in rows:
        ids = np.array([*lib.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        assert got[r.doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(rows)


def test_edge_cases_and_layout(spark, docs, tmp_path):
    rows = [(5, "b c"), (3, None), (4, ""), (5, "b c"), (5, "a"), (None, "x"), (9, "word " * 50_000)]
    path = str(tmp_path / "t")
    for encoding in token_files.ENCODINGS:
        token_files.write(docs(rows), f"{path}-{encoding}", queries.tokenizer_path(), files=3, encoding=encoding)
        files = token_files.read(spark, f"{path}-{encoding}")
        found = files.orderBy("shard", "row").collect()
        assert [r.doc_id for r in found] == [None, 3, 4, 5, 5, 5, 9] and found[1].ids == [2]
        starts = token_files.checksums(files).orderBy("start").collect()
        assert [r.start for r in starts] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
        meta = pq.ParquetFile(max(glob.glob(f"{path}-{encoding}/*.parquet"), key=lambda f: pq.ParquetFile(f).metadata.num_rows)).metadata
        column = next(c for c in (meta.row_group(0).column(i) for i in range(meta.num_columns)) if c.path_in_schema.startswith("ids"))
        assert column.has_column_index and column.has_offset_index
        assert ("DELTA_BINARY_PACKED" in column.encodings) == (encoding == "delta")
        assert any("DICTIONARY" in e for e in column.encodings) == (encoding == "dictionary")
    assert token_files.checksums(token_files.encoded(docs([]), queries.tokenizer_path())).count() == 0
    plan = files.where(F.col("doc_id") == 5).select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in plan and "ids" not in plan.split("ReadSchema")[1]
