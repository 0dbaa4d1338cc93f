"""The pipeline against a brute-force version of its stages, and its stages one by one."""

import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from weekcast.llm import common, decontaminate, lang_id, mixing, queries, simhash

from given import SF_SMALL
from test_simhash import classes, fingerprint
from test_token_files import library


def test_pipeline_equals_its_stages_by_hand(spark):
    got = corpus_pipeline.run(spark, SF_SMALL).orderBy("start").collect()
    docs = common.table(spark, SF_SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = lang_id.fit(docs)
    lang, score = model.predict([r.text or "" for r in rows.values()])
    kept = [i for i, x, s in zip(rows, lang, score) if x != "und" and s >= corpus_pipeline.LEAST_LANGUAGE_SHARE]
    root = classes(kept, [fingerprint(rows[i].text) for i in kept])
    kept = [i for i in kept if root[i] == i]
    items = common.table(spark, SF_SMALL, "benchmark").collect()
    found = decontaminate.Items.of([(r.item_id, r.text) for r in items]).hits([rows[i].text for i in kept], 0.6, 0.8)
    kept = [i for k, i in enumerate(kept) if k not in {h[0] for h in found}]
    left = docs.where(F.col("doc_id").isin(kept))
    rates = {r.doc_id: r.rate for r in mixing.document_rates(left, mixing.domain_of(common.table(spark, SF_SMALL, "labels")), queries.SHARES).collect()}
    chance = {r.doc_id: r.u for r in left.select("doc_id", common.share_below(9, "doc_id", "text").alias("u")).collect()}
    lib, start, want = library(), 0, []
    for i in sorted(kept):
        ids = np.array([*lib.encode(rows[i].text, add_special_tokens=False).ids, 2], "<u4")
        for _ in range(int(rates[i] + chance[i])):
            want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert [tuple(r) for r in got] == want


def test_stages_keep_the_columns_and_bear_odd_rows(spark, docs):
    named = [n for n, _ in corpus_pipeline.STAGES]
    assert named == ["language", "near_duplicates", "benchmark", "mix", "tokens"]
    real = common.table(spark, SF_SMALL, "documents")
    odd = [(100_000, None, None, None, None), (None, "The of and to", "en", "s", 1), (100_001, "", "en", "s", 0), (100_002, "12 !", None, "s", 4)]
    df = real.union(spark.createDataFrame(odd + odd, real.schema))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF_SMALL)
        assert out.columns == real.columns and out.count() > 0, name
        assert stage(spark, real.limit(0), SF_SMALL).count() == 0, name
    tokens = corpus_pipeline.STAGES[-1][1](spark, df, SF_SMALL)
    assert tokens.count() == df.count()


def test_language_stage_drops_what_has_no_language(spark, docs):
    df = common.table(spark, SF_SMALL, "documents")
    out = corpus_pipeline.language(spark, df, SF_SMALL)
    assert out.count() >= 0.99 * df.count()


def test_near_duplicate_stage_keeps_the_least_id(spark, docs):
    df = common.table(spark, SF_SMALL, "documents")
    ids = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, SF_SMALL).collect()}
    assert ids == {r.component_id for r in simhash.near_duplicates(df).collect()}
