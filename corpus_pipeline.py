"""From raw documents to token files: each stage calls one operator of ``weekcast.llm``.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weekcast.llm import common, decontaminate, lang_id, mixing, simhash, token_files
from weekcast.llm.queries import SHARES, tokenizer_path

#: Texts in which no language reaches this share of the letters are rejected.
LEAST_LANGUAGE_SHARE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; null and letterless texts go."""
    common.ship(spark)
    return lang_id.keep_identified(docs, LEAST_LANGUAGE_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest id."""
    common.ship(spark)
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a passage that holds a test item's question and answer."""
    hits = decontaminate.contaminated(docs, common.table(spark, sf_dir, "benchmark"))
    return decontaminate.without(docs, hits)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that the expected words of the domains meet the target shares."""
    return mixing.mixed(docs, mixing.domain_of(common.table(spark, sf_dir, "labels")), SHARES)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return what they hold of each document."""
    common.ship(spark)
    return token_files.checksums(token_files.encoded(docs, tokenizer_path()))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mix", mix), ("tokens", tokens)]

#: Learned models and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
