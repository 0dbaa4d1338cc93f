"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, lang_id, licenses, line_dedup, mixing, passages, simhash, sliced, token_files, topk, toxicity, url_filter
from .common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


#: Shares of the expected tokens: somewhat less toxic and low-quality text than the corpus has.
SHARES = {"q1t0": 0.89, "q1t1": 0.045, "q0t0": 0.055, "q0t1": 0.01}


def tokenizer_path() -> str:
    """The public byte-level BPE file that is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents"), least_words=50, similarity=0.8)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.checksums(token_files.encoded(table(spark, sf_dir, "documents"), tokenizer_path()))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.found(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.like_documents(table(spark, sf_dir, "documents"), every=50, k=10)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judged(table(spark, sf_dir, "pages"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("strict_hits", "soft_hits")})


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = mixing.domain_of(table(spark, sf_dir, "labels"))
    return mixing.document_rates(table(spark, sf_dir, "documents"), domains, SHARES)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, max_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduped(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliced.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.summary(conversations.repaired(rows, copies="copies"))


_ALL = (
    op1_decontamination, op2_passages, op3_token_files, op4_toxicity, op5_licenses, op6_topk, op7_url_filter, op8_mixing, op9_simhash, op10_language,
    op11_line_dedup, op12_ranked_search, op13_conversation_repair,
)
QUERIES: dict[str, QueryFn] = {f.__name__: f for f in _ALL}
ORACLE: dict[str, str] = {"op7_url_filter": url_filter.sql(), "op11_line_dedup": line_dedup.sql(), "op12_ranked_search": sliced.sql(), "op13_conversation_repair": conversations.sql()}
