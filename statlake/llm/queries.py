"""One query per corpus operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statlake.llm.common import table
from statlake.llm.divergence import ORACLE as DIVERGENCE_ORACLE
from statlake.llm.divergence import divergence_audit
from statlake.llm.fingerprints import edit_probe
from statlake.llm.language_id import language_report
from statlake.llm.line_dedup import without_duplicate_lines
from statlake.llm.mixing import mix_report
from statlake.llm.ngram_join import jaccard_groups
from statlake.llm.packing import pack_documents
from statlake.llm.quality import score_quality, train_quality
from statlake.llm.ranked_search import ORACLE as SEARCH_ORACLE
from statlake.llm.ranked_search import ranked_search
from statlake.llm.rules import ORACLE as RULE_ORACLE
from statlake.llm.rules import quality_rules
from statlake.llm.token_files import read_token_files, write_token_files
from statlake.llm.urls import ORACLE as URL_ORACLE
from statlake.llm.urls import judge_urls, labels_by_number
from statlake.llm.vector_search import ORACLE as VECTOR_ORACLE
from statlake.llm.vector_search import exact_top_k
from statlake.session import scratch_dir


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, byte_bpe(), end_id=2)
    return read_token_files(spark, path)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3.0)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), k=4, percent=85)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), policy="v2")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), byte_bpe(), capacity=1024, end_id=0)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, labels_by_number(pages, table(spark, sf_dir, "labels")))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_probe(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_duplicate_lines(docs, similarity=0.9, max_bits=3, min_words=5, complete=True)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(table(spark, sf_dir, "documents"), k=200, min_docs=3)


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_mixing": op2_mixing,
    "op3_ngram_join": op3_ngram_join,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_packing": op7_packing,
    "op8_url_filters": op8_url_filters,
    "op9_fingerprints": op9_fingerprints,
    "op10_line_dedup": op10_line_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_divergence": op12_divergence,
    "op13_vector_search": op13_vector_search,
}

ORACLE: dict[str, str] = {
    "op5_quality_rules": RULE_ORACLE,
    "op8_url_filters": URL_ORACLE,
    "op11_ranked_search": SEARCH_ORACLE,
    "op12_divergence": DIVERGENCE_ORACLE,
    "op13_vector_search": VECTOR_ORACLE,
}
