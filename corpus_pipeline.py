"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes what its predecessor kept, as written and reread Parquet, and
calls one operator of ``statlake.llm``. All but the last return the columns of
``documents``. No stage has SQL: the classifier is trained, lines and shingles are linked by
similarity, and the mix is drawn; ``tests/llm`` checks each operator against
brute force and the stages in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statlake.llm.common import table
from statlake.llm.line_dedup import without_duplicate_lines
from statlake.llm.mixing import mixed_documents
from statlake.llm.ngram_join import first_documents
from statlake.llm.packing import pack_documents
from statlake.llm.quality import good_documents, train_quality
from statlake.llm.queries import byte_bpe
from statlake.session import scratch_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    return good_documents(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less lines that repeat an earlier one; those left without a word go."""
    return without_duplicate_lines(docs, drop_emptied=True, counts=False, complete=True)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8)."""
    return first_documents(docs, k=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs, weights=(5, 2, 1), cap=3.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return pack_documents(docs, byte_bpe(), capacity=1024, end_id=0)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("mixing sources", source_mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
