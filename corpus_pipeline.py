"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
and read again as the next stage's documents. All take documents with NULLs in any
column, texts that are empty or of any length, ties and repeated rows, and columns beyond
those of documents, which they leave out; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from badgeflow.llm.common import DOCUMENT_COLUMNS, stored, table
from badgeflow.llm.decontaminate import clean_documents
from badgeflow.llm.mixing import mix_documents
from badgeflow.llm.ngram_join import one_of_each
from badgeflow.llm.packing import pack
from badgeflow.llm.quality import good_documents, train


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, trained on those with labels.

    NULL and empty texts are scored as a text without characters; repeated rows are
    accepted or rejected alike.
    """
    return good_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest doc_id.

    Documents without words have no duplicates; of rows repeated with doc_id and text one
    stays, and rows without doc_id all stay.
    """
    return one_of_each(docs.select(*DOCUMENT_COLUMNS)).select(*DOCUMENT_COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs; those without words have none."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for, dealt to shards
    and in the shards' order.

    NULL is a source of its own; documents without words are read as often as their source
    as a whole; rows repeated as they are are drawn each by itself.
    """
    return mix_documents(docs).select(*DOCUMENT_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids, ready for training; NULL and empty texts are one end mark."""
    return pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("good", good),
    ("distinct", distinct),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("packed", packed),
]

# Best-fit packing, boosted tables and seeded draws have no SQL; tests/llm holds the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
