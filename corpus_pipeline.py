"""From raw documents to packed sequences: a chain of stages, each over all that the one before it kept.

``run`` applies the stages one after the other.  A caller that writes each stage's result and reads it again, as the
stages expect on a cluster, gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrivium.llm import quality
from quadrivium.llm.exact_dedup import drop_copies
from quadrivium.llm.jobs import table, vocabulary
from quadrivium.llm.near_dedup import drop_near_duplicates
from quadrivium.llm.packing import pack_documents
from quadrivium.llm.secrets import redact
from quadrivium.session import cut_lineage

#: The stages learn, cluster and encode, which SQL cannot; tests hold them against plain Python.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    return quality.drop_rejected(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document with the smallest id."""
    return drop_near_duplicates(docs, words=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` follows the text."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0))) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 1024 tokens."""
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
