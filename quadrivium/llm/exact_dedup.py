"""Exact deduplication by skew-safe combining, in DataFrame operations only.

1. Locally: every task groups its own rows by (salt, digest, whole text); Spark's partial aggregate does this
   before anything is sent.
2. Salted: equal texts meet within one of ``salts`` groups, so a text that fills a third of the table is spread.
3. Globally: the salt winners, at most ``salts`` rows per text, meet by (digest, whole text).

Each stage groups by the whole normalised text beside the digest, so two texts with one digest stay apart.  Documents
get their winner by digest alone where a digest has one text (all of them, for a sound digest), else by digest and text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrivium.llm.common import lower_ascii, marked_rows, whole_text
from quadrivium.session import cut_lineage

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per distinct normalised text: ``digest, text, keep_id, group_size``."""
    text = lower_ascii(whole_text(text_col))
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("_salt"),
        text.alias("_text"), F.col(id_col).alias("_id"),
    ).withColumn("_digest", digest(F.col("_text")))
    salted = rows.groupBy("_salt", "_digest", "_text").agg(F.max("_id").alias("_id"), F.count("*").alias("_n"))
    return salted.groupBy("_digest", "_text").agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: id, ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z.  Of equal texts the row with the largest id stays.  A null
    text counts as empty; empty texts are equal to each other.  A null id loses to any other; a group of null ids only
    has a null ``keep_id`` and keeps all its rows' ``kept`` true only where the id equals ``keep_id`` null-safely.
    Rows that repeat an id and a text are all returned, and are all kept if their id wins.  An empty table gives an
    empty result.  Other columns are ignored, whatever their names.
    """
    classes = text_classes(docs, id_col, text_col, salts, digest)
    lean = cut_lineage(classes.groupBy("_digest").agg(
        F.count("*").alias("_texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")))
    text = lower_ascii(whole_text(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    rows = rows.select("_id", "_text", digest(F.col("_text")).alias("_digest"), sha256(F.col("_text")).alias("text_sha256"))
    one = rows.drop("_text").join(lean.filter("_texts = 1"), "_digest")
    out = one.select("_id", "keep_id", "group_size", "text_sha256")
    if not lean.filter("_texts > 1").isEmpty():
        shared = rows.join(lean.filter("_texts > 1").select("_digest"), "_digest", "left_semi")
        out = out.unionByName(shared.join(classes, ["_digest", "_text"]).select(*out.columns))
    return out.select(
        F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class of equal texts, with all its columns: a row that ``exact_dedup`` keeps.

    Of rows that repeat the winning id in the class, null or not, ``marked_rows`` picks one.
    """
    kept = exact_dedup(docs, id_col, text_col).filter("kept").groupBy(
        F.col(id_col).alias("_kept_id"), F.unhex("text_sha256").alias("_kept_digest")).agg(F.count("*").alias("_n"))
    return marked_rows(docs, id_col, F.unhex(sha256(lower_ascii(whole_text(text_col)))), kept)
