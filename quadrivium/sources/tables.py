"""Readers, writers and fixed dimension tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrivium import constants as C
from quadrivium.sources import schemas


def question_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(C.QUESTION_CODES.items()), schemas.QUESTION_DIM)


def template_dim(spark: SparkSession, templates: list[str] | None = None) -> DataFrame:
    """Templates with the one placeholder each of them names (null for none)."""
    rows = []
    for number, template in enumerate(C.SEED_TEMPLATES if templates is None else templates):
        field = re.search(r"\{([a-z_]+)\}", template)
        rows.append((number, template, field.group(1) if field else None))
    return spark.createDataFrame(rows, "template_id int, template string, placeholder string")


def topic_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in C.TOPICS], "topic string")


def list_documents(spark: SparkSession, path: str, suffix: str = ".pdf", name: str | None = None) -> DataFrame:
    """(path, doc_id, bytes) of the files under a prefix, from what the listing says; contents are not read.

    The id is the file's name without the suffix, or the group of the pattern ``name`` in the path.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    last = F.replace(F.element_at(F.split("path", "/"), -1), F.lit(suffix), F.lit(""))
    doc_id = last if name is None else F.regexp_extract("path", name, 1)
    return files.select("path", doc_id.alias("doc_id"), F.col("length").alias("bytes"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def _one_line(value: Column) -> Column:
    """A text without line breaks: backslash, line feed and carriage return as two characters each."""
    return F.replace(F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _many_lines(value: Column) -> Column:
    """The text that ``_one_line`` was given."""
    lines = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.array_join(F.transform(F.split(value, r"\\\\"), lines), "\\")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, foreign: bool = False) -> DataFrame:
    """CSV written by :func:`write_csv`: a record is a line, so one large file is read by many tasks.

    ``foreign`` files may hold quoted line breaks and are read by one task each.
    """
    rows = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", foreign).csv(path)
    if foreign:
        return rows
    text_columns = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return rows.select(*[_many_lines(F.col(c)).alias(c) if c in text_columns else F.col(c) for c in rows.columns])


def read_training_csv(spark: SparkSession, path: str, keep: list[str] | None = None) -> DataFrame:
    """Training rows without nulls and empty fields, which CSV does not tell apart; optionally only some columns."""
    rows = read_csv(spark, path, schemas.TRAINING)
    rows = rows.replace("", None).dropna("any")
    return rows.drop(*[c for c in rows.columns if keep and c not in keep])


def training_scan(df: DataFrame, limit: int | None = None, order: list[str | Column] | None = None) -> DataFrame:
    """Training rows with ``question`` renamed to ``query``; the limit takes a stable order."""
    if limit is not None:
        df = df.orderBy(*(order or df.columns)).limit(limit)
    return df.withColumnRenamed("question", "query")


def write_csv(df: DataFrame, path: str, quote_all: bool = True, mode: str = "overwrite") -> None:
    """CSV with a header; nulls become empty, quotes inside fields are doubled, line breaks are escaped (see ``read_csv``)."""
    out = df.select(*[_one_line(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in df.columns])
    out.write.mode(mode).option("header", True).option("quoteAll", quote_all).option("escape", '"').csv(path)


def load_append(spark: SparkSession, csv_path: str, schema: T.StructType, table_path: str) -> None:
    read_csv(spark, csv_path, schema).write.mode("append").parquet(table_path)


def load_overwrite(spark: SparkSession, csv_path: str, schema: T.StructType, table_path: str) -> None:
    read_csv(spark, csv_path, schema).write.mode("overwrite").parquet(table_path)


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One string column as text lines (the JSONL sink)."""
    df.select(df.columns[0]).write.mode(mode).text(path)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail on an empty frame; reads at most one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df
