"""Driver tables in the roles of the catalog, review, log and training tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.session import spread

VECTOR_WIDTH = 64
PROMPT = "Asked:\n{query}\nIt's known:\n{content}\nAnswer in two sentences.\n"


TEXT_TABLES = ("documents", "pages", "conversations")  # heavy per row: regular expressions over whole texts


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(table) if name in TEXT_TABLES else table


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as courses: ten instructors, seven course codes, the first line as title."""
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("crn"),
        (1000 + F.col("doc_id") % 7).cast("string").alias("course_code"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("course_title"),
        F.concat(F.lit("prof "), (F.col("doc_id") % 10).cast("string")).alias("instructor"),
        F.col("source").alias("term"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as catalog rows."""
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("base_id"),
        "embedding",
        F.concat(F.lit("prof "), F.col("label").cast("string")).alias("faculty_name"),
        F.concat(F.lit("CS"), (1000 + F.col("vec_id") % 7).cast("string")).alias("subject_course"),
        F.concat(F.lit("Row: "), F.col("vec_id").cast("string"), F.lit("\nGroup: "), F.col("label").cast("string")).alias("content"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as reviews of the course with the conversation's id."""
    return read(spark, sf_dir, "conversations").select(
        F.concat(F.lpad(F.col("conv_id").cast("string"), 9, "0"), F.lit("-"), F.lpad(F.col("turn").cast("string"), 4, "0")).alias("review_id"),
        F.col("conv_id").cast("string").alias("crn"),
        F.col("role").alias("question"),
        F.col("text").alias("response"),
    )


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding read backwards, as the query vectors."""
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.reverse("embedding").alias("query_vector")
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as the interaction log."""
    return read(spark, sf_dir, "events").select(
        F.unix_timestamp("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("session_id"),
        F.col("event_type").alias("query"),
        F.col("props").alias("context"),
        F.concat(F.lit("answer "), F.col("event_id").cast("string")).alias("response"),
        F.when(F.col("value") > 10, F.col("value").cast("string")).alias("feedback"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("query_id"),
    )


def dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, query, context, response): all turns but the assistant's, with the assistant turn that follows or null."""
    turns = read(spark, sf_dir, "conversations")
    user = turns.where("role <> 'assistant'").select("conv_id", "turn", F.col("text").alias("query"))
    answer = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return user.join(answer, ["conv_id", "turn"], "left").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        "query",
        F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("context"),
        "response",
    )


# --- SQL twins -----------------------------------------------------------------------------

_WS = C.WHITESPACE.replace("'", "''")
_CLASS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_PUNCT = C.PUNCTUATION.replace("'", "''")


def sql_strip(x: str) -> str:
    return f"trim({x}, '{_WS}')"


def sql_clean(x: str) -> str:
    return f"lower(regexp_replace({sql_strip(x)}, '[^\\p{{L}}\\p{{N}}{_CLASS}!-/:-@\\[-`{{-~]', '', 'g'))"


def sql_flat(x: str) -> str:
    return f"translate({x}, chr(10) || chr(13) || chr(9), '   ')"


def sql_response(x: str) -> str:
    for pattern in C.CAPTION_PATTERNS:
        x = sql_strip(f"regexp_replace({x}, '(?is){pattern}', '', 'g')")
    return sql_flat(f"regexp_replace({sql_strip(x)}, '^\\p{{Nd}}+[{_CLASS}]*', '')")


def sql_plain(x: str) -> str:
    return f"translate({x}, '{_PUNCT}', '')"


def sql_words(x: str) -> str:
    return f"list_filter(string_split_regex(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


def sql_flag(x: str) -> str:
    return "(" + " OR ".join(f"contains(' ' || lower({x}) || ' ', ' {w} ')" for w in C.PRONOUNS) + ")"


COURSES = """courses AS (
  SELECT CAST(doc_id AS VARCHAR) AS crn, CAST(1000 + doc_id % 7 AS VARCHAR) AS course_code,
         split_part(text, chr(10), 1) AS course_title, 'prof ' || (doc_id % 10) AS instructor, source AS term
  FROM documents)"""
CATALOG = """catalog AS (
  SELECT vec_id AS base_id, embedding::DOUBLE[] AS embedding, 'prof ' || label AS faculty_name,
         'CS' || (1000 + vec_id % 7) AS subject_course,
         'Row: ' || vec_id || chr(10) || 'Group: ' || label AS content
  FROM embeddings)"""
REVIEWS = """reviews AS (
  SELECT lpad(CAST(conv_id AS VARCHAR), 9, '0') || '-' || lpad(CAST(turn AS VARCHAR), 4, '0') AS review_id,
         CAST(conv_id AS VARCHAR) AS crn, role AS question, text AS response
  FROM conversations)"""
QUERY_VECTORS = """query_vectors AS (
  SELECT vec_id AS query_id, list_reverse(embedding)::DOUBLE[] AS query_vector FROM embeddings)"""
INTERACTIONS = """interactions AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", CAST(user_id AS VARCHAR) AS session_id, event_type AS query,
         props AS context, 'answer ' || event_id AS response,
         CASE WHEN value > 10 THEN CAST(value AS VARCHAR) END AS feedback,
         lpad(CAST(event_id AS VARCHAR), 12, '0') AS query_id
  FROM events)"""
DIALOGUE = """dialogue AS (
  SELECT u.conv_id * 1000 + u.turn AS id, u.text AS query, 'conversation ' || u.conv_id AS context, a.text AS response
  FROM conversations u LEFT JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role <> 'assistant')"""
ANSWERED = "answered AS (SELECT * FROM dialogue WHERE response IS NOT NULL)"


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "
