"""Feedback ingest, incremental selection and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.functions import text
from quadrivium.operators import keyed
from quadrivium.plans import feedback, quality
from quadrivium.workloads import tables as t

_CODES = {code: question for question, code in C.QUESTION_CODES.items()}


def _pages(spark, sf):
    """Every conversation as a document, every turn as a page; the first turn carries the header."""
    header = F.concat(
        F.lit("Topic "), F.col("conv_id").cast("string"), F.lit(" (Fall "), (2000 + F.col("conv_id") % 20).cast("string"),
        F.lit(")\nCourse ID: "), (F.col("conv_id") % 50).cast("string"), F.lit("\nInstructor: "), F.col("role"),
        F.lit("\nCatalog & Section: "), (1000 + F.col("conv_id") % 7).cast("string"), F.lit(" 01\n"),
    )
    question = (
        F.when(F.col("role") == "user", F.lit(_CODES["Q1"])).when(F.col("role") == "assistant", F.lit(_CODES["Q2"])).otherwise(F.lit("Other?"))
    )
    page = F.concat(
        F.when(F.col("turn") == 0, header).otherwise(F.lit("")),
        F.lit("Q: "), question, F.lit("\n1\n"), F.col("text"), F.lit("\n2\nThanks, she said\n"),
    )
    return t.read(spark, sf, "conversations").select(
        F.lpad(F.col("conv_id").cast("string"), 9, "0").alias("doc_id"), F.col("turn").cast("int").alias("page_num"), page.alias("page_text")
    )


def feedback_ingest(spark, sf):
    reviews = feedback.ingest_feedback(_pages(spark, sf)).reviews
    return reviews.select("crn", "question", "response")


def first_course_per_crn(spark, sf):
    return feedback.ingest_feedback(_pages(spark, sf)).courses


def review_ids(spark, sf):
    return feedback.ingest_feedback(_pages(spark, sf)).reviews.select("review_id", "crn")


def flagged_reviews(spark, sf):
    return feedback.ingest_feedback(_pages(spark, sf)).flagged_reviews


def ingest_counters(spark, sf):
    return feedback.ingest_feedback(_pages(spark, sf)).counters


def last_header_per_document(spark, sf):
    """Every turn with a header: the last one wins."""
    lines = F.concat(
        F.lit("Part "), F.col("turn").cast("string"), F.lit(" (T)\nCourse ID: "), F.col("conv_id").cast("string"),
        F.lit("\nInstructor: "), F.col("role"), F.lit("\nCatalog & Section: 5 01\n"),
    )
    pages = t.read(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").cast("int").alias("page_num"),
        F.when(F.col("role") != "assistant", lines).otherwise(F.col("text")).alias("page_text"),
    )
    return feedback.document_headers(feedback.parse_pages(pages))


def _reviews_with_gaps(spark, sf):
    return t.reviews(spark, sf).withColumn("response", F.when(F.col("question") != "user", F.col("response")))


def null_split(spark, sf):
    return quality.drop_null_responses(_reviews_with_gaps(spark, sf))


def question_lookup(spark, sf):
    question = F.when(F.col("role") == "user", F.lit(_CODES["Q3"])).otherwise(F.col("role"))
    return t.read(spark, sf, "conversations").select("conv_id", "turn", text.question_code(question).alias("code"))


def unknown_split(spark, sf):
    reviews = t.reviews(spark, sf).withColumn("question", text.question_code(F.when(F.col("question") == "user", F.lit(_CODES["Q1"])).otherwise(F.lit("?"))))
    return quality.unknown_questions(reviews).select("review_id", "crn", "question")


def empty_crn_split(spark, sf):
    courses = t.courses(spark, sf).withColumn("crn", F.when(F.col("term") == "src3", F.lit("")).otherwise(F.col("crn")))
    return quality.empty_crns(courses)


def run_counters(spark, sf):
    return quality.run_counters(_reviews_with_gaps(spark, sf), t.courses(spark, sf))


def run_lookup(spark, sf):
    """orders as run states: one run per customer, one state per order."""
    runs = t.read(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("run_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("raw_reviews_count"), F.timestamp_seconds(F.col("o_orderkey")).alias("timestamp"),
    )
    return quality.run_lookup(runs)


def _known(spark, sf):
    return t.read(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("crn"))


def _listing(spark, sf):
    return t.read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "source", "n_chars")


def new_documents_anti(spark, sf):
    return feedback.new_documents(_listing(spark, sf), _known(spark, sf))


def known_crns_limited(spark, sf):
    """The first forty known ids in order; documents known beyond them are listed again."""
    return feedback.new_documents(_listing(spark, sf), _known(spark, sf), limit=40)


def new_documents_semi(spark, sf):
    known = _known(spark, sf).withColumnRenamed("crn", "doc_id").distinct()
    return _listing(spark, sf).join(known, "doc_id", "left_semi")


def growth_trigger(spark, sf):
    listing = _listing(spark, sf)
    return quality.growth_trigger(feedback.new_documents(listing, _known(spark, sf)), _known(spark, sf).distinct())


def distinct_crns(spark, sf):
    return t.reviews(spark, sf).select("crn").distinct()


def merged_batches(spark, sf):
    """Rows of two sources as one table, the first of equal crns kept."""
    one = t.courses(spark, sf).select("crn", "instructor", F.lit(0).alias("origin"))
    two = t.reviews(spark, sf).select("crn", F.col("question").alias("instructor"), F.lit(1).alias("origin")).distinct()
    return keyed.first_per_key(one.unionByName(two), ["crn"], ["origin", "instructor"])


QUERIES = {
    f.__name__: f
    for f in [
        feedback_ingest, first_course_per_crn, review_ids, flagged_reviews, ingest_counters, last_header_per_document, null_split,
        question_lookup, unknown_split, empty_crn_split, run_counters, run_lookup, new_documents_anti, known_crns_limited,
        new_documents_semi, growth_trigger, distinct_crns, merged_batches,
    ]
}

# one line: cleaned and stripped again; lines of a turn joined by blanks, the index number dropped
_line = t.sql_strip(t.sql_clean("x"))
_joined = f"array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_line}), ' ')"
_response = t.sql_response(f"' 1 ' || {_joined}")
_RAW = f"""raw AS (
  SELECT conv_id, turn, CAST(conv_id % 50 AS VARCHAR) AS crn,
         CASE role WHEN 'user' THEN 'Q1' WHEN 'assistant' THEN 'Q2' ELSE 'unknown' END AS question,
         {_response} AS response, 0 AS r_pos FROM conversations
  UNION ALL
  SELECT conv_id, turn, CAST(conv_id % 50 AS VARCHAR),
         CASE role WHEN 'user' THEN 'Q1' WHEN 'assistant' THEN 'Q2' ELSE 'unknown' END, 'thanks, she said ', 1 FROM conversations)"""


def _neutral(x: str) -> str:
    out = f"' ' || {x} || ' '"
    for word in C.PRONOUNS:
        out = f"replace({out}, ' {word} ', ' {C.NEUTRAL_TERM} ')"
    return out


_flag = t.sql_flag


_CLEANED = f"cleaned AS (SELECT conv_id, turn, r_pos, crn, question, {t.sql_clean('response')} AS response FROM raw WHERE length(response) > 0)"
_id = "md5(lpad(CAST(conv_id AS VARCHAR), 9, '0') || '#' || turn || '#0#' || r_pos)"
_GAPS = t.REVIEWS + ", gaps AS (SELECT review_id, crn, question, CASE WHEN question <> 'user' THEN response END AS response FROM reviews)"

SQL = {
    "feedback_ingest": t.with_(_RAW, _CLEANED)
    + f"SELECT crn, question, CASE WHEN {_flag('response')} THEN {t.sql_strip(_neutral('response'))} ELSE response END AS response FROM cleaned",
    "first_course_per_crn": """
        WITH heads AS (SELECT conv_id, CAST(conv_id % 50 AS VARCHAR) AS crn, CAST(1000 + conv_id % 7 AS VARCHAR) AS course_code,
                       'topic ' || conv_id AS course_title, role AS instructor, 'Fall ' || (2000 + conv_id % 20) AS term
                       FROM conversations WHERE turn = 0)
        SELECT crn, course_code, course_title, instructor, term FROM heads
        QUALIFY row_number() OVER (PARTITION BY crn ORDER BY conv_id) = 1""",
    "review_ids": t.with_(_RAW) + f"SELECT {_id} AS review_id, crn FROM raw WHERE length(response) > 0",
    "flagged_reviews": t.with_(_RAW, _CLEANED) + f"SELECT crn, question, response FROM cleaned WHERE {_flag('response')}",
    "ingest_counters": t.with_(_RAW, _CLEANED) + f"""
        SELECT count(*) AS raw_reviews_count, (SELECT count(DISTINCT crn) FROM raw) AS raw_courses_count,
               count(*) AS processed_reviews_count, (SELECT count(DISTINCT crn) FROM raw) AS processed_courses_count,
               CAST(0 AS BIGINT) AS null_responses_removed, count(*) FILTER (WHERE {_flag('response')}) AS sensitive_data_flags FROM cleaned""",
    "last_header_per_document": """
        WITH h AS (SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n
                   FROM conversations WHERE role <> 'assistant'),
        d AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT CAST(d.conv_id AS VARCHAR) AS doc_id, CASE WHEN h.conv_id IS NULL THEN '' ELSE CAST(d.conv_id AS VARCHAR) END AS crn,
               CASE WHEN h.conv_id IS NULL THEN '' ELSE '5' END AS course_code,
               CASE WHEN h.conv_id IS NULL THEN '' ELSE 'Part ' || h.turn END AS course_title,
               coalesce(h.role, '') AS instructor, CASE WHEN h.conv_id IS NULL THEN '' ELSE 'T' END AS term
        FROM d LEFT JOIN h ON d.conv_id = h.conv_id AND h.n = 1""",
    "null_split": t.with_(_GAPS) + "SELECT review_id, crn, question, response FROM gaps WHERE response IS NOT NULL",
    "question_lookup": "SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'Q3' ELSE 'unknown' END AS code FROM conversations",
    "unknown_split": t.with_(t.REVIEWS) + "SELECT review_id, crn, 'unknown' AS question FROM reviews WHERE question <> 'user'",
    "empty_crn_split": t.with_(t.COURSES) + "SELECT '' AS crn, course_code, course_title, instructor, term FROM courses WHERE term = 'src3'",
    "run_counters": t.with_(_GAPS) + f"""
        SELECT count(*) AS raw_reviews_count, (SELECT count(*) FROM documents) AS raw_courses_count,
               count(response) AS processed_reviews_count, (SELECT count(*) FROM documents) AS processed_courses_count,
               count(*) FILTER (WHERE response IS NULL) AS null_responses_removed,
               count(*) FILTER (WHERE {_flag(t.sql_clean('response'))}) AS sensitive_data_flags FROM gaps""",
    "run_lookup": """
        SELECT CAST(o_custkey AS VARCHAR) AS run_id, make_timestamp(min(o_orderkey) * 1000000) AS start_time,
               make_timestamp(max(o_orderkey) * 1000000) AS end_time, arg_max(o_orderstatus, o_orderkey) AS status,
               max(o_orderkey) AS raw_reviews_count FROM orders GROUP BY o_custkey""",
    "new_documents_anti": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "known_crns_limited": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, n_chars FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN
        (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS c FROM labels ORDER BY c LIMIT 40)""",
    "new_documents_semi": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, n_chars FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "growth_trigger": """WITH n AS (SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS new_rows,
        (SELECT count(DISTINCT doc_id) FROM labels) AS existing_rows)
        SELECT new_rows, existing_rows, new_rows > 0.1 * existing_rows AS triggered FROM n""",
    "distinct_crns": "SELECT DISTINCT CAST(conv_id AS VARCHAR) AS crn FROM conversations",
    "merged_batches": t.with_(t.COURSES, t.REVIEWS) + """
        , merged AS (SELECT crn, instructor, CAST(0 AS INT) AS origin FROM courses UNION ALL SELECT DISTINCT crn, question, 1 FROM reviews)
        SELECT crn, instructor, origin FROM merged QUALIFY row_number() OVER (PARTITION BY crn ORDER BY origin, instructor) = 1""",
}
