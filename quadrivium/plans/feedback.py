"""Page text to courses and reviews, for documents not seen before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.functions import text
from quadrivium.operators.keyed import first_per_key
from quadrivium.plans import quality
from quadrivium.session import cut_lineage

HEADER = ["crn", "course_code", "course_title", "instructor", "term"]


def new_documents(listing: DataFrame, known: DataFrame, limit: int | None = None) -> DataFrame:
    """Listed documents whose id is not a known crn; ``limit`` caps the known ids in crn order."""
    ids = known.select(F.col("crn").alias("doc_id")).distinct()
    if limit is not None:
        ids = ids.orderBy("doc_id").limit(limit)
    return listing.join(ids, "doc_id", "left_anti")


def parse_pages(pages: DataFrame) -> DataFrame:
    """Header struct (null on pages without one) and question blocks of every page."""
    empty = F.array().cast("array<struct<question:string,responses:array<string>>>")
    return pages.select(
        "doc_id",
        "page_num",
        text.page_header("page_text").alias("header"),
        F.coalesce(text.question_blocks("page_text"), empty).alias("blocks"),
    )


def document_headers(parsed: DataFrame) -> DataFrame:
    """One header per document: the last page that has one wins, '' where no page has."""
    last = F.max_by("header", F.when(F.col("header").isNotNull(), F.col("page_num")))
    heads = parsed.groupBy("doc_id").agg(last.alias("header"))
    return heads.select("doc_id", *[F.coalesce(F.col("header").getField(c), F.lit("")).alias(c) for c in HEADER])


def documents_to_tables(parsed: DataFrame, existing_courses: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(courses, reviews) of parsed pages.

    The first document of a crn gives the course row.  The header joins the pages before their
    responses are exploded; adaptive execution splits the pages of one very long document.
    """
    heads = document_headers(parsed)
    courses = first_per_key(heads, ["crn"], ["doc_id"]).select(*HEADER)
    if existing_courses is not None:
        courses = courses.join(existing_courses.select("crn").distinct(), "crn", "left_anti")
    pages = parsed.select("doc_id", "page_num", "blocks").join(heads.select("doc_id", "crn"), "doc_id")
    questions = pages.select("doc_id", "page_num", "crn", F.posexplode("blocks").alias("q_pos", "block"))
    responses = questions.select(
        "doc_id", "page_num", "crn", "q_pos", F.col("block.question").alias("question"),
        F.posexplode("block.responses").alias("r_pos", "response"),
    ).where(F.length("response") > 0)
    # the id depends on the position only, so a repeated task gives the same id
    review_id = F.md5(F.concat_ws("#", "doc_id", "page_num", "q_pos", "r_pos").cast("binary"))
    return courses, responses.select(review_id.alias("review_id"), "crn", "question", "response")


def clean_tables(courses: DataFrame, reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned titles and responses; null responses are dropped."""
    kept = quality.drop_null_responses(reviews).withColumn("response", text.clean_text("response"))
    return courses.withColumn("course_title", text.clean_text("course_title")), kept


@dataclass
class FeedbackTables:
    courses: DataFrame
    reviews: DataFrame
    unknown_reviews: DataFrame
    empty_crn_courses: DataFrame
    flagged_reviews: DataFrame
    counters: DataFrame


def ingest_feedback(
    pages: DataFrame, known: DataFrame | None = None, existing_courses: DataFrame | None = None, materialise: bool = False
) -> FeedbackTables:
    """The whole ingest as lazy frames; ``known`` holds the crns that were loaded before.

    ``materialise`` writes the parsed rows to the checkpoint folder first, for callers that use
    more than one of the frames: the pages are then parsed once.
    """
    if known is not None:
        ids = known.select(F.col("crn").alias("doc_id")).distinct()
        pages = pages.join(ids, "doc_id", "left_anti")
    raw_courses, raw_reviews = documents_to_tables(parse_pages(pages), existing_courses)
    if materialise:
        raw_courses, raw_reviews = cut_lineage(raw_courses), cut_lineage(raw_reviews)
    courses, cleaned = clean_tables(raw_courses, raw_reviews)
    reviews, flagged = quality.neutralise(cleaned, "response")
    return FeedbackTables(
        courses,
        reviews,
        quality.unknown_questions(reviews),
        quality.empty_crns(courses),
        flagged,
        quality.run_counters(raw_reviews, raw_courses),
    )
