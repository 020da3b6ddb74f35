"""Catalog payloads (JSON and HTML text) to one enriched catalog table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrivium.functions import html, text
from quadrivium.plans.quality import split_missing_faculty
from quadrivium.sources import schemas
from quadrivium.sources.tables import require_rows

NO_DESCRIPTION = "No description available."
# Cell positions of the prerequisite table.
PREREQ_CELLS = {"and_or": 0, "subject": 4, "course_number": 5, "level": 6, "grade": 7}
PREREQ_TYPE = "array<struct<" + ",".join(f"{name}:string" for name in PREREQ_CELLS) + ">>"


def flatten_catalog(payloads: DataFrame, term: str | Column, column: str = "json") -> DataFrame:
    """Rows of the ``data`` list of each payload with blank columns for the enrichment."""
    rows = payloads.select(F.explode(F.from_json(column, schemas.CATALOG_PAYLOAD)["data"]).alias("c"))
    term = text.semester_name(F.lit(term) if isinstance(term, str) else term)
    filled = {
        "crn": F.col("c.courseReferenceNumber"),
        "campus_description": F.col("c.campusDescription"),
        "course_title": F.col("c.courseTitle"),
        "subject_course": F.col("c.subjectCourse"),
        "term": term,
    }
    return rows.select(*[filled.get(f.name, F.lit("")).alias(f.name) for f in schemas.CATALOG.fields])


def faculty_info(payloads: DataFrame) -> DataFrame:
    """First faculty name and first meeting of each (crn, json) payload."""
    first = F.get(F.from_json("json", schemas.FACULTY_PAYLOAD)["fmt"], F.lit(0))
    meeting = first["meetingTime"]
    blank = F.lit("")
    return payloads.select(
        "crn",
        F.coalesce(F.get(first["faculty"], F.lit(0))["displayName"], blank).alias("faculty_name"),
        F.coalesce(meeting["beginTime"], blank).alias("begin_time"),
        F.coalesce(meeting["endTime"], blank).alias("end_time"),
        text.meeting_days(meeting).alias("days"),
    )


def descriptions(payloads: DataFrame) -> DataFrame:
    """Description text of each (crn, html) payload."""
    section = html.element_text("html", "section", "aria-labelledby", "courseDescription")
    return payloads.select(
        "crn", F.coalesce(text.clean_response(section), F.lit(NO_DESCRIPTION)).alias("course_description")
    )


def prerequisites(payloads: DataFrame) -> DataFrame:
    """Prerequisite list of each (crn, html) payload."""
    return payloads.select("crn", html.table_rows("html", "basePreqTable", PREREQ_CELLS).alias("prereq"))


def enrich(catalog: DataFrame, faculty: DataFrame, description: DataFrame, prereq: DataFrame) -> DataFrame:
    """Left joins on crn; a course without a payload keeps its row with '' or an empty list.

    Descriptions are texts, many times the size of the files they come compressed from, so they are shuffled by crn
    and not broadcast by an estimate.
    """
    base = catalog.drop("faculty_name", "begin_time", "end_time", "days", "course_description", "prereq")
    joined = base.join(faculty, "crn", "left").join(description.hint("merge"), "crn", "left").join(prereq, "crn", "left")
    blank, none = F.lit(""), F.array().cast(PREREQ_TYPE)
    return joined.select(
        *[
            (F.coalesce("prereq", none) if f.name == "prereq" else
             F.coalesce(f.name, blank) if f.name not in base.columns else F.col(f.name)).alias(f.name)
            for f in schemas.CATALOG.fields
        ]
    )


def publishable(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a faculty name, ready for CSV; report of the rows without)."""
    kept, missing = split_missing_faculty(require_rows(catalog, "the catalog is empty"))
    flat = text.flatten_lines(F.to_json("prereq"))
    return kept.withColumn("prereq", flat).fillna(""), missing
