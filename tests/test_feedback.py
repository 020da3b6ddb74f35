from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.plans import feedback, quality
from quadrivium.sources import schemas
from quadrivium.streaming import feedback as stream

Q1, Q2 = list(C.QUESTION_CODES)[:2]
PAGE_1 = (
    "Course Title (Fall 2024)\nCourse ID: 12345\nInstructor: Jo Doe\nCatalog & Section: CS5010 01\n"
    f"Q: {Q1}\n1\nGreat lectures\n2\nClear slides\nQ: {Q2}\n1\nMore examples"
)
PAGE_2 = f"Page two\nQ: {Q2}\n2\nFewer quizzes"


def pages(spark, rows):
    return spark.createDataFrame(rows, schemas.PAGES)


def test_two_page_document(spark):
    courses, reviews = feedback.documents_to_tables(feedback.parse_pages(pages(spark, [("d", 0, PAGE_1), ("d", 1, PAGE_2)])))
    assert [tuple(r) for r in courses.collect()] == [("12345", "CS5010", "Course Title", "Jo Doe", "Fall 2024")]
    assert sorted((r["question"], r["response"]) for r in reviews.collect()) == [
        ("Q1", "clear slides"), ("Q1", "great lectures"), ("Q2", "fewer quizzes"), ("Q2", "more examples"),
    ]
    assert {r["crn"] for r in reviews.collect()} == {"12345"}


def test_document_without_pages(spark):
    courses, reviews = feedback.documents_to_tables(feedback.parse_pages(pages(spark, [("d", None, None)])))
    assert [tuple(r) for r in courses.collect()] == [("", "", "", "", "")]
    assert reviews.count() == 0


def test_existing_course_keeps_its_row(spark):
    existing = spark.createDataFrame([("12345",)], "crn string")
    courses, reviews = feedback.documents_to_tables(feedback.parse_pages(pages(spark, [("d", 0, PAGE_1)])), existing)
    assert courses.count() == 0 and reviews.count() == 3


def test_first_document_of_a_crn_wins_and_last_header_of_a_document(spark):
    other = PAGE_1.replace("Jo Doe", "Al Roe")
    courses, _ = feedback.documents_to_tables(feedback.parse_pages(pages(spark, [("b", 0, PAGE_1), ("a", 0, PAGE_1), ("a", 1, other)])))
    assert [r["instructor"] for r in courses.collect()] == ["Al Roe"]


def test_header_bracket_in_title(spark):
    page = PAGE_1.replace("Course Title (Fall 2024)", "Topics (AI) X (Fall 2024)")
    heads = feedback.document_headers(feedback.parse_pages(pages(spark, [("d", 0, page)]))).first()
    assert (heads["course_title"], heads["term"]) == ("Topics", "AI) X")


def test_review_ids_are_stable_and_unique(spark):
    frame = pages(spark, [("d", 0, PAGE_1), ("e", 0, PAGE_1), ("d", 1, PAGE_2)])
    def ids(f):
        return sorted(r["review_id"] for r in feedback.documents_to_tables(feedback.parse_pages(f))[1].collect())
    assert ids(frame) == ids(frame.repartition(7)) and len(set(ids(frame))) == 7


def test_ingest_skips_known_and_counts(spark):
    page = PAGE_1.replace("Great lectures", "She is great")
    frame = pages(spark, [("d", 0, page), ("known", 0, PAGE_1), ("u", 0, "Q: Other?\n1\nhm")])
    known = spark.createDataFrame([("known",), ("known",)], "crn string")
    out = feedback.ingest_feedback(frame, known)
    assert out.reviews.count() == 4
    assert [r["response"] for r in out.flagged_reviews.collect()] == ["she is great"]
    assert "the professor is great" in [r["response"] for r in out.reviews.collect()]
    assert [r["response"] for r in out.unknown_reviews.collect()] == ["hm"]
    assert out.empty_crn_courses.count() == 1
    row = out.counters.first()
    assert (row["raw_reviews_count"], row["sensitive_data_flags"], row["null_responses_removed"]) == (4, 1, 0)


def test_quality_splits(spark, scratch):
    reviews = spark.createDataFrame([("1", "c", "Q1", None), ("2", "c", "unknown", "x he y"), ("3", "", "Q1", "")], schemas.REVIEWS)
    assert quality.drop_null_responses(reviews).count() == 2
    assert quality.unknown_questions(reviews).count() == 1
    fixed, touched = quality.neutralise(reviews, "response")
    assert touched.count() == 1 and fixed.count() == 3
    catalog = spark.createDataFrame([("1", "CS1", "T", None), ("2", "CS2", "T", ""), ("3", "CS3", "T", "A")], "crn string, subject_course string, term string, faculty_name string")
    kept, missing = quality.split_missing_faculty(catalog)
    assert [r["crn"] for r in kept.collect()] == ["3"]
    assert sorted(r["report_line"] for r in missing.collect())[0] == "CRN: 1, Course: CS1, Term: T"


def test_growth_and_limit(spark):
    existing = spark.range(10).select(F.col("id").cast("string").alias("crn"))
    assert quality.growth_trigger(spark.range(1), existing).first()["triggered"] is False
    assert quality.growth_trigger(spark.range(2), existing).first()["triggered"] is True
    listing = spark.range(5).select(F.col("id").cast("string").alias("doc_id"))
    assert feedback.new_documents(listing, existing, limit=2).count() == 3


def test_run_states(spark, scratch):
    import datetime as dt

    path = scratch + "/runs"
    quality.record_run(spark, path, "r1", "processing", dt.datetime(2024, 1, 1))
    counters = quality.run_counters(
        spark.createDataFrame([("1", "c", "Q1", "he is")], schemas.REVIEWS), spark.createDataFrame([], schemas.COURSES)
    )
    quality.record_run(spark, path, "r1", "completed", dt.datetime(2024, 1, 2), "out", counters)
    row = quality.run_lookup(spark.read.schema(schemas.RUNS).parquet(path)).first()
    assert row["status"] == "completed" and row["raw_reviews_count"] == 1 and row["end_time"] > row["start_time"]


def test_hot_document_spreads(spark):
    """One document with most of the pages keeps every response."""
    rows = [("hot", i, PAGE_1 if i == 0 else PAGE_2) for i in range(400)] + [(f"d{i}", 0, PAGE_1) for i in range(20)]
    _, reviews = feedback.documents_to_tables(feedback.parse_pages(pages(spark, rows)))
    assert reviews.count() == 3 + 399 + 60


def test_stream_is_incremental_and_idempotent(spark, scratch):
    source, root = scratch + "/pages", scratch + "/tables"
    stream.create_tables(spark, root)
    pages(spark, [("12345", 0, PAGE_1)]).coalesce(1).write.parquet(source)
    stream.ingest_stream(spark, source, root, scratch + "/cp").awaitTermination()
    assert stream.read_table(spark, root, "reviews").count() == 3
    again = pages(spark, [("12345", 0, PAGE_1), ("777", 0, PAGE_1.replace("12345", "777"))])
    again.coalesce(1).write.mode("append").parquet(source)
    stream.ingest_stream(spark, source, root, scratch + "/cp").awaitTermination()
    assert stream.read_table(spark, root, "reviews").count() == 6
    assert sorted(r["crn"] for r in stream.read_table(spark, root, "courses").collect()) == ["12345", "777"]

