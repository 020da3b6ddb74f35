"""Explicit schema of every table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


COURSES = _strings("crn", "course_code", "course_title", "instructor", "term")
CATALOG = _strings(
    "crn", "campus_description", "course_title", "subject_course", "faculty_name", "course_description",
    "term", "begin_time", "end_time", "days", "prereq",
)
REVIEWS = _strings("review_id", "crn", "question", "response")
TRAINING = _strings("question", "context", "response")
QUESTION_DIM = _strings("q_desc", "q_num")
PAGES = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("page_text", T.StringType()),
    ]
)
INTERACTIONS = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("feedback", T.StringType()),
        T.StructField("query_id", T.StringType()),
    ]
)
DRIFT_HISTORY = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
BIAS_SCORES = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("query_bucket", T.StringType()),
        T.StructField("sentiment_score", T.IntegerType()),
        T.StructField("prof_name", T.StringType()),
    ]
)
RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("raw_reviews_count", T.LongType()),
        T.StructField("raw_courses_count", T.LongType()),
        T.StructField("processed_reviews_count", T.LongType()),
        T.StructField("processed_courses_count", T.LongType()),
        T.StructField("null_responses_removed", T.LongType()),
        T.StructField("sensitive_data_flags", T.LongType()),
        T.StructField("output_path", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# JSON payloads
CATALOG_PAYLOAD = T.StructType(
    [
        T.StructField("totalCount", T.LongType()),
        T.StructField(
            "data",
            T.ArrayType(_strings("courseReferenceNumber", "campusDescription", "courseTitle", "subjectCourse")),
        ),
    ]
)
_MEETING = T.StructType(
    [T.StructField("beginTime", T.StringType()), T.StructField("endTime", T.StringType())]
    + [
        T.StructField(day, T.BooleanType())
        for day in ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    ]
)
FACULTY_PAYLOAD = T.StructType(
    [
        T.StructField(
            "fmt",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("faculty", T.ArrayType(_strings("displayName"))),
                        T.StructField("meetingTime", _MEETING),
                    ]
                )
            ),
        )
    ]
)
