"""Row splits, anomaly reports, run counters and growth checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.functions import text
from quadrivium.operators.keyed import append_rows
from quadrivium.sources import schemas


def drop_null_responses(reviews: DataFrame) -> DataFrame:
    return reviews.where(F.col("response").isNotNull())


def unknown_questions(reviews: DataFrame) -> DataFrame:
    """Reviews whose question was not recognised; they stay in the output as well."""
    return reviews.where(F.col("question") == C.UNKNOWN_QUESTION)


def empty_crns(courses: DataFrame) -> DataFrame:
    return courses.where(F.col("crn") == "")


def split_missing_faculty(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, report lines of the rows without a faculty name)."""
    missing = F.col("faculty_name").isNull() | (F.col("faculty_name") == "")
    line = F.concat(
        F.lit("CRN: "), F.coalesce("crn", F.lit("None")),
        F.lit(", Course: "), F.coalesce("subject_course", F.lit("None")),
        F.lit(", Term: "), F.coalesce("term", F.lit("None")),
    )
    return catalog.where(~missing), catalog.where(missing).select("crn", line.alias("report_line"))


def neutralise(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with pronouns replaced, the rows that were touched as they were before)."""
    touched = df.where(text.has_pronoun(column)).select("crn", "question", column)
    return df.withColumn(column, text.neutralise_pronouns(column)), touched


def run_counters(reviews: DataFrame, courses: DataFrame) -> DataFrame:
    """One row of counts over the raw reviews and courses; one pass per table."""
    cleaned = text.clean_text("response")
    per_review = reviews.agg(
        F.count("*").alias("raw_reviews_count"),
        F.count("response").alias("processed_reviews_count"),
        F.count_if(F.col("response").isNull()).alias("null_responses_removed"),
        F.count_if(text.has_pronoun(cleaned)).alias("sensitive_data_flags"),
    )
    total = courses.agg(F.count("*").alias("n"))
    return per_review.select(
        "raw_reviews_count",
        total.scalar().alias("raw_courses_count"),
        "processed_reviews_count",
        total.scalar().alias("processed_courses_count"),
        "null_responses_removed",
        "sensitive_data_flags",
    )


def write_counted(reviews: DataFrame, path: str) -> DataFrame:
    """Write the reviews that have a response; one row of the counts that the write itself observed.

    The rows are read once: the counts are taken from what passes by on its way to the files.
    """
    seen = Observation("run counters")
    watched = reviews.observe(
        seen,
        F.count("*").alias("raw_reviews_count"),
        F.count("response").alias("processed_reviews_count"),
        F.count_if(F.col("response").isNull()).alias("null_responses_removed"),
        F.count_if(text.has_pronoun(text.clean_text("response"))).alias("sensitive_data_flags"),
    )
    # the filter stays above the observed rows
    drop_null_responses(watched).write.mode("overwrite").parquet(path)
    counts = seen.get
    names = ["raw_reviews_count", "processed_reviews_count", "null_responses_removed", "sensitive_data_flags"]
    return reviews.sparkSession.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


def growth_trigger(new: DataFrame, existing: DataFrame, ratio: float = C.GROWTH_RATIO) -> DataFrame:
    """Whether the new rows exceed a share of the existing ones."""
    counts = new.agg(F.count("*").alias("new_rows")).withColumn(
        "existing_rows", existing.agg(F.count("*").alias("n")).scalar()
    )
    return counts.withColumn("triggered", F.col("new_rows") > ratio * F.col("existing_rows"))


def record_run(
    spark: SparkSession, path: str, run_id: str, status: str, now, output_path: str = "", counters: DataFrame | None = None
) -> None:
    """Append one state (processing, completed, failed) of a run; counters default to zero."""
    names = [f.name for f in schemas.RUNS.fields if f.name.endswith(("_count", "_removed", "_flags"))]
    base = counters if counters is not None else spark.range(1).select(*[F.lit(0).alias(n) for n in names])
    values = {
        "run_id": F.lit(run_id), "status": F.lit(status), "output_path": F.lit(output_path), "timestamp": F.lit(now),
    }
    row = base.select(
        *[values.get(f.name, F.col(f.name) if f.name in base.columns else F.lit(0)).cast(f.dataType).alias(f.name)
          for f in schemas.RUNS.fields]
    )
    append_rows(row, path, schemas.RUNS)


def run_lookup(runs: DataFrame) -> DataFrame:
    """Per run: first and last time stamp and the counters of its latest state.

    Of states with one time stamp the later one of processing, failed, completed counts.
    """
    stage = F.array_position(F.array(*[F.lit(s) for s in ("processing", "failed", "completed")]), F.col("status"))
    final = F.max_by(F.struct(*[c for c in runs.columns if c not in ("run_id", "timestamp")]), F.struct("timestamp", stage))
    return runs.groupBy("run_id").agg(
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), final.alias("final")
    ).select("run_id", "start_time", "end_time", "final.*")
