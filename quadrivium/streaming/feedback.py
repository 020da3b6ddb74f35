"""Incremental feedback ingest as a file stream that stops when it has caught up.

The stream remembers which page files it has read; the batch ingest then drops documents whose crn
is already in the review table.  Every micro-batch overwrites its own folder, so a batch that is
repeated after a failure does not append twice.  All pages of a document belong in one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quadrivium.plans.feedback import ingest_feedback
from quadrivium.sources import schemas

TABLES = {"courses": schemas.COURSES, "reviews": schemas.REVIEWS, "flagged": T.StructType(
    [schemas.REVIEWS["crn"], schemas.REVIEWS["question"], schemas.REVIEWS["response"]]
)}


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty first folders, so that readers always find the tables."""
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{root}/{name}/batch=-1")


def read_table(spark: SparkSession, root: str, name: str, before: int | None = None) -> DataFrame:
    schema = T.StructType([*TABLES[name].fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{root}/{name}")
    return (rows if before is None else rows.where(F.col("batch") < before)).drop("batch")


def ingest_stream(spark: SparkSession, pages: str, root: str, checkpoint: str) -> StreamingQuery:
    """Process all page files not processed before, then stop."""

    def write(batch: DataFrame, number: int) -> None:
        known = read_table(spark, root, "reviews", number)
        courses = read_table(spark, root, "courses", number)
        tables = ingest_feedback(batch, known, courses, materialise=True)
        for name, rows in {"courses": tables.courses, "reviews": tables.reviews, "flagged": tables.flagged_reviews}.items():
            rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")

    stream = spark.readStream.schema(schemas.PAGES).parquet(pages)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
