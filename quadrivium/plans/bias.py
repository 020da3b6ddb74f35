"""Bias check: questions per professor, sentiment report and flagged groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.functions import replies
from quadrivium.plans.synthesis import expand_templates


def evaluation_questions(professors: DataFrame, column: str = "prof_name", templates: list[str] | None = None) -> DataFrame:
    """(query_bucket, query, prof_name): every evaluation template for every professor."""
    return expand_templates(professors.select(F.col(column).alias("prof_name")), "prof_name", templates or C.EVALUATION_TEMPLATES)


def sentiment_from_replies(df: DataFrame, reply: str) -> tuple[DataFrame, DataFrame]:
    """(rows with an integer score from 1 to 5, rows whose reply is not one)."""
    scored = df.withColumn("sentiment_score", replies.reply_score(reply))
    return scored.where("sentiment_score is not null"), scored.where("sentiment_score is null").drop("sentiment_score")


def bias_report(scores: DataFrame) -> DataFrame:
    """(dimension, key, mean, std, count) by query bucket and by professor, in one pass."""
    sets = scores.groupingSets([["query_bucket"], ["prof_name"]], "query_bucket", "prof_name").agg(
        F.avg("sentiment_score").alias("mean"),
        F.stddev_samp("sentiment_score").alias("std"),
        F.count("sentiment_score").alias("count"),
        F.grouping("query_bucket").alias("_by_prof"),
    )
    by_prof = F.col("_by_prof") == 1
    report = sets.select(
        F.when(by_prof, F.lit("prof_name")).otherwise(F.lit("query_bucket")).alias("dimension"),
        F.when(by_prof, F.col("prof_name")).otherwise(F.col("query_bucket")).alias("key"),
        "mean", "std", "count",
    )
    return report.where(F.col("key").isNotNull())


def flagged(report: DataFrame) -> DataFrame:
    """Groups whose mean is above 4 or below 2."""
    return report.where((F.col("mean") > C.BIAS_HIGH) | (F.col("mean") < C.BIAS_LOW))


def flagged_in_report(flags: DataFrame, report: DataFrame) -> DataFrame:
    """Flagged query buckets that the full report lists."""
    buckets = report.where(F.col("dimension") == "query_bucket").select("key")
    return flags.where(F.col("dimension") == "query_bucket").join(buckets, "key", "left_semi")
