"""Interaction log: session lookup, appends, feedback and archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.operators.keyed import append_rows, apply_updates, latest_per_key
from quadrivium.sources import schemas


def latest_per_session(log: DataFrame) -> DataFrame:
    """Latest row of every session, ties by query id."""
    return latest_per_key(log, ["session_id"], ["timestamp", "query_id"])


def session_row(log: DataFrame, session_id: str) -> DataFrame:
    """Latest row of one session: a filtered top-1."""
    return log.where(F.col("session_id") == session_id).orderBy(F.desc("timestamp"), F.desc("query_id")).limit(1)


def cached_contexts(requests: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests with the context of their session, requests that need retrieval).

    A session keeps its first context, also when a later question differs.
    """
    cached = latest_per_session(log).select("session_id", F.col("context").alias("context"), F.lit(True).alias("_hit"))
    joined = requests.join(cached, "session_id", "left")
    return joined.where("_hit").drop("_hit"), joined.where("_hit is null").drop("_hit", "context")


def append_interactions(rows: DataFrame, path: str) -> None:
    append_rows(rows, path, schemas.INTERACTIONS)


def apply_feedback(log: DataFrame, updates: DataFrame, order: str = "timestamp") -> DataFrame:
    """Set the feedback of (session_id, query_id) rows; the latest update of a key wins."""
    return apply_updates(log, updates, ["session_id", "query_id"], "feedback", order)
