"""The interaction log on the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrivium.plans import sessions, synthesis
from quadrivium.workloads import tables as t


def latest_per_session(spark, sf):
    return sessions.latest_per_session(t.interactions(spark, sf))


def session_cache_hits(spark, sf):
    """Every customer asks one question; customers whose id is a known session reuse its context."""
    hits, _ = _cached(spark, sf)
    return hits


def session_cache_misses(spark, sf):
    _, misses = _cached(spark, sf)
    return misses


def _cached(spark, sf):
    requests = t.read(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("session_id"), F.col("c_custkey").alias("query_id"), F.col("c_name").alias("query")
    )
    return sessions.cached_contexts(requests, t.interactions(spark, sf))


def apply_feedback(spark, sf):
    """Every click or error event sends feedback for the query of its k-th event."""
    events = t.read(spark, sf, "events")
    updates = events.where("event_type in ('click', 'error')").select(
        F.col("user_id").cast("string").alias("session_id"),
        F.lpad((F.floor(F.col("event_id") / 3) * 3).cast("string"), 12, "0").alias("query_id"),
        F.concat(F.lit("rated "), F.col("event_id").cast("string")).alias("feedback"),
        F.col("event_id").alias("timestamp"),
    )
    return sessions.apply_feedback(t.interactions(spark, sf), updates).select("session_id", "query_id", "feedback")


def archive_union(spark, sf):
    """History plus the current log, by month of the session."""
    log = t.interactions(spark, sf)
    history = log.withColumn("timestamp", F.col("timestamp") - 86400 * 30)
    both = history.unionByName(log)
    return both.groupBy(F.floor(F.col("timestamp") / 86400).alias("day")).agg(
        F.count("*").alias("rows"), F.count("feedback").alias("with_feedback")
    )


def distinct_session_queries(spark, sf):
    return synthesis.unique_queries(t.interactions(spark, sf).select("query"))


QUERIES = {
    f.__name__: f
    for f in [latest_per_session, session_cache_hits, session_cache_misses, apply_feedback, archive_union, distinct_session_queries]
}

_LATEST = """latest AS (
  SELECT * FROM interactions QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY "timestamp" DESC, query_id DESC) = 1)"""
_ASKED = "asked AS (SELECT CAST(c_custkey AS VARCHAR) AS session_id, c_custkey AS query_id, c_name AS query FROM customer)"

SQL = {
    "latest_per_session": t.with_(t.INTERACTIONS, _LATEST) + "SELECT * FROM latest",
    "session_cache_hits": t.with_(t.INTERACTIONS, _LATEST, _ASKED)
    + "SELECT a.session_id, a.query_id, a.query, l.context FROM asked a JOIN latest l ON a.session_id = l.session_id",
    "session_cache_misses": t.with_(t.INTERACTIONS, _ASKED)
    + "SELECT * FROM asked WHERE session_id NOT IN (SELECT session_id FROM interactions)",
    "apply_feedback": t.with_(t.INTERACTIONS) + """
        , u AS (SELECT CAST(user_id AS VARCHAR) AS session_id, lpad(CAST(event_id // 3 * 3 AS VARCHAR), 12, '0') AS query_id,
                arg_max('rated ' || event_id, event_id) AS feedback
                FROM events WHERE event_type IN ('click', 'error') GROUP BY 1, 2)
        SELECT i.session_id, i.query_id, coalesce(u.feedback, i.feedback) AS feedback
        FROM interactions i LEFT JOIN u ON i.session_id = u.session_id AND i.query_id = u.query_id""",
    "archive_union": t.with_(t.INTERACTIONS) + """
        , both_ AS (SELECT "timestamp" - 2592000 AS ts, feedback FROM interactions UNION ALL SELECT "timestamp", feedback FROM interactions)
        SELECT CAST(floor(ts / 86400) AS BIGINT) AS day, count(*) AS rows, count(feedback) AS with_feedback FROM both_ GROUP BY 1""",
    "distinct_session_queries": "SELECT DISTINCT event_type AS query FROM events",
}
