"""Templates, picks, bias report and the sample counter."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.operators import ordering
from quadrivium.operators.score import lexicon_sentiment
from quadrivium.plans import bias, evaluation, synthesis
from quadrivium.sources.tables import training_scan
from quadrivium.workloads import tables as t

SEED = 7


def template_expand(spark, sf):
    """Every evaluation template for every supplier."""
    return bias.evaluation_questions(t.read(spark, sf, "supplier"), "s_name")


def course_questions(spark, sf):
    parts = t.read(spark, sf, "part").select(F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("course_name"))
    return synthesis.expand_templates(parts, "course_name", C.SEED_TEMPLATES)


def seed_questions(spark, sf):
    catalog = t.courses(spark, sf).select("course_title", F.col("instructor").alias("faculty_name"))
    topics = t.read(spark, sf, "part").select(F.col("p_name").alias("topic"))
    return synthesis.seed_questions(topics, catalog, SEED)


def sample_entities(spark, sf):
    """Ten professors without replacement."""
    return ordering.pick(t.read(spark, sf, "supplier"), "s_name", C.BIAS_SAMPLE, SEED)


def distinct_entities(spark, sf):
    return t.courses(spark, sf).select("course_title").distinct()


def fractional_sample(spark, sf):
    """A tenth of the rows by digest, the same rows on every run."""
    limit = f"{int(0.1 * 16**8):08x}"
    rows = t.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rows.where(F.left(ordering.digest("o_orderkey", SEED), F.lit(8)) < limit)


def training_limit(spark, sf):
    rows = t.dialogue(spark, sf).select("id", F.col("query").alias("question"), "context", "response")
    return training_scan(rows, C.TRAINING_LIMIT, ["id"])


def training_whole(spark, sf):
    """Every training row."""
    return training_scan(t.dialogue(spark, sf).select("id", F.col("query").alias("question"), "context", "response"))


def capped_run(spark, sf):
    return synthesis.capped_per_run(t.dialogue(spark, sf).select("id", "query"), ["id"], C.SAMPLES_PER_RUN)


def unique_queries(spark, sf):
    return synthesis.unique_queries(t.read(spark, sf, "documents").select(F.col("text").alias("query"))).select(
        F.md5(F.col("query").cast("binary")).alias("query_md5")
    )


def training_rows(spark, sf):
    rows = t.dialogue(spark, sf)
    contexts = rows.select(F.col("id").alias("query_id"), "query", F.col("context").alias("content"))
    return synthesis.training_rows(contexts, rows.select(F.col("id").alias("query_id"), "response"))


def sample_counts(spark, sf):
    """orders as recorded runs of one series per order priority."""
    runs = t.read(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series"), F.col("o_orderkey").alias("run"),
        F.when(F.col("o_orderstatus") == "P", F.lit(synthesis.STOP)).otherwise(F.lit(synthesis.GENERATE)).alias("status"),
        (F.floor("o_totalprice") % 200).cast("int").alias("generated"),
    )
    return synthesis.sample_counts(runs, "series", "run", F.floor(F.col("run") / 1024)).select(
        "series", "run", "sample_count", "decision"
    )


def _scores(spark, sf):
    labels, documents = t.read(spark, sf, "labels"), t.read(spark, sf, "documents")
    return labels.join(documents, "doc_id").select(
        F.col("source").alias("query_bucket"), F.col("lang").alias("prof_name"),
        (1 + 2 * F.col("quality") + 2 * (1 - F.col("toxic"))).alias("sentiment_score"),
    )


def bias_report(spark, sf):
    report = bias.bias_report(_scores(spark, sf))
    return report.select("dimension", "key", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "count")


def bias_flagged(spark, sf):
    return bias.flagged(bias.bias_report(_scores(spark, sf))).select("dimension", "key", F.round("mean", 6).alias("mean"))


def bias_flagged_buckets(spark, sf):
    report = bias.bias_report(_scores(spark, sf))
    return bias.flagged_in_report(bias.flagged(report), report).select("key", F.round("mean", 6).alias("mean"))


def lexicon_scores(spark, sf):
    """Sentiment of every document; the words of the benchmark texts get a valence by their length."""
    words = t.read(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("word"))
    lexicon = words.where("word <> ''").distinct().withColumn("valence", ((F.length("word") * 7) % 21 - 10) / F.lit(10.0))
    return lexicon_sentiment(t.read(spark, sf, "documents"), "doc_id", "text", lexicon)


def sentiment_replies(spark, sf):
    rows = t.read(spark, sf, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, F.lit("n/a")).otherwise(F.concat(F.lit("\n"), (F.col("doc_id") % 7).cast("string"))).alias("reply")
    )
    good, bad = bias.sentiment_from_replies(rows, "reply")
    return good.select("doc_id", "sentiment_score").unionByName(bad.select("doc_id", F.lit(None).cast("int").alias("sentiment_score")))


def rubric_means(spark, sf):
    """Every document judged by three metrics; the judge of this query reads the whole prompt and replies with its length modulo 7."""
    rubrics = [(m, m + " of {prompt}: {response}") for m in ("relevance", "coverage", "bias")]
    rows = t.read(spark, sf, "documents").select(F.concat(F.lit("document "), F.col("doc_id").cast("string")).alias("prompt"), F.col("text").alias("response"))
    judged = evaluation.rubric_prompts(rows, rubrics).withColumn("reply", (F.length("judge_prompt") % 7).cast("string"))
    means = evaluation.rubric_means(judged)
    return means.withColumn("mean_score", F.round("mean_score", 6))


QUERIES = {
    f.__name__: f
    for f in [
        template_expand, course_questions, seed_questions, sample_entities, distinct_entities, fractional_sample, training_limit, training_whole,
        capped_run, unique_queries, training_rows, sample_counts, bias_report, bias_flagged, bias_flagged_buckets, lexicon_scores,
        sentiment_replies, rubric_means,
    ]
}


def _filled(templates, field, source, column):
    parts = []
    for template in templates:
        if "{" + field + "}" in template:
            literal = template.replace("'", "''")
            parts.append(f"SELECT '{literal}' AS query_bucket, replace('{literal}', '{{{field}}}', {column}) AS query, {column} AS {field} FROM {source}")
    return " UNION ALL ".join(parts)


_SCORES = """scores AS (SELECT d.source AS query_bucket, d.lang AS prof_name, 1 + 2 * l.quality + 2 * (1 - l.toxic) AS s
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
_REPORT = """report AS (
  SELECT 'query_bucket' AS dimension, query_bucket AS key, avg(s) AS mean, stddev_samp(s) AS std, count(s) AS count FROM scores GROUP BY query_bucket
  UNION ALL SELECT 'prof_name', prof_name, avg(s), stddev_samp(s), count(s) FROM scores GROUP BY prof_name)"""


def _pick(source: str, column: str) -> str:
    return f"(SELECT {column} FROM (SELECT DISTINCT {column} FROM {source}) ORDER BY md5({column} || '#{SEED}'), {column} LIMIT 1)"


def _seed_sql() -> str:
    parts = []
    for field, source, column in (("topic", "part", "p_name"), ("course_name", "courses", "course_title"), ("professor_name", "courses", "instructor")):
        for template in C.SEED_TEMPLATES:
            if "{" + field + "}" in template:
                parts.append(f"SELECT '{field}' AS placeholder, replace('{template}', '{{{field}}}', {_pick(source, column)}) AS query")
    return t.with_(t.COURSES) + " UNION ALL ".join(parts)


SQL = {
    "template_expand": _filled(C.EVALUATION_TEMPLATES, "prof_name", "(SELECT s_name AS prof_name FROM supplier)", "prof_name"),
    "course_questions": _filled(C.SEED_TEMPLATES, "course_name", "(SELECT p_name || ' ' || p_partkey AS course_name FROM part)", "course_name"),
    "seed_questions": _seed_sql(),
    "sample_entities": f"SELECT s_name FROM supplier ORDER BY md5(s_name || '#{SEED}'), s_name LIMIT 10",
    "distinct_entities": "SELECT DISTINCT split_part(text, chr(10), 1) AS course_title FROM documents",
    "fractional_sample": f"SELECT o_orderkey, o_custkey FROM orders WHERE left(md5(o_orderkey || '#{SEED}'), 8) < '{int(0.1 * 16**8):08x}'",
    "training_limit": t.with_(t.DIALOGUE) + "SELECT id, query, context, response FROM dialogue ORDER BY id LIMIT 50",
    "training_whole": t.with_(t.DIALOGUE) + "SELECT id, query, context, response FROM dialogue",
    "capped_run": t.with_(t.DIALOGUE) + "SELECT id, query FROM dialogue ORDER BY id LIMIT 51",
    "unique_queries": "SELECT DISTINCT md5(text) AS query_md5 FROM documents",
    "training_rows": t.with_(t.DIALOGUE) + "SELECT query AS question, context, response FROM dialogue",
    "sample_counts": """
        WITH runs AS (SELECT o_orderpriority AS series, o_orderkey AS run,
                CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) % 200 END AS carried FROM orders),
        eras AS (SELECT *, coalesce(sum(CASE WHEN carried = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY run
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS era FROM runs),
        counts AS (SELECT series, run, coalesce(sum(carried) OVER (PARTITION BY series, era ORDER BY run
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sample_count FROM eras)
        SELECT series, run, CAST(sample_count AS BIGINT) AS sample_count,
               CASE WHEN sample_count >= 500 THEN 'stop_task' ELSE 'generate_samples' END AS decision FROM counts""",
    "bias_report": t.with_(_SCORES, _REPORT) + "SELECT dimension, key, round(mean, 6) AS mean, round(std, 6) AS std, count FROM report",
    "bias_flagged": t.with_(_SCORES, _REPORT) + "SELECT dimension, key, round(mean, 6) AS mean FROM report WHERE mean > 4 OR mean < 2",
    "bias_flagged_buckets": t.with_(_SCORES, _REPORT)
    + "SELECT key, round(mean, 6) AS mean FROM report WHERE (mean > 4 OR mean < 2) AND dimension = 'query_bucket'",
    "lexicon_scores": f"""
        WITH lexicon AS (SELECT word, ((length(word) * 7) % 21 - 10) / 10.0 AS valence FROM
                (SELECT DISTINCT unnest({t.sql_words('text')}) AS word FROM benchmark)),
        words AS (SELECT doc_id, unnest({t.sql_words('text')}) AS word FROM documents),
        means AS (SELECT doc_id, CAST(sum(CAST(valence * 10 AS BIGINT)) AS DOUBLE) / 10 / count(*) AS mean
                  FROM words JOIN lexicon USING (word) GROUP BY doc_id)
        SELECT d.doc_id, CAST(CASE WHEN mean IS NULL THEN 3 ELSE least(floor((mean + 1) * 2.5) + 1, 5) END AS INT) AS sentiment_score
        FROM documents d LEFT JOIN means m ON d.doc_id = m.doc_id""",
    "sentiment_replies": """SELECT doc_id, CAST(CASE WHEN toxic = 0 AND doc_id % 7 BETWEEN 1 AND 5 THEN doc_id % 7 END AS INT) AS sentiment_score
        FROM labels""",
    "rubric_means": """
        WITH judged AS (
          SELECT metric, length(metric || ' of document ' || doc_id || ': ' || text) % 7 AS score
          FROM documents, (VALUES ('relevance'), ('coverage'), ('bias')) m(metric))
        SELECT metric, round(avg(score) FILTER (WHERE score BETWEEN 1 AND 5), 6) AS mean_score,
               count(*) FILTER (WHERE score BETWEEN 1 AND 5) AS scored, count(*) FILTER (WHERE score NOT BETWEEN 1 AND 5) AS rejected
        FROM judged GROUP BY metric""",
}
