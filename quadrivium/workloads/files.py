"""Sinks read back, tables moved and appended, and the hooks for batch functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrivium.operators import keyed, score
from quadrivium.operators import tables as versioned
from quadrivium.plans import drift, feedback, quality, sessions, synthesis, training
from quadrivium.session import output_folder
from quadrivium.sources import schemas, tables
from quadrivium.workloads import tables as t


def csv_round_trip(spark, sf):
    """Review texts with quotes, commas and line breaks through CSV; a null becomes empty."""
    folder = output_folder(spark)
    quoted = F.concat(F.lit('"a", '), F.col("response"), F.lit("\nend"))
    rows = t.reviews(spark, sf).select("review_id", "crn", "question", F.when(F.col("question") != "system", quoted).alias("response"))
    tables.write_csv(rows, folder)
    back = tables.read_csv(spark, folder, rows.schema)
    return back.select("review_id", "crn", "question", F.md5(F.coalesce("response", F.lit("")).cast("binary")).alias("response_md5"))


def training_csv(spark, sf):
    """Training rows through CSV; turns without an answer, and empty fields, are left out when they are read."""
    folder = output_folder(spark)
    rows = t.dialogue(spark, sf).select(F.col("query").alias("question"), "context", "response")
    tables.write_csv(rows.select(*schemas.TRAINING.names), folder)
    return tables.read_training_csv(spark, folder).select("question", "context", F.md5(F.col("response").cast("binary")).alias("response_md5"))


def training_rows_loaded(spark, sf):
    """Training rows appended to a table in two loads, names and types checked."""
    folder = output_folder(spark)
    rows = t.dialogue(spark, sf)
    for part in (0, 1):
        some = rows.where(F.col("response").isNotNull() == F.lit(part == 0))
        contexts = some.select(F.col("id").alias("query_id"), "query", F.col("context").alias("content"))
        made = synthesis.training_rows(contexts, some.select(F.col("id").alias("query_id"), "response"))
        keyed.append_rows(made.select(*schemas.TRAINING.names), folder, schemas.TRAINING)
    return spark.read.schema(schemas.TRAINING).parquet(folder)


def listed_documents(spark, sf):
    """Pages written below their document's folder, listed from the files alone, and the new ones joined to their pages."""
    folder = output_folder(spark)
    pages = t.read(spark, sf, "conversations").select(
        F.col("turn").cast("int").alias("page_num"), F.col("text").alias("page_text"), (F.col("conv_id") % 40).cast("string").alias("document"))
    pages.repartition("document").write.partitionBy("document").parquet(folder)
    listing = tables.list_documents(spark, folder, ".parquet", r"/document=([^/]+)/").select("doc_id").distinct()
    known = spark.range(0, 40, 3).select(F.col("id").cast("string").alias("crn"))
    stored = spark.read.schema("page_num int, page_text string, document string").parquet(folder)
    new = feedback.new_documents(listing, known)
    found = stored.join(new.withColumnRenamed("doc_id", "document"), "document")
    return found.groupBy("document").agg(F.count("*").alias("pages"), F.sum(F.length("page_text")).alias("chars"))


def feedback_update_in_place(spark, sf):
    """Feedback set in a table whose files hold ranges of queries; an update that is repeated changes nothing."""
    folder = output_folder(spark)
    log = t.interactions(spark, sf).select("session_id", "query_id", "feedback")
    versioned.create_table(log.repartitionByRange(16, "query_id"), folder)
    updates = t.read(spark, sf, "events").where("event_type = 'click'").select(
        F.col("user_id").cast("string").alias("session_id"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("query_id"),
        F.concat(F.lit("rated "), F.col("event_id").cast("string")).alias("feedback"), F.col("event_id").alias("timestamp"))
    for _ in range(2):
        versioned.update_table(spark, folder, updates, ["session_id", "query_id"], "feedback", "timestamp")
    return versioned.read_table(spark, folder)


def recorded_runs(spark, sf):
    """One run per role: its reviews written with counters observed on the way, both states recorded, then looked up."""
    folder = output_folder(spark)
    reviews = t.reviews(spark, sf).withColumn("response", F.when(F.length("response") % 5 > 0, F.col("response")))
    for role in ("assistant", "system", "user"):
        now = "2024-05-01 00:00:00"  # both states have one time stamp; the later state counts
        quality.record_run(spark, folder + "/runs", role, "processing", now)
        counters = quality.write_counted(reviews.where(F.col("question") == role), f"{folder}/reviews/{role}")
        quality.record_run(spark, folder + "/runs", role, "completed", now, "done", counters)
    runs = quality.run_lookup(spark.read.parquet(folder + "/runs"))
    return runs.select("run_id", "status", "raw_reviews_count", "processed_reviews_count", "null_responses_removed", "sensitive_data_flags", "output_path")


def jsonl_round_trip(spark, sf):
    """Training records as text lines."""
    folder = output_folder(spark)
    tables.write_lines(training.chat_jsonl(t.dialogue(spark, sf)), folder)
    lines = spark.read.text(folder)
    return lines.select(F.get_json_object("value", "$.contents[1].parts[0].text").alias("response"))


def load_twice(spark, sf):
    """Appending keeps both loads, overwriting the last one."""
    folder = output_folder(spark)
    rows = t.read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    tables.write_csv(rows, folder + "/csv")
    for _ in range(2):
        tables.load_append(spark, folder + "/csv", rows.schema, folder + "/appended")
        tables.load_overwrite(spark, folder + "/csv", rows.schema, folder + "/written")

    def counts(name):
        return spark.read.parquet(f"{folder}/{name}").groupBy("c_mktsegment").agg(F.count("*").alias("rows")).withColumn("how", F.lit(name))

    return counts("appended").unionByName(counts("written"))


def archive_moves(spark, sf):
    """The log goes to the history once and leaves its table empty."""
    folder = output_folder(spark)
    log = t.interactions(spark, sf).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.INTERACTIONS.fields])
    log.write.parquet(folder + "/log")
    for batch in ("1", "2"):
        keyed.archive(spark, folder + "/log", folder + "/history", schemas.INTERACTIONS, batch)
    history = spark.read.parquet(folder + "/history").groupBy("query").agg(F.count("*").alias("rows"))
    left = spark.read.schema(schemas.INTERACTIONS).parquet(folder + "/log").agg(F.count("*").alias("rows"))
    return history.withColumn("place", F.lit("history")).unionByName(left.select(F.lit(None).cast("string").alias("query"), "rows", F.lit("log").alias("place")))


def history_append(spark, sf):
    """Two runs of drifted queries, and the trend right after the second."""
    folder = output_folder(spark)
    rows = t.read(spark, sf, "events").where("event_type = 'error'").select(
        F.col("event_id").cast("string").alias("query"), (F.col("value") / 100.0).alias("similarity")
    )
    for time in ("2024-01-01 00:00:00", "2024-01-20 00:00:00"):
        drift.append_history(rows, folder, time)
    return drift.trend(spark.read.parquet(folder), F.lit("2024-01-21 00:00:00").cast("timestamp"))


def session_rows(spark, sf):
    """The latest row of one session, the smallest id."""
    log = t.interactions(spark, sf)
    return sessions.session_row(log, log.agg(F.min("session_id")).first()[0])


def _words(batch):
    if batch["text"].str.contains("!!", regex=False).any():
        raise ValueError("shouting")
    return batch.assign(words=batch["text"].str.split().str.len())


def mapped_batches(spark, sf):
    """Words of each document by a batch function that refuses some rows."""
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("words", T.LongType())])
    return score.map_batches(t.read(spark, sf, "documents").select("doc_id", "text"), _words, out)


def scored_documents(spark, sf):
    """Length in characters by a scorer that is built once per partition."""
    rows = t.read(spark, sf, "documents").select("doc_id", "text")
    return score.score(rows, lambda: lambda batch: batch["text"].str.len(), "chars", T.LongType()).drop("text")


QUERIES = {
    f.__name__: f
    for f in [csv_round_trip, training_csv, training_rows_loaded, listed_documents, feedback_update_in_place, recorded_runs, jsonl_round_trip, load_twice, archive_moves, history_append, session_rows, mapped_batches, scored_documents]
}

SQL = {
    "csv_round_trip": t.with_(t.REVIEWS) + """
        SELECT review_id, crn, question, md5(CASE WHEN question <> 'system' THEN '"a", ' || response || chr(10) || 'end' ELSE '' END) AS response_md5
        FROM reviews""",
    "training_csv": t.with_(t.DIALOGUE, t.ANSWERED) + """
        SELECT query AS question, context, md5(response) AS response_md5 FROM answered WHERE query <> '' AND response <> ''""",
    "training_rows_loaded": t.with_(t.DIALOGUE) + "SELECT query AS question, context, response FROM dialogue",
    "listed_documents": """
        SELECT CAST(conv_id % 40 AS VARCHAR) AS document, count(*) AS pages, CAST(sum(length(text)) AS BIGINT) AS chars
        FROM conversations WHERE conv_id % 40 % 3 <> 0 GROUP BY 1""",
    "feedback_update_in_place": t.with_(t.INTERACTIONS) + """
        SELECT i.session_id, i.query_id, CASE WHEN e.event_type = 'click' THEN 'rated ' || e.event_id ELSE i.feedback END AS feedback
        FROM interactions i JOIN events e ON i.query_id = lpad(CAST(e.event_id AS VARCHAR), 12, '0')""",
    "recorded_runs": f"""
        WITH r AS (SELECT role, CASE WHEN length(text) % 5 > 0 THEN text END AS response FROM conversations)
        SELECT role AS run_id, 'completed' AS status, count(*) AS raw_reviews_count, count(response) AS processed_reviews_count,
               count(*) FILTER (WHERE response IS NULL) AS null_responses_removed,
               count(*) FILTER (WHERE {t.sql_flag(t.sql_clean('response'))}) AS sensitive_data_flags, 'done' AS output_path
        FROM r GROUP BY role""",
    "jsonl_round_trip": t.with_(t.DIALOGUE, t.ANSWERED) + "SELECT response FROM answered",
    "load_twice": """
        SELECT c_mktsegment, 2 * count(*) AS rows, 'appended' AS how FROM customer GROUP BY 1
        UNION ALL SELECT c_mktsegment, count(*), 'written' FROM customer GROUP BY 1""",
    "archive_moves": """
        SELECT event_type AS query, count(*) AS rows, 'history' AS place FROM events GROUP BY 1 UNION ALL SELECT NULL, 0, 'log'""",
    "history_append": "SELECT count(*) AS rows_in_window, count(*) >= 2 AS trend FROM events WHERE event_type = 'error'",
    "session_rows": t.with_(t.INTERACTIONS) + """
        SELECT * FROM interactions WHERE session_id = (SELECT min(session_id) FROM interactions) ORDER BY "timestamp" DESC, query_id DESC LIMIT 1""",
    "mapped_batches": """
        SELECT doc_id, CASE WHEN contains(text, '!!') THEN NULL ELSE len(regexp_extract_all(text, '[^\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}]+')) END AS words,
               CASE WHEN contains(text, '!!') THEN 'shouting' END AS error FROM documents""",
    "scored_documents": "SELECT doc_id, length(text) AS chars FROM documents",
}
