"""Tables with a manifest, CSV that splits, observed counters, listings, embeddings and bounded chunks."""

import hashlib
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrivium.operators import ordering, score, tables
from quadrivium.plans import drift, quality, retrieval
from quadrivium.session import CLEANUP, cut_lineage
from quadrivium.sources import tables as sources


def log(spark):
    return spark.range(200).select(
        F.col("id").cast("string").alias("session_id"), F.format_string("q%03d", F.col("id")).alias("query_id"), F.lit("none").alias("feedback"))


def updates(spark, rows):
    return spark.createDataFrame([(str(k), f"q{k:03d}", v, at) for k, v, at in rows], "session_id string, query_id string, feedback string, at int")


def test_update_rewrites_only_files_that_hold_a_key(spark, scratch):
    keys = ["session_id", "query_id"]
    tables.create_table(log(spark).repartitionByRange(10, "query_id"), scratch)
    before = {r.file for r in tables.live_files(spark, scratch).collect()}
    assert len(before) == 10
    new = updates(spark, [(3, "old", 1), (3, "good", 2), (4, "bad", 1), (999, "nobody", 1)])
    assert tables.update_table(spark, scratch, new, keys, "feedback", "at") == 1
    after = {r.file for r in tables.live_files(spark, scratch).collect()}
    assert len(before & after) == 9
    rows = {r.query_id: r.feedback for r in tables.read_table(spark, scratch).collect()}
    assert len(rows) == 200 and rows["q003"] == "good" and rows["q004"] == "bad" and rows["q005"] == "none"
    assert tables.update_table(spark, scratch, new, keys, "feedback", "at") == 0, "a repeated update writes nothing"
    assert {r.file for r in tables.live_files(spark, scratch).collect()} == after
    back = updates(spark, [(199, None, 1)])
    assert tables.update_table(spark, scratch, back, keys, "feedback", "at") == 1
    assert tables.read_table(spark, scratch).where("feedback IS NULL").count() == 1


ODD = ['a "quoted", text', "two\nlines", "back\\slash", "\\n is no break", "\r\n\\\\", "\\", "\\\n", "", "é,中"]


def test_csv_keeps_texts_and_is_read_by_many_tasks(spark, scratch):
    rows = [(f"{k:04d}", ODD[k % len(ODD)] + "x" * (k % 50)) for k in range(2000)]
    frame = spark.createDataFrame(rows, "id string, body string").coalesce(1)
    sources.write_csv(frame, scratch)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        back = sources.read_csv(spark, scratch, frame.schema)
        assert back.rdd.getNumPartitions() > 3, "one file, several tasks"
        assert {(r.id, r.body or "") for r in back.collect()} == set(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_foreign_csv(spark, scratch):
    with open(f"{scratch}/a.csv", "w") as out:
        out.write('id,body\n"1","two\nlines"\n')
    schema = spark.createDataFrame([], "id string, body string").schema
    assert sources.read_csv(spark, scratch, schema, foreign=True).first().body == "two\nlines"


def test_counts_are_observed_by_the_write(spark, scratch):
    reviews = spark.createDataFrame([("1", "he said"), ("2", None), ("3", "fine")], "review_id string, response string").withColumn("crn", F.lit("c"))
    counts = quality.write_counted(reviews, scratch).first()
    assert counts.asDict() == {"raw_reviews_count": 3, "processed_reviews_count": 2, "null_responses_removed": 1, "sensitive_data_flags": 1}
    assert spark.read.parquet(scratch).count() == 2


def test_listing_reads_no_contents(spark, scratch):
    spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "document string, n int").repartition("document").write.partitionBy("document").parquet(scratch + "/t")
    listing = sources.list_documents(spark, scratch + "/t", ".parquet", r"/document=([^/]+)/")
    assert {r.doc_id for r in listing.collect()} == {"a", "b"} and listing.agg(F.min("bytes")).first()[0] > 0
    assert "content:binary" not in listing._jdf.queryExecution().executedPlan().toString()


def test_embedding_against_plain_hashes(spark):
    texts = ["The course, the Course!", "", None, "éa b", "one two three two"]
    got = score.embed(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text", "v", 8).orderBy("id").collect()
    for r, t in zip(got, texts):
        want = np.zeros(8)
        for w in [w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]:
            h = hashlib.md5(w.encode()).hexdigest()
            want[int(h[:8], 16) % 8] += -1 if int(h[8], 16) % 2 else 1
        size = np.linalg.norm(want)
        assert np.allclose(r.v, want / size if size else want) and len(r.v) == 8


@pytest.mark.parametrize("rows", [7, 10_000])
def test_range_totals(spark, rows):
    rnd = random.Random(2)
    data = [(rnd.choice("aab"), rnd.random(), rnd.randrange(5)) for _ in range(120)]
    frame = spark.createDataFrame(data, "g string, at double, n int")
    got = ordering.ranged_totals(frame, partition=["g"], order=["at"], values={"before": F.col("n").cast("long")}, inclusive=False, rows=rows).collect()
    assert {(r.g, r["at"]): r.before for r in got} == {(g, at): sum(n for h, x, n in data if h == g and x < at) for g, at, _ in data}


def test_property_drift_does_not_depend_on_ranges(spark):
    train = spark.createDataFrame([("word " * (k % 17 + 1),) for k in range(80)], "t string")
    test = spark.createDataFrame([("longer words " * (k % 11 + 3),) for k in range(60)], "t string")
    one, many = ({r.property: r.drift_score for r in drift.property_drift(train, test, "t", **x).collect()} for x in ({}, {"rows": 4}))
    assert one == many and max(one.values()) > 0


def test_chunks_make_the_whole_context(spark):
    rnd = random.Random(3)
    hits = spark.createDataFrame(
        [(q, "Doe", "CS1", f"head {q % 3}", float(q % 2)) for q in range(4)], "query_id int, faculty_name string, subject_course string, content string, distance double")
    courses = spark.createDataFrame([(f"{k}", "Doe", "1") for k in range(3)] * 2, "crn string, instructor string, course_code string")
    reviews = spark.createDataFrame(
        [(f"r{k:04d}", str(0 if k % 5 else k % 3), "Q", "w" * rnd.randrange(30)) for k in range(300)], "review_id string, crn string, question string, response string")
    whole = {r.query_id: r.content for r in retrieval.contexts(hits, courses, reviews).collect()}
    rows = retrieval.context_chunks(hits, courses, reviews, size=100).collect()
    made = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.position, r.chunk)):
        made[r.query_id] = made.get(r.query_id, "") + r.text
    assert made == whole and len(rows) > 60 and max(len(r.text) for r in rows) < 250


def test_materialised_steps_leave_no_shuffle_files(spark):
    """Else a chain of steps holds the shuffles of all of them until the driver happens to collect its garbage."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f.name for d in folders for f in Path(d).glob("*/shuffle_*")}
    before = files()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    made = cut_lineage(df.join(df.groupBy("count").agg(F.max("k").alias("top")), "count").withColumn("top", F.col("top") + 1))
    for _ in range(100):  # they are removed in the background
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(CLEANUP, None) is None
    assert {tuple(r) for r in made.collect()} == {(143, k, 6) for k in range(6)} | {(142, 6, 7)}
    assert df.count() == 7  # what it was made from can be asked again
    spark.conf.set(CLEANUP, "false")
    try:
        assert cut_lineage(df).count() == 7 and spark.conf.get(CLEANUP) == "false"
    finally:
        spark.conf.unset(CLEANUP)
