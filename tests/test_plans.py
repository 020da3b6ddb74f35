import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrivium import constants as C
from quadrivium.functions import text
from quadrivium.plans import bias, catalog, drift, evaluation, retrieval, sessions, synthesis, training
from quadrivium.sources import schemas, tables


# --- catalog ---------------------------------------------------------------------------------


def payload(spark, rows, schema="json string"):
    return spark.createDataFrame(rows, schema)


def test_catalog_row(spark):
    body = {"totalCount": 1, "data": [{"courseReferenceNumber": "1", "campusDescription": "Main", "courseTitle": "Intro", "subjectCourse": "CS5010"}]}
    row = catalog.flatten_catalog(payload(spark, [(json.dumps(body),)]), "202530").first()
    assert row.asDict() == {
        "crn": "1", "campus_description": "Main", "course_title": "Intro", "subject_course": "CS5010", "faculty_name": "",
        "course_description": "", "term": "Spring 2025", "begin_time": "", "end_time": "", "days": "", "prereq": "",
    }


def test_faculty_payloads(spark):
    full = {"fmt": [{"faculty": [{"displayName": "Doe, Jo"}, {"displayName": "x"}], "meetingTime": {"beginTime": "0900", "endTime": "1000", "monday": True, "friday": True, "tuesday": False}}]}
    rows = [("1", json.dumps(full)), ("2", '{"fmt": []}'), ("3", "{}"), ("4", "broken"), ("5", '{"fmt":[{"faculty":[]}]}')]
    got = {r["crn"]: tuple(r)[1:] for r in catalog.faculty_info(payload(spark, rows, "crn string, json string")).collect()}
    assert got["1"] == ("Doe, Jo", "0900", "1000", "monday;friday")
    assert all(got[k] == ("", "", "", "") for k in "2345")


def test_enrichment_keeps_rows_and_publishes(spark, scratch):
    base = spark.createDataFrame([(str(i), "Main", f"T{i}", f"CS{i}", "", "", "Spring 2025", "", "", "", "") for i in range(3)], schemas.CATALOG)
    faculty = spark.createDataFrame([("1", 'Doe, "Jo"', "0900", "1000", "monday")], "crn string, faculty_name string, begin_time string, end_time string, days string")
    described = catalog.descriptions(payload(spark, [("1", "<section aria-labelledby=courseDescription>12 About\n it</section>"), ("2", "<p/>")], "crn string, html string"))
    assert {r["crn"]: r["course_description"] for r in described.collect()} == {"1": "About  it", "2": catalog.NO_DESCRIPTION}
    prereq = spark.createDataFrame([("1", [("", "Math", "2321", "U", "C-")])], f"crn string, prereq {catalog.PREREQ_TYPE}")
    rich = catalog.enrich(base, faculty, described, prereq)
    assert rich.count() == 3 and rich.columns == [f.name for f in schemas.CATALOG.fields]
    ready, missing = catalog.publishable(rich)
    assert missing.count() == 2
    tables.write_csv(ready, scratch + "/csv")
    raw = "".join(r["value"] for r in spark.read.text(scratch + "/csv").collect())
    assert '"Doe, ""Jo"""' in raw
    back = tables.read_csv(spark, scratch + "/csv", schemas.CATALOG).first()
    assert back["faculty_name"] == 'Doe, "Jo"' and json.loads(back["prereq"])[0]["subject"] == "Math"
    tables.load_overwrite(spark, scratch + "/csv", schemas.CATALOG, scratch + "/table")
    tables.load_append(spark, scratch + "/csv", schemas.CATALOG, scratch + "/table")
    assert spark.read.parquet(scratch + "/table").count() == 2


def test_empty_catalog_fails(spark):
    with pytest.raises(ValueError):
        catalog.publishable(spark.createDataFrame([], schemas.CATALOG))


# --- sources ---------------------------------------------------------------------------------


def test_listing_and_dimensions(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/1.pdf", "2.pdf", "x.txt"):
        (tmp_path / name).write_bytes(b"%PDF")
    assert sorted(r["doc_id"] for r in tables.list_documents(spark, str(tmp_path)).collect()) == ["1", "2"]
    assert tables.question_dim(spark).count() == 5
    assert tables.template_dim(spark).where("placeholder = 'course_name'").count() == 4
    assert tables.topic_dim(spark).count() == 28


def test_training_csv_and_lines(spark, scratch):
    rows = spark.createDataFrame([("q", "c\nd", 'r "x"'), ("q2", None, "r")], schemas.TRAINING)
    tables.write_csv(rows, scratch + "/t")
    back = tables.read_training_csv(spark, scratch + "/t", keep=["question"])
    assert back.columns == ["question"]
    assert tables.training_scan(rows, 1).columns == ["query", "context", "response"]
    tables.write_lines(training.chat_jsonl(rows.dropna().withColumnRenamed("question", "query")), scratch + "/l")
    line = json.loads(spark.read.text(scratch + "/l").first()["value"])
    assert line["contents"][1]["parts"][0]["text"] == 'r "x"' and "c\nd" in line["contents"][0]["parts"][0]["text"]


# --- retrieval -------------------------------------------------------------------------------


def plain_contexts(queries, base, courses, reviews, k, subject, limit):
    """The same contexts by loops over small lists."""
    def gap(a, b):
        na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        return round(1 - sum(x * y for x, y in zip(a, b)) / (na * nb), 12)

    out = {}
    for qid, qv in queries:
        hits = sorted((gap(qv, b[1]), b[0], b) for b in base)[:k]
        copies = Counter()
        for d, _, (_, _, faculty, subj, content) in hits:
            for crn, instructor, code in courses:
                if instructor == faculty and (not subject or subj == "CS" + code):
                    copies[(d, crn, content)] += 1
        entries, crns = [], []
        for (d, crn, content), m in sorted(copies.items()):
            texts = [f"{q}\n{r}\n" for rid, c, q, r in sorted(reviews) if c == crn and q is not None and r is not None for _ in range(m)]
            if texts:
                info = f"Course Information:\n{content}\nReview Information:\n{'; '.join(texts)}\n"
                entries.append("".join(ch for ch in info if ch not in C.PUNCTUATION))
                crns.append(crn)
        if entries:
            full = "\n\n".join(entries)
            if limit is not None:
                starts = [len("\n\n".join(entries[:i])) + (2 if i else 0) for i in range(len(entries))]
                crns = [c for c, s in zip(crns, starts) if s < limit]
                full = full[:limit]
            out[qid] = (crns, full)
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    vec = lambda: [round(rng.uniform(-1, 1), 2) for _ in range(3)]
    copy = vec()
    base = [(i, copy if i % 3 == 0 else vec(), "hot" if i % 3 == 0 else f"f{i % 4}", f"CS{i % 2}", "same, text!" if i % 3 == 0 else f"row: {i}") for i in range(30)]
    courses = [(str(i), "hot" if i % 2 else f"f{i % 4}", str(i % 2)) for i in range(40)] + [("3", "hot", "1")]
    reviews = [(f"r{i:03d}", "1" if i < 60 else str(i % 40), f"Q{i % 3}?", None if i == 7 else "x" * rng.randint(0, 20) + f" {i}.") for i in range(200)]
    queries = [(i, copy if i == 0 else vec()) for i in range(12)]
    return queries, base, courses, reviews


@pytest.mark.parametrize("subject, limit", [(False, 100_000), (True, None), (False, 700), (False, 35), (True, 5000)])
def test_contexts_against_loops(spark, corpus, subject, limit):
    queries, base, courses, reviews = corpus
    frames = (
        spark.createDataFrame(queries, "query_id int, query_vector array<double>"),
        spark.createDataFrame(base, "base_id int, embedding array<double>, faculty_name string, subject_course string, content string"),
        spark.createDataFrame(courses, "crn string, instructor string, course_code string"),
        spark.createDataFrame(reviews, "review_id string, crn string, question string, response string"),
    )
    rows = retrieval.retrieve_context(*frames, k=5, dim=3, match_subject=subject, max_chars=limit).collect()
    got = {r["query_id"]: (list(r["crns"]), r["content"]) for r in rows}
    assert got == plain_contexts(queries, base, courses, reviews, 5, subject, limit)


def test_fallback_response(spark):
    queries = spark.createDataFrame([(1,), (2,)], "query_id int")
    found = spark.createDataFrame([(1, ["c"], "text")], "query_id int, crns array<string>, content string")
    got = {r["query_id"]: r["response"] for r in retrieval.answers_or_fallback(queries, found, "none").collect()}
    assert got == {1: None, 2: "none"}


def test_session_cache(spark, scratch):
    log = spark.createDataFrame([(1, "s", "q", "old", "r", None, "a"), (2, "s", "q", "new", "r", None, "b")], schemas.INTERACTIONS)
    sessions.append_interactions(log, scratch + "/log")
    sessions.append_interactions(log, scratch + "/log")
    assert spark.read.parquet(scratch + "/log").count() == 4
    requests = spark.createDataFrame([("s", "1", "x"), ("t", "2", "y")], "session_id string, query_id string, query string")
    hits, misses = sessions.cached_contexts(requests, log)
    assert [r["context"] for r in hits.collect()] == ["new"] and [r["session_id"] for r in misses.collect()] == ["t"]
    assert sessions.session_row(log, "s").first()["query_id"] == "b"


# --- drift -----------------------------------------------------------------------------------


def frame_of(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, v array<double>")


def test_thresholds_and_band(spark):
    train = frame_of(spark, [(1, 0.1), (1, 0.2), (1, 0.3), (1, 0.4), (1, 2.0)])
    low = drift.thresholds(train, "id", "v", scope="global").first()
    batch = drift.thresholds(train, "id", "v").first()
    assert batch["minimum"] >= low["minimum"] - 1e-12
    assert low["upper"] == pytest.approx(0.9 * low["minimum"]) and low["lower"] == pytest.approx(0.4 * low["minimum"])
    negative = drift.thresholds(frame_of(spark, [(1, 0), (-1, 0.1)]), "id", "v").first()
    assert negative["minimum"] < 0 and negative["upper"] < negative["lower"]
    single = drift.thresholds(frame_of(spark, [(3, 4)]), "id", "v").first()
    assert single["minimum"] == pytest.approx(1.0)
    assert drift.thresholds(frame_of(spark, [(0, 0), (1, 1)]), "id", "v").first()["minimum"] == 0.0


def test_trend_boundaries(spark):
    history = spark.createDataFrame([("a", 0.1, "2024-01-08 00:00:00"), ("b", 0.1, "2024-01-09 00:00:00"), ("c", 0.1, "2024-01-01 00:00:00")], "query string, distance double, t string")
    history = history.select("query", "distance", F.col("t").cast("timestamp").alias("timestamp"))
    stamp = lambda s: F.lit(s).cast("timestamp")
    assert tuple(drift.trend(history, stamp("2024-01-10 00:00:00")).first()) == (2, True)
    # strictly after the later of both limits
    assert tuple(drift.trend(history, stamp("2024-01-10 00:00:00"), stamp("2024-01-08 00:00:00")).first()) == (1, False)
    assert drift.trend(history, stamp("2024-01-08 00:00:00")).first()["rows_in_window"] == 2


def test_history_append(spark, scratch):
    rows = spark.createDataFrame([("q", 0.5)], "query string, similarity double")
    drift.append_history(rows, scratch + "/h", "2024-01-01 00:00:00")
    assert spark.read.parquet(scratch + "/h").first()["distance"] == 0.5
    assert tuple(drift.drift_flag(rows).first()) == (1, True)


def test_property_drift_against_plain_ks(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abc.é—") for _ in range(rng.randint(1, 9)))
    a = [" ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(150)] + ["same text"] * 100
    b = [" ".join(word() for _ in range(rng.randint(3, 20))) for _ in range(80)]
    fa, fb = spark.createDataFrame([(x,) for x in a], "t string"), spark.createDataFrame([(x,) for x in b], "t string")
    got = {r["property"]: r["drift_score"] for r in drift.property_drift(fa, fb, "t", rows=8).collect()}
    for name, column in text.text_properties("t").items():
        x, y = ([r[0] for r in f.select(column).collect()] for f in (fa, fb))
        ks = max(abs(sum(v <= c for v in x) / len(x) - sum(v <= c for v in y) / len(y)) for c in set(x + y))
        assert got[name] == pytest.approx(ks, abs=1e-12), name


def test_mean_distance_weights_copies(spark):
    train = frame_of(spark, [(0, 0), (0, 0), (3, 4)])
    assert drift.mean_pair_distance(train, "id", "v").first()[0] == pytest.approx(20 / 9)
    test = frame_of(spark, [(0, 0), (6, 8)])
    got = {r["key"]: (r["mean_distance"], r["drifted"]) for r in drift.distance_drift(train, test, "id", "v").collect()}
    assert got[0] == (pytest.approx(5 / 3), False) and got[1] == (pytest.approx(25 / 3), True)


# --- bias and synthesis ----------------------------------------------------------------------


def test_bias_report_edges(spark):
    rows = [("b1", "p1", 5), ("b1", "p2", 3), ("b2", "p1", 2), ("b3", "p3", 1)]
    report = bias.bias_report(spark.createDataFrame(rows, "query_bucket string, prof_name string, sentiment_score int"))
    got = {(r["dimension"], r["key"]): (r["mean"], r["std"], r["count"]) for r in report.collect()}
    assert got[("query_bucket", "b1")] == (4.0, pytest.approx(math.sqrt(2)), 2)
    assert got[("query_bucket", "b3")] == (1.0, None, 1)
    flags = bias.flagged(report)
    assert {(r["dimension"], r["key"]) for r in flags.collect()} == {("query_bucket", "b3"), ("prof_name", "p3")}
    assert [r["key"] for r in bias.flagged_in_report(flags, report).collect()] == ["b3"]


def test_seed_questions_and_expansion(spark):
    topics = tables.topic_dim(spark)
    rows = spark.createDataFrame([("Intro", "Doe"), ("Intro", "Roe")], "course_title string, faculty_name string")
    got = Counter(r["placeholder"] for r in synthesis.seed_questions(topics, rows, 1).collect())
    assert got == {"topic": 1, "course_name": 4, "professor_name": 1}
    questions = bias.evaluation_questions(rows.select(F.col("faculty_name").alias("prof_name")))
    assert questions.count() == 12 and questions.where("query = 'Would you recommend Doe?'").count() == 1


def test_sample_counts_against_loop(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for series in ("hot", "cold"):
        count, prev = 0, None
        for run in range(600 if series == "hot" else 9):
            if prev is None or prev[0] != synthesis.GENERATE or not prev[1]:
                count = 0
            else:
                count += prev[1]
            status = synthesis.STOP if count >= 500 and prev and prev[0] == synthesis.GENERATE else synthesis.GENERATE
            generated = None if status == synthesis.STOP or rng.random() < 0.02 else rng.randint(0, 60)
            want[(series, run)] = (count, status)
            prev = (status, generated)
            rows.append((series, run, status, generated))
    frame = spark.createDataFrame(rows, "series string, run int, status string, generated int")
    out = synthesis.sample_counts(frame, "series", "run", F.floor(F.col("run") / 64)).collect()
    assert {(r["series"], r["run"]): (r["sample_count"], r["decision"]) for r in out} == want


def test_answers_keep_question_attributes(spark):
    questions = spark.createDataFrame([(1, "Good?", [1.0, 0.0], "b1", "Doe")], "query_id int, query string, query_vector array<double>, query_bucket string, prof_name string")
    base = spark.createDataFrame([(1, [1.0, 0.0], "Doe", "CS1", "c")], "base_id int, embedding array<double>, faculty_name string, subject_course string, content string")
    courses = spark.createDataFrame([("7", "Doe", "1")], "crn string, instructor string, course_code string")
    reviews = spark.createDataFrame([("r", "7", "Q1", "fine")], "review_id string, crn string, question string, response string")
    rows = synthesis.answer_questions(questions, base, courses, reviews, lambda: (lambda prompts: np.array([str(len(p)) for p in prompts], dtype=object)), dim=2).collect()
    assert len(rows) == 1 and rows[0]["query_bucket"] == "b1" and rows[0]["prof_name"] == "Doe"
    assert int(rows[0]["response"]) > len(rows[0]["context"]) > 0


def test_retrain_needs_drift_and_trend(spark):
    history = spark.createDataFrame([("a", 0.1, 1), ("b", 0.1, 2)], "query string, distance double, s int").select("query", "distance", F.timestamp_seconds("s").alias("timestamp"))
    now = F.timestamp_seconds(F.lit(10))
    train = frame_of(spark, [(1, 0.1), (1, 0.2), (1, 0.0)])
    drifted = drift.detect(train, frame_of(spark, [(0.5, 1.0), (1, 0.1)]), "id", "v")
    assert [r["key"] for r in drifted.collect()] == [0]
    assert drift.retrain_decision(drifted, history, now).first()["retrain"] is True
    assert drift.retrain_decision(drifted.limit(0), history, now).first()["retrain"] is False
    assert drift.retrain_decision(drifted, history.limit(1), now).first()["retrain"] is False


def test_generation_cap_and_replies(spark):
    frame = spark.range(80)
    assert synthesis.capped_per_run(frame, ["id"], 50).count() == 51
    replies = spark.createDataFrame([("q", '```json{"queries": ["a", "b"]}```'), ("r", "none")], "query string, reply string")
    assert [r["new_query"] for r in synthesis.queries_from_replies(replies, "reply").collect()] == ["a", "b"]


# --- training and evaluation -----------------------------------------------------------------


@pytest.mark.parametrize("n, test_rows", [(1, 1), (10, 1), (11, 2), (57, 6)])
def test_split_sizes(spark, n, test_rows):
    rows = spark.range(n).select(F.col("id"), F.lit("q").alias("query"))
    split = training.split_rows(rows, "id")
    assert split.where("part = 'test'").count() == test_rows and split.count() == n
    assert training.evaluation_rows(split, 5).count() == min(5, test_rows)


def test_split_drops_null_rows(spark):
    rows = spark.createDataFrame([(i, None if i == 3 else "x") for i in range(20)], "id int, query string")
    assert training.split_rows(rows, "id").count() == 19


def test_evaluation_record_cut(spark):
    rows = spark.createDataFrame([("q", "c" * 60000, "r")], "query string, context string, response string")
    record = json.loads(training.evaluation_jsonl(rows, max_chars=50_000).first()["line"])
    assert len(record["context"]) == 50000 and record["instruction"] == "q" and record["reference"] == "r"


def lcs_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t


def test_common_subsequence_against_table():
    rng = random.Random(9)
    for _ in range(300):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        b = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        t = lcs_table(a, b)
        i, j, want = len(a), len(b), []
        while i and j:
            if a[i - 1] == b[j - 1]:
                want.append(i - 1)
                i, j = i - 1, j - 1
            elif t[i][j - 1] > t[i - 1][j]:
                j -= 1
            else:
                i -= 1
        assert evaluation.common_subsequence(a, b) == want[::-1]


def test_summary_union(spark):
    # the worked example of the summary-level score: union of w1 w2 and w1 w3 w5 covers four of five words
    rows = spark.createDataFrame([(1, "w1 w2 w6 w7 w8\nw1 w3 w8 w9 w5", "w1 w2 w3 w4 w5")], "id int, prediction string, reference string")
    assert evaluation.rouge_l(rows, "id").first()["rouge_l"] == pytest.approx(2 * (4 / 10) * (4 / 5) / (4 / 10 + 4 / 5))


def py_rouge_sum(p, r):
    """Union of common words per reference line, clipped by the word counts of both sides."""
    ref, cand = ([line.split() for line in x.split("\n")] for x in (r, p))
    n_ref, n_cand = sum(map(len, ref)), sum(map(len, cand))
    left, right = Counter(w for s in ref for w in s), Counter(w for s in cand for w in s)
    hits = 0
    for s in ref:
        union = set()
        for c in cand:
            t, i, j = lcs_table(s, c), len(s), len(c)
            while i and j:
                if s[i - 1] == c[j - 1]:
                    union.add(i - 1)
                    i, j = i - 1, j - 1
                elif t[i][j - 1] > t[i - 1][j]:
                    j -= 1
                else:
                    i -= 1
        for at in sorted(union):
            if left[s[at]] > 0 and right[s[at]] > 0:
                hits += 1
                left[s[at]] -= 1
                right[s[at]] -= 1
    return 2 * hits / (n_ref + n_cand) if hits else 0.0


def test_summary_score_against_tables(spark):
    rng = random.Random(12)
    block = lambda: "\n".join(" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(1, 4)))
    pairs = [(i, block(), block()) for i in range(80)]
    frame = spark.createDataFrame(pairs, "id int, prediction string, reference string")
    got = {r["key"]: r["rouge_l"] for r in evaluation.rouge_l(frame, "id").collect()}
    for i, p, r in pairs:
        assert got[i] == pytest.approx(py_rouge_sum(p, r)), (p, r)


def py_bleu(p, r, smooth):
    if not p or not r:
        return 0.0
    total = 0.0
    for n in range(1, 5):
        grams = lambda x: Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))  # noqa: E731,B023
        a, b = grams(p), grams(r)
        hit, all_ = sum((a & b).values()), sum(a.values())
        if smooth and n > 1:
            if not all_ and not sum(b.values()):
                return 0.0
            hit, all_ = hit + 1, all_ + 1
        if not hit or not all_:
            return 0.0
        total += math.log(hit / all_)
    return math.exp(total / 4 + (0 if len(p) >= len(r) else 1 - len(r) / len(p)))


def test_overlap_scores_against_counters(spark):
    rng = random.Random(10)
    line = lambda: " ".join(rng.choice(["a", "b", "c", "dd"]) for _ in range(rng.randint(0, 12)))
    pairs = [(i, line(), line()) for i in range(60)] + [(60, "a b c d e", "A, b c d e."), (61, "x", "y"), (62, "", "")]
    frame = spark.createDataFrame(pairs, "id int, prediction string, reference string")
    words = lambda s: [w for w in s.lower().replace(",", " ").replace(".", " ").split()]
    plain = {r["key"]: r["bleu"] for r in evaluation.bleu(frame, "id").collect()}
    rouge = {(r["key"], r["n"]): r["fmeasure"] for r in evaluation.rouge_n(frame, "id").collect()}
    for i, p, r in pairs:
        assert plain[i] == pytest.approx(py_bleu(words(p), words(r), False)), i
        for n in (1, 2):
            a, b = (Counter(tuple(x[k : k + n]) for k in range(len(x) - n + 1)) for x in (words(p), words(r)))
            both = sum(a.values()) + sum(b.values())
            assert rouge[(i, n)] == pytest.approx(2 * sum((a & b).values()) / both if both else 0.0)
    assert plain[60] == pytest.approx(1.0) and plain[61] == 0.0


def test_gate(spark):
    best = spark.createDataFrame([("bleu/mean", 0.2), ("rouge_l_sum/mean", 0.3)], "metric string, value double")
    now = lambda b, r: spark.createDataFrame([("bleu/mean", b), ("rouge_l_sum/mean", r), ("other", 0.0)], "metric string, value double")
    assert evaluation.model_gate(now(0.2, 0.3), best).first()["deploy"] is True
    assert evaluation.model_gate(now(0.9, 0.29), best).first()["deploy"] is False
    assert evaluation.model_gate(now(0.9, 0.9).where("metric <> 'bleu/mean'"), best).first()["deploy"] is False


def test_courses_leave_before_the_match_join(spark, corpus):
    """With a cut, the match join meets at most as many courses per hit as fill the context."""
    _, _, courses, reviews = corpus
    frame = spark.createDataFrame(courses, "crn string, instructor string, course_code string")
    sizes = retrieval._review_sizes(spark.createDataFrame(reviews, "review_id string, crn string, question string, response string"))
    sized = frame.join(sizes, "crn")
    limit = 200
    whole, kept = (retrieval.first_courses(sized, False, n).collect() for n in (None, limit))
    assert len(kept) < len(whole)
    for name in {r["faculty_name"] for r in whole}:
        own = sorted((r for r in whole if r["faculty_name"] == name), key=lambda r: r["crn"])
        start, want = 0, set()
        for r in own:
            if start < limit:
                want.add(r["crn"])
            start += r["times"] * (r["review_chars"] + r["n_reviews"])
        assert {r["crn"] for r in kept if r["faculty_name"] == name} == want


def test_entries_make_the_uncut_context(spark, corpus):
    queries, base, courses, reviews = corpus
    frames = (
        spark.createDataFrame(queries, "query_id int, query_vector array<double>"),
        spark.createDataFrame(base, "base_id int, embedding array<double>, faculty_name string, subject_course string, content string"),
        spark.createDataFrame(courses, "crn string, instructor string, course_code string"),
        spark.createDataFrame(reviews, "review_id string, crn string, question string, response string"),
    )
    hits = retrieval.catalog_hits(frames[0], frames[1], 5, 3)
    rows = retrieval.context_entries(hits, frames[2], frames[3]).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["position"]):
        crns, texts = got.setdefault(r["query_id"], ([], []))
        crns.append(r["crn"])
        texts.append(r["entry"])
        assert r["position"] == len(crns)
    assert {q: (c, "\n\n".join(e)) for q, (c, e) in got.items()} == plain_contexts(queries, base, courses, reviews, 5, False, None)


def test_overlap_scores_shuffle_nothing(spark):
    """n-grams are counted inside their row: rows that repeat, and nulls, give one score each and no n-gram is shuffled."""
    rows = [("a", "x y x y", "x y z"), ("a", "x y x y", "x y z"), ("a", "x y", "x y"), (None, None, "x"), ("b", "", None)]
    frame = spark.createDataFrame(rows, "id string, prediction string, reference string").coalesce(1)
    for scores in (evaluation.bleu(frame, "id"), evaluation.rouge_n(frame, "id")):
        assert "Exchange" not in scores._jdf.queryExecution().executedPlan().toString()
    found = sorted((str(r["key"]), r["n"], round(r["precision"], 6), round(r["recall"], 6)) for r in evaluation.rouge_n(frame, "id").collect())
    assert found == sorted([
        *[("a", 1, 0.5, 0.666667), ("a", 2, 0.333333, 0.5)] * 2, ("a", 1, 1.0, 1.0), ("a", 2, 1.0, 1.0),
        ("None", 1, 0.0, 0.0), ("None", 2, 0.0, 0.0), ("b", 1, 0.0, 0.0), ("b", 2, 0.0, 0.0),
    ])


def test_matches_are_not_grouped(spark, corpus):
    """Hits fall together before the courses come: no shuffle and no aggregate above the join that makes the matches."""
    queries, base, courses, _ = corpus
    hits = spark.createDataFrame(
        [(q, f, s, c, d) for q, (_, _, f, s, c), d in [(1, base[0], 0.5), (1, base[3], 0.5), (1, base[1], 0.5), (2, base[1], 0.1), (2, base[2], 0.2)]],
        "query_id int, faculty_name string, subject_course string, content string, distance double")
    frame = spark.createDataFrame(courses, "crn string, instructor string, course_code string")
    found = retrieval.course_matches(hits, frame)
    want = Counter()
    for h in hits.collect():
        for crn, instructor, _ in courses:
            if instructor == h["faculty_name"]:
                want[(h["query_id"], crn, h["content"], h["distance"])] += 1
    assert {tuple(r)[:4]: r["copies"] for r in found.collect()} == dict(want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("Join Inner")[0]


def context_frames(spark, corpus):
    queries, base, courses, reviews = corpus
    return (
        spark.createDataFrame(queries, "query_id int, query_vector array<double>"),
        spark.createDataFrame(base, "base_id int, embedding array<double>, faculty_name string, subject_course string, content string"),
        spark.createDataFrame(courses, "crn string, instructor string, course_code string"),
        spark.createDataFrame(reviews, "review_id string, crn string, question string, response string"),
    )


def above_assembly(frame):
    """The part of the plan that handles whole contexts."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    return plan.split("MapInArrow")[0]


@pytest.mark.parametrize("held", [None, 1500, 1])
def test_whole_contexts_are_not_shuffled(spark, corpus, monkeypatch, held):
    """Lists go to the tasks, by one slice of queries after the other where they do not all fit."""
    if held:
        monkeypatch.setattr(retrieval, "LIST_BYTES", held)
        monkeypatch.setattr(retrieval, "BATCH_BYTES", 500)
    found = retrieval.retrieve_context(*context_frames(spark, corpus), k=5, dim=3)
    assert "Exchange" not in above_assembly(found)
    assert {r["query_id"]: (list(r["crns"]), r["content"]) for r in found.collect()} == plain_contexts(*corpus, 5, False, None)


@pytest.mark.parametrize("held", [None, 1500])
def test_lists_are_sent_to_a_few_tasks(spark, corpus, monkeypatch, held):
    """However long the contexts are: before, one slice for each ``LIST_BYTES`` of contexts had its lists sent to it."""
    monkeypatch.setattr(retrieval, "TASK_BYTES", 1)
    if held:
        monkeypatch.setattr(retrieval, "LIST_BYTES", held)
    asked = spark.createDataFrame([(q, [{"list": f"l{q % 3}"}], 40_000) for q in range(500)], "query_id int, _blocks array<struct<list:string>>, _bytes long")
    weights = spark.createDataFrame([(f"l{k}", 1000) for k in range(3)], "_list string, _bytes long")
    dealt, tasks = retrieval._sliced(asked, weights)
    slices = [r["_slice"] for r in dealt.collect()]
    assert tasks == 2 * spark.sparkContext.defaultParallelism and len(slices) == 500
    assert 1 < len(set(slices)) <= tasks and set(slices) <= set(range(tasks))


def test_texts_beyond_memory_wait_in_a_file():
    held = retrieval._Bodies(5)
    for name, body in [("a", b"one"), ("a", None), ("b", b"three"), ("a", b"xy"), ("c", None), ("b", b"")]:
        held.add(name, body)
    assert [held.of(x) for x in "abc"] == [[b"one", b"xy"], [b"three", b""], []]
    held.add("c", b"later")
    assert held.of("c") == [b"later"] and held.free == 0 and held.end == 10


def test_answers_and_prompts_do_not_shuffle_contexts(spark, corpus):
    """Rows of the caller meet the hits, not the texts; repeated, null and unknown ids are those of a join."""
    frames = context_frames(spark, corpus)
    want = plain_contexts(*corpus, 5, True, None)
    asked = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (99, "d"), (2, "e")], "query_id int, `my.tag` string")
    options = {"k": 5, "dim": 3, "match_subject": True}
    found = retrieval.retrieve_context(*frames, **options, rows=asked, how="left")
    rows = retrieval.answers_or_fallback(None, found, "none")
    assert "Exchange" not in above_assembly(rows)
    text = lambda q: want.get(q, (None, None))[1]
    assert sorted((r["my.tag"], r["content"], r["response"]) for r in rows.collect()) == [
        (tag, text(q), None if text(q) else "none") for q, tag in [(1, "a"), (1, "b"), (None, "c"), (99, "d"), (2, "e")]]
    questions = frames[0].withColumn("query", F.lit("Who?"))
    answers = synthesis.answer_questions(questions, *frames[1:], lambda: (lambda p: p), "{query} {content}", **options)
    assert "Exchange" not in above_assembly(answers)
    assert Counter(r["response"] for r in answers.collect()) == Counter(f"Who? {content}" for _, content in want.values())


def test_rows_do_not_wait_for_their_answers(spark, corpus):
    """A row goes through Python with its context: beside a column function, rows wait on disk until Python sends its answers on."""
    frames = context_frames(spark, corpus)
    questions = frames[0].withColumn("query", F.concat(F.lit("Who "), F.col("query_id").cast("string"))).withColumn("my.tag", F.lit("t"))

    def make():
        return lambda prompts: np.array([None if "Who 2" in p else f"{len(prompts)} {len(p)}" for p in prompts], dtype=object)

    answers = synthesis.answer_questions(questions, *frames[1:], make, "{query} {content}", k=5, dim=3, match_subject=True, batch_size=1)
    assert "EvalPython" not in answers._jdf.queryExecution().executedPlan().toString()
    assert answers.columns == ["question", "my.tag", "context", "response"]
    want = plain_contexts(*corpus, 5, True, None)
    assert sorted(map(tuple, answers.collect()), key=repr) == sorted(
        ((f"Who {q}", "t", text, None if q == 2 else f"1 {len(f'Who {q} {text}')}") for q, (_, text) in want.items()), key=repr)
    with pytest.raises(Exception, match="answers to"):
        synthesis.answer_questions(questions, *frames[1:], lambda: (lambda p: p[:0]), "{query}", k=5, dim=3).collect()


def test_whole_contexts_of_missing_contents(spark):
    """A hit without a content has courses but no text; equally near hits share a list."""
    hits = spark.createDataFrame(
        [(1, "A", None, 0.1), (1, "B", "b!", 0.2), (2, "A", None, 0.1), (3, "A", "a", 0.5), (3, "B", "b", 0.5), (None, "B", "", 0.3)],
        "query_id int, faculty_name string, content string, distance double")
    courses = spark.createDataFrame([("8", "A", "1"), ("7", "B", "1"), ("9", "A", "1")], "crn string, instructor string, course_code string")
    reviews = spark.createDataFrame([("r", c, "q", "é.") for c in "789"], "review_id string, crn string, question string, response string")
    got = {r.query_id: (r.crns, r.content) for r in retrieval.contexts(hits, courses, reviews).collect()}
    entry = "Course Information\n{}\nReview Information\nq\né\n\n".format
    assert got == {
        1: (["8", "9", "7"], entry("b")), 2: (["8", "9"], ""), None: (["7"], entry("")),
        3: (["7", "8", "9"], "\n\n".join([entry("b"), entry("a"), entry("a")]))}
