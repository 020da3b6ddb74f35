"""The pipeline's stages against plain Python, on planted copies, near copies and secrets."""

import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from test_scores import plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from quadrivium.llm import quality

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, row struct<id:long>, digest binary, _row_hash long, _runs string, _kept_id int, `a.b` string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ra", "te", "su", "no") for c in ("", "n", "st")]


def row(i, text, lang="en"):
    return (i, text, lang, (7,), b"d", 1, "r", 2, "ab", len(text or ""))


def documents():
    rnd = random.Random(12)
    words = lambda n: [rnd.choice(WORDS) + str(rnd.randrange(9)) for _ in range(n)]
    rows = [row(k, " ".join(words(40 + k % 30))) for k in range(60)]
    rows += [row(100 + k, rows[k][1].upper() if k % 2 else rows[k][1]) for k in range(12)]  # copies
    for k in range(20, 32):  # near copies: the last word, and two words in the middle
        own = rows[k][1].split()
        rows += [row(200 + k, " ".join(own[:-1] + ["changed"])), row(300 + k, " ".join(own[:9] + ["other", "words"] + own[11:]))]
    rows += [row(400 + k, " ".join(words(50)) + f" password = hunter{k}22 user=bobby end") for k in range(5)]
    rows += [row(500, None), row(501, ""), row(502, "  "), row(None, rows[3][1]), row(None, None), row(None, "only null " * 9), row(None, "only null " * 9)]
    rows += [rows[50], rows[50], row(50, rows[51][1])]  # a row twice, an id with two texts
    rows += [row(600 + k, "JUNK!! " * 30 + "X" * k) for k in range(25)]
    return rows


def labels():
    return [(k, 1) for k in range(60)] + [(600 + k, 0) for k in range(25)] + [(None, 0)]


def plain_exact(rows):
    classes = defaultdict(list)
    for r in rows:
        classes[(r[1] or "").translate(LOWER)].append(r)
    out = []
    for own in classes.values():
        best = max(own, key=lambda r: (r[0] is not None, r[0] or 0))[0]
        out.append(next(r for r in own if r[0] == best))
    return out


def plain_near(rows, words=5, percent=80):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()

    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    group[root(a)] = root(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root(k)] = min(least.get(root(k), r[0]), r[0])
    return [r for k, r in enumerate(rows) if r[0] is None or least[root(k)] == r[0]]


def plain_redacted(text):
    if text is None:
        return None
    out, runs = [], []
    for s, e, _ in plain_spans(text):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    at = 0
    for s, e in runs:
        out += [text[at:s], "[secret]"]
        at = e
    return "".join(out) + text[at:]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, written and read again as on a cluster."""
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels(), "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, folder).write.parquet(f"{folder}/{k}")
        before = spark.read.parquet(f"{folder}/{k}")
        found[name] = before.collect()
    return docs, found, folder


def plain(rows):
    return Counter((r[0], r[1], r[9]) for r in rows)


def test_quality_stage(spark, stages):
    docs, found, folder = stages
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = [r for r in docs.collect() if (model.scores(np.array([model.features(r[1])]))[0] if r[1] else model.prior) >= quality.THRESHOLD]
    assert plain(found["quality classifier"]) == plain(want)
    left = {r.doc_id for r in found["quality classifier"]}
    assert not left & set(range(600, 625)) and set(range(60)) <= left, "junk goes, clean documents stay"


def test_exact_stage(stages):
    _, found, _ = stages
    assert plain(found["exact dedup"]) == plain(plain_exact(found["quality classifier"]))


def test_near_stage(stages):
    _, found, _ = stages
    want = plain_near(found["exact dedup"])
    assert plain(found["MinHash near-dedup"]) == plain(want)
    assert len(want) < len(found["exact dedup"]) - 10


def test_secret_stage(stages):
    _, found, _ = stages
    before, after = found["MinHash near-dedup"], found["secret scans"]
    want = Counter((r[0], plain_redacted(r[1])) for r in before)
    assert Counter((r[0], r[1]) for r in after) == want
    assert any("[secret]" in (r[1] or "") for r in after) and all(r.n_chars == len(r[1] or "") for r in after)


def test_packing_stage(stages):
    _, found, _ = stages
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in found["secret scans"]:
        ids = np.array(lib.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % 1024 or 1024
        for k, s in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[s:first if not k else s + 1024]
            want[(r[0], k, s, len(part), zlib.crc32(part.tobytes()))] += 1
    got = found["best-fit packing"]
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    room = defaultdict(list)
    for r in got:
        room[r.sequence_id].append((r.offset, r.length))
    for items in room.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024


def test_columns_stay_whatever_their_names(stages):
    docs, found, _ = stages
    for name in list(found)[:-1]:
        assert found[name][0].__fields__ == docs.columns
        assert all(tuple(r)[3:9] == ((7,), bytearray(b"d"), 1, "r", 2, "ab") for r in found[name])


def test_run_and_empty_tables(spark, stages, tmp_path):
    _, found, folder = stages
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, folder).collect()) == Counter(
        (r.doc_id, r.piece, r.ids_crc32) for r in found["best-fit packing"])
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
def test_on_the_driver_tables(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "secret scans", "best-fit packing"]
    assert corpus_pipeline.run(spark, SF).count() > 0
