"""Deduplication of texts and vectors against brute force, and their edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrivium.llm import near_dedup
from quadrivium.llm.components import components
from quadrivium.llm.embedding_dedup import decode, lattice_steps, near_vectors
from quadrivium.llm.exact_dedup import drop_copies, exact_dedup
from quadrivium.llm.near_dedup import drop_near_duplicates, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, keep_id string, _text string, key int"


def frame(spark, rows):
    """Documents with columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()


def closed(links, nodes):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("digest", [None, lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_exact_dedup(spark, digest):
    rows = [(k, random.Random(k % 17).choice(["Aa b", "aA B", "É", "é", "", None, "x" * 50_000, f"t{k % 5}"])) for k in range(300)]
    rows += [(7, rows[7][1]), (1000, "only")]
    args = {"digest": digest} if digest else {}
    got = exact_dedup(frame(spark, rows), salts=4, **args).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    by_id = dict(rows)
    for r in got:
        norm = (by_id[r.doc_id] or "").translate(LOWER)
        assert (r.keep_id, r.group_size) == (max(groups[norm]), len(groups[norm]))
        assert r.kept == (r.doc_id == r.keep_id)
        assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()


def test_exact_dedup_null_ids_and_empty_table(spark):
    got = {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup(frame(spark, [(None, "a"), (1, "A"), (None, "b")])).collect()}
    assert got == {(None, 1, False), (1, 1, True), (None, None, True)}
    assert exact_dedup(frame(spark, [])).count() == 0
    kept = drop_copies(frame(spark, [(1, "a"), (2, "A"), (3, "b")]))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert {r.doc_id for r in kept.collect()} == {2, 3}


def family(rnd, size, base, change):
    words = [f"w{rnd.randrange(5000)}" for _ in range(base)]
    for _ in range(size):
        own = [w if rnd.random() > change else f"v{rnd.randrange(10**6)}" for w in words]
        yield " ".join(own)


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_against_all_pairs(spark, words):
    rnd = random.Random(4)
    texts = [t for change in (0.0, 0.01, 0.03, 0.06, 0.1) for base in (1, 3, 30, 150) for t in family(rnd, 12, base, change)]
    texts += [None, "", "   \n", "One", "ONE", "one two", " ".join(["same"] * 4000)]
    rows = list(enumerate(texts, start=5)) + [(5, texts[0])]
    got = near_duplicates(frame(spark, rows), words).collect()
    assert len(got) == len(rows)
    sets = {i: shingles(t, words) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = closed(links, ids)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (i, len(sets[i]), want[i], want[i] == i) for i in ids}


def test_keys_guarantee_the_signature_distance():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 65536, (500, near_dedup.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(near_dedup.SYMBOLS, 2 * near_dedup.CHUNKS - 1, replace=False)] += 1
    same = near_dedup.chunk_keys(a) == near_dedup.chunk_keys(b)
    assert same.any(1).all()
    assert [int(near_dedup.first_shared(b[k:k + 1], a[k])[0]) for k in range(500)] == same.argmax(1).tolist()


def test_near_duplicates_edge_cases(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (3, "A b c d e f"), (4, "")]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {(None, None, True), (2, 2, True), (3, 2, False), (4, 4, True)}
    assert {r.doc_id for r in drop_near_duplicates(frame(spark, rows)).collect()} == {None, 2, 4}


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (100, 101)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = closed([x for x in links if x[0] != x[1]], {n for x in links if x[0] != x[1] for n in x})
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decoding_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)) * 2
    at = decode(x)
    steps = np.concatenate([lattice_steps(), 2 * np.eye(8), -2 * np.eye(8)])
    assert (np.abs(at * 2 - np.rint(at * 2)) < 1e-9).all() and (np.abs(at.sum(1) % 2) < 1e-9).all()
    near = ((x[:, None] - at[:, None] - steps[None]) ** 2).sum(2).min(1)
    assert (((x - at) ** 2).sum(1) <= near + 1e-9).all()


def test_near_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    vectors = [(c + rng.normal(size=24) * s).astype(np.float32).tolist() for c in centres for s in (0.0, 0.0, 0.05, 0.1, 0.15, 0.2) for _ in range(12)]
    rows = [(k, v, k % 2) for k, v in enumerate(vectors)]
    rows += [(9001, None, 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] + [1.0] * 23, 1), (9004, [None] + [1.0] * 23, 1),
             (9005, vectors[0], None), (9006, [], 0), (9007, [1.0, 2.0], 0), (9008, [1.0, 2.0], 0), (9009, [float("inf")] * 24, 0)]
    df = spark.createDataFrame([(i, v, y, "x", 2) for i, v, y in rows], "vec_id long, embedding array<float>, label int, rep string, t int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, 0.98).collect()}
    good = [(i, np.array(v, float), y) for i, v, y in rows
            if v and y is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(a, b) for k, (a, x, p) in enumerate(good) for b, y, q in good[k + 1:]
             if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98]
    label = closed(links, [i for i, _, _ in rows])
    count = dict.fromkeys(label, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert got == {i: (count[i], label[i], label[i] == i) for i, _, _ in rows}
    assert near_vectors(df.limit(0), 0.98).count() == 0


def test_near_vectors_of_several_dimensions_in_one_cell(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=dim).astype(np.float32).tolist()) for k, dim in enumerate([3, 16, 24] * 40)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)), 0.5)
    good = [(i, np.array(v, float)) for i, v in rows]
    count = dict.fromkeys(range(len(rows)), 0)
    for k, (a, x) in enumerate(good):
        for b, y in good[k + 1:]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.5:
                count[a] += 1
                count[b] += 1
    assert all(sum(count[i] for i, v in rows if len(v) == dim) for dim in (3, 16, 24))
    assert {r.vec_id: r.n_links for r in got.collect()} == count


def test_one_row_of_each_class_where_ids_repeat(spark):
    rows = [(1, "a"), (1, "a"), (1, "A"), (2, "B"), (1, "b"), (3, "c"), (2, "C"), (None, "d"), (None, "d"), (None, "e"), (5, "e")]
    got = sorted((r.text.lower(), r.doc_id or 0) for r in drop_copies(frame(spark, rows)).collect())
    assert got == [("a", 1), ("b", 2), ("c", 3), ("d", 0), ("e", 5)]


def test_near_duplicates_where_different_sets_share_an_id(spark):
    one, two, three = (" ".join(f"{k}{n}" for n in range(60)) for k in "abc")
    rows = [(1, one), (1, two), (7, one + " x"), (8, two + " x"), (1, one), (3, three), (3, three.upper()), (4, ""), (4, " "), (2, three + " x"), (3, "other")]
    got = sorted((r.doc_id, r.text.lower()) for r in drop_near_duplicates(frame(spark, rows)).collect())
    assert [g for g in got if g[0] != 4] == sorted([(1, one), (1, two), (2, three + " x"), (3, "other")])
    assert sum(g[0] == 4 for g in got) == 1
    assert {(r.doc_id, r.component_id) for r in near_duplicates(frame(spark, rows)).collect()} == {
        (1, 1), (7, 1), (8, 1), (2, 2), (3, 2), (3, 3), (4, 4)}


def test_vectors_of_extreme_lengths(spark):
    rows = [(1, [1e200, 2e200, 3e200]), (2, [1e200, 2e200, 3.0001e200]), (3, [3e200, -1e200, 0.0]), (4, [1e-200, 2e-200, 3e-200]), (5, [2e-300, 4e-300, 6e-300])]
    got = near_vectors(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int"), 0.98).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 3, 1), (5, 3, 1)]


def test_sketches_tell_sets_below_the_limit_from_those_at_it():
    rng = np.random.default_rng(11)

    def pair(both, each):
        some = rng.integers(1, 2**63, both + 2 * each, dtype=np.uint64)
        return some[:both + each], np.concatenate([some[:both], some[both + each:]])

    def near(pairs):
        a, b = (near_dedup._sketch_rows(near_dedup.sketches(list(side))) for side in zip(*pairs))
        return near_dedup._differences(a, b) <= near_dedup.most_differences(80)

    at_limit = [pair(*x) for x in [(8, 1), (80, 10), (800, 100), (4, 0)] for _ in range(100)]
    assert near(at_limit).all()
    assert near([pair(62, 19) for _ in range(400)]).mean() < 0.05  # similarity 0.62


def test_members_of_one_key_meet_in_all_blocks(spark, monkeypatch):
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        some = list(base)
        for at in rnd.sample(range(120), 14 if k % 3 else 3):
            some[at] = f"x{rnd.randrange(10**6)}"
        rows.append((k + 1, " ".join(some)))
    monkeypatch.setattr(near_dedup, "CENTRES", 1)
    whole = sorted(near_duplicates(frame(spark, rows), words=1).collect())
    monkeypatch.setattr(near_dedup, "SKETCH_BLOCK", 4)
    assert sorted(near_duplicates(frame(spark, rows), words=1).collect()) == whole
    sets = {i: shingles(t, 1) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {r.doc_id: r.component_id for r in whole} == closed(links, sets)


def test_components_of_stars_take_no_round(spark, monkeypatch):
    """Each round is planned, run and kept by the driver; settled links need none, a chain few."""
    from quadrivium.llm import components as module

    made, real = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: made.append(1) or real(df))
    stars = [(5, 1), (7, 1), (7, 1), (9, 2), (2, 2), (None, 3)]
    found = module.components(spark.createDataFrame(stars, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(1, 1), (5, 1), (7, 1), (2, 2), (9, 2)} and len(made) == 1
    made.clear()
    found = module.components(spark.createDataFrame([(k, k + 1) for k in range(9)], "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(k, 0) for k in range(10)} and len(made) < 6
    assert module.components(spark.createDataFrame([], "a long, b long")).count() == 0
