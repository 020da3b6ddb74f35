import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrivium.operators import blocks, cluster, keyed, ordering, pairs, score, skew
from quadrivium.plans import drift

#: One block, a few, and many with several parts.
SIZES = {"one block": {}, "left blocks": {"block": 60}, "many blocks": {"block": 7}}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    left = rng.normal(size=(50, 4))
    right = rng.normal(size=(120, 4))
    right[40:80] = right[0]  # a third are copies
    right[81] = 0.0
    frame = lambda m: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<double>").repartition(5)
    return left, right, frame(left), frame(right)


def fold(vectors, f, sizes, payload=None):
    _, _, a, b = vectors
    b = b.withColumn("w", F.lit(2)) if payload else b
    return pairs.fold_pairs(
        a, b, f, left_key="id", right_key="id", left_vector="v", right_vector="v", right_payload=payload, **sizes
    ).collect()


def distances(a, b):
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(-1))


def similarities(a, b):
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    return np.divide(a @ b.T, na[:, None] * nb[None, :], out=np.zeros((len(a), len(b))), where=(na[:, None] * nb[None, :]) > 0)


@pytest.mark.parametrize("way", SIZES)
def test_nearest(vectors, way):
    a, b, *_ = vectors
    got = {}
    for r in fold(vectors, pairs.Nearest(5), SIZES[way]):
        got.setdefault(r["left_id"], {})[r["rank"]] = (round(r["distance"], 9), r["right_id"])
    d = np.round(1 - similarities(a, b), 12)
    for i in range(len(a)):
        want = sorted((round(d[i, j], 9), j) for j in range(len(b)))[:5]
        assert [got[i][k] for k in range(1, 6)] == want


@pytest.mark.parametrize("way", SIZES)
def test_minimum_sum_count(vectors, way):
    a, b, *_ = vectors
    low = {r["left_id"]: r["similarity"] for r in fold(vectors, pairs.MinCosine(), SIZES[way])}
    assert np.allclose([low[i] for i in range(50)], similarities(a, b).min(1))
    total = {r["left_id"]: r["total"] for r in fold(vectors, pairs.DistanceSum(), SIZES[way], "w")}
    assert np.allclose([total[i] for i in range(50)], 2 * distances(a, b).sum(1))
    near = {r["left_id"]: r["neighbours"] for r in fold(vectors, pairs.NeighbourCount(1.5), SIZES[way], "w")}
    assert [near[i] for i in range(50)] == (2 * (distances(a, b) <= 1.5).sum(1)).tolist()


@pytest.mark.parametrize("way", SIZES)
def test_nearest_label(vectors, way):
    a, b, *_ = vectors
    got = {r["left_id"]: (r["right_id"], r["label"]) for r in fold(vectors, pairs.NearestLabel(), SIZES[way], "w")}
    d = np.round(distances(a, b), 12)
    assert {i: (int(np.argmin(d[i])), 2) for i in range(50)} == got


def clustered(seed, clusters=12, each=60, dim=8):
    """Unit vectors in tight bunches far from each other."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    rows = np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True), each, 0) + rng.normal(size=(clusters * each, dim)) * 0.004
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_bounds_hold_and_leave_out_most_blocks(spark):
    points = clustered(3)
    frame = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(points)], "id long, vector array<double>, payload int")
    marks = blocks.chosen(frame, blocks.LANDMARKS)
    rows, index = blocks.placed(frame, len(points), 40, marks, np.asarray)
    where = {r["id"]: r["block"] for r in rows.collect()}
    at = np.array([where[i] for i in range(len(points))])
    gaps = distances(points, points)
    looked = 0
    for a in range(len(index)):
        least, most = index.bounds(a, index)
        for b in np.unique(at):
            own = gaps[np.ix_(at == a, at == b)]
            assert not own.size or (least[b] <= own.min() and own.max() <= most[b])
        need = pairs.NeighbourCount(0.05).wanted(least, most, index.counts)
        looked += (at == a).sum() * np.isin(at, np.flatnonzero(need)).sum()
        nearest = pairs.Nearest(5).wanted(least, most, index.counts)
        assert set(at[np.argsort(gaps[at == a], axis=1)[:, :5].ravel()].tolist()) <= set(np.flatnonzero(nearest).tolist())
        farthest = pairs.MinCosine().wanted(least, most, index.counts)
        assert set(at[gaps[at == a].argmax(1)].tolist()) <= set(np.flatnonzero(farthest).tolist())
    assert looked < len(points) ** 2 / 5, "most pairs of blocks cannot hold neighbours"


def test_only_wanted_blocks_are_sent(spark):
    points = clustered(4)
    frame = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(points)], "id long, vector array<double>, payload int")
    sent = {}
    for n in (360, 720):
        part = frame.where(f"id < {n}")
        marks = blocks.chosen(part, blocks.LANDMARKS)
        left, index = blocks.placed(part, n, 60, marks, np.asarray)
        asks = pairs._asks(spark, pairs.NeighbourCount(0.05), index, index, len(index), len(index), 1)
        sent[n] = pairs._meet(left, left, asks, len(index), 1, 1).count()
    assert sent[720] < 3 * sent[360], "rows sent follow the rows, not their square"


@pytest.mark.parametrize("make", [
    lambda: pairs.Nearest(3), pairs.MinCosine, pairs.DistanceSum, lambda: pairs.NeighbourCount(0.6), lambda: pairs.LowestLabel(0.6), pairs.NearestLabel,
])
def test_blocks_that_ask_together_give_the_same_rows(spark, monkeypatch, make):
    """Groups of left blocks and parts of right ones, by distances that rule some blocks out for some of a group."""
    rng = np.random.default_rng(12)
    points = np.concatenate([clustered(6, clusters=5, each=30, dim=4), rng.normal(size=(40, 4))])
    frame = spark.createDataFrame([(i, [float(x) for x in v], i % 7) for i, v in enumerate(points)], "id long, v array<double>, w int").cache()

    def rows(**size):
        found = pairs.fold_pairs(frame, frame, make(), left_key="id", right_key="id", left_vector="v", right_vector="v", right_payload="w", **size)
        return sorted(tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in found.collect())

    one = rows()
    monkeypatch.setattr(pairs, "TASKS_PER_CORE", 1)
    monkeypatch.setattr(pairs, "GROUP_ASKS", 3)
    assert rows(block=12) == one


def test_rows_moved_follow_the_sides_of_a_grid(spark):
    """All pairs of many blocks: before, each left block had every right row sent to it."""
    points = np.random.default_rng(13).normal(size=(480, 4))
    frame = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(points)], "id long, vector array<double>, payload int")
    marks = blocks.chosen(frame, blocks.LANDMARKS)
    left, index = blocks.placed(frame, 480, 10, marks, np.asarray)
    per, most = pairs._grid(len(index), len(index), 10 * 4 * 8, 4)
    groups, parts = -(-len(index) // per), -(-len(index) // most)
    asks = pairs._asks(spark, pairs.DistanceSum(), index, index, groups, len(index), 1, per, most)
    sent = pairs._meet(left, left, asks, groups, 1, parts, per)
    assert sent.where("r_id is not null").count() == 480 * groups and sent.where("l_id is not null").count() == 480 * parts
    assert groups + parts < len(index) / 3
    assert all(pairs._grid(n, n, 8192 * 64 * 8, 24)[0] * 8192 * 64 * 8 <= pairs.GROUP_BYTES for n in (7, 74, 740, 7400)), "a task holds bounded bytes"


def test_a_task_gives_one_link_a_row():
    """Not one for each tile of left rows that a right row is near to."""
    rng = np.random.default_rng(14)
    a, b = (np.concatenate([rng.normal(c, 0.2, (400, 2)) for c in (0, 3, 9)]) for _ in range(2))
    tiles, right = list(pairs.Block(np.arange(1200), a, np.ones(1200)).tiles(50)), pairs.Block(np.arange(1200) + 5000, b, np.ones(1200))
    fold = pairs.Links(0.5)
    state = fold.begin(tiles)
    for other in right.tiles(300):
        state = fold.meet(state, tiles, other, list(range(len(tiles))))
    links = [x for rows, tops in fold.end(state, tiles) for x in zip(rows, tops)]
    assert len(links) <= 2400 and len({r for r, _ in links}) == len(links)
    near = distances(a, b) <= 0.5
    parent = {x: x for x in [*range(1200), *range(5000, 6200)]}

    def joined(pairs_of):
        at = dict(parent)

        def root(x):
            while at[x] != x:
                x = at[x]
            return x

        for one, other in pairs_of:
            one, other = sorted((root(one), root(other)))
            at[other] = one
        return {x: root(x) for x in at}

    assert joined(links) == joined((int(i), int(j) + 5000) for i, j in zip(*np.nonzero(near)))


@pytest.mark.parametrize("scale", [1e-14, 1.0, 1e6, 1e14])
def test_single_precision_changes_no_neighbour(scale):
    rng = np.random.default_rng(15)
    a, b = (rng.normal(size=(200, 8)) * scale for _ in range(2))
    b[:100] = a[:100] + 1e-9 * scale * rng.normal(size=(100, 8))
    gaps = distances(a, b)
    left, right = pairs.Block(np.arange(200), a, np.ones(200)), pairs.Block(np.arange(200), b, np.ones(200))
    for eps in (gaps[5, 5], gaps[3, 150], np.quantile(gaps, 0.3)):
        assert (pairs.within(left, right, eps) == (gaps <= eps)).all()
    fold = pairs.NearestLabel()
    _, dist, ids, _ = fold.finish(fold.update(fold.start(left), left, right), left)
    assert (ids == np.round(gaps, 12).argmin(1)).all() and np.allclose(dist.astype(float), gaps.min(1), rtol=1e-9, atol=1e-12)


def test_rows_without_vectors_and_empty_sides(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "id long, v array<float>")
    some = {r["key"]: r["similarity"] for r in drift.min_similarity(frame, frame, "id", "v").collect()}
    assert some == {1: 0.0, 2: None, 3: 0.0}
    far = {r["key"]: (r["mean_distance"], r["drifted"]) for r in drift.distance_drift(frame, frame, "id", "v").collect()}
    assert far[2] == (None, None) and far[1][0] == pytest.approx(np.sqrt(2) / 2)
    none = frame.where("id > 9")
    args = {"left_key": "id", "right_key": "id", "left_vector": "v", "right_vector": "v"}
    assert pairs.fold_pairs(none, frame, pairs.Nearest(2), **args).count() == pairs.fold_pairs(frame, none, pairs.Nearest(2), **args).count() == 0
    mixed = pairs.fold_pairs(frame, frame.withColumn("v", F.col("v").cast("array<double>")), pairs.Nearest(1), **args)
    assert {r["left_id"]: r["right_id"] for r in mixed.collect()} == {1: 1, 3: 3}


def test_string_keys_and_dimension_check(spark):
    base = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [1.0])], "base_id string, embedding array<double>")
    queries = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, query_vector array<double>")
    got = pairs.vector_topk(queries, base, k=2, dim=2).orderBy("rank").collect()
    assert [(r["base_id"], r["distance"]) for r in got] == [("a", 0.0), ("b", 0.0)]
    with pytest.raises(ValueError):
        pairs.fold_pairs(queries, base, pairs.MinCosine(), left_key="query_id", right_key="base_id", left_vector="query_vector", right_vector="embedding")


def py_dbscan(points, eps, low):
    """{key: label} by plain search; clusters are named by their smallest core key."""
    keys = sorted(points)
    near = {a: [b for b in keys if np.linalg.norm(points[a] - points[b]) <= eps] for a in keys}
    core = {k for k in keys if len(near[k]) >= low}
    label = {}
    for k in keys:
        if k in core and k not in label:
            stack = [k]
            while stack:
                x = stack.pop()
                if x not in label:
                    label[x] = k
                    stack += [y for y in near[x] if y in core]
    for k in keys:
        if k not in core:
            label[k] = min((label[y] for y in near[k] if y in core), default=None)
    return label, core


@pytest.mark.parametrize("sizes", [{}, {"block": 9}])
def test_dbscan_against_plain_search(spark, sizes):
    rng = np.random.default_rng(11)
    points = [rng.normal(c, 0.25, 2) for c in (0, 0, 3, 3, 6) for _ in range(12)]
    points += [np.array([1.5, 1.5 + 0.3 * i]) for i in range(8)] + [np.array([9.0, 9.0])] * 5 + [np.array([-5.0, 8.0])] * 2
    frame = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")
    rows = cluster.dbscan(frame, "id", "v", 0.5, 5, **sizes).collect()
    want, core = py_dbscan(dict(enumerate(points)), 0.5, 5)
    assert len(rows) == len(points)
    assert {r["key"]: r["label"] for r in rows} == want
    assert {r["key"] for r in rows if r["is_core"]} == core
    assert None in want.values() and len(set(want.values())) > 3


@pytest.mark.parametrize("sizes", [{}, {"block": 2}])
def test_dbscan_keeps_key_types_and_null_vectors(spark, sizes):
    rows = [("b", [0.0]), ("a", [0.1]), ("c", [0.2]), ("z", [9.0]), ("n", None)]
    found = cluster.dbscan(spark.createDataFrame(rows, "id string, v array<double>"), "id", "v", 0.25, 3, **sizes)
    assert {r["key"]: r["label"] for r in found.collect()} == {"a": "a", "b": "a", "c": "a", "z": None, "n": None}
    assert cluster.noise_share(found).first()[0] == pytest.approx(0.4)
    negative = [(-1, [0.0]), (5, [0.1]), (6, [0.2]), (7, [9.0])]
    labels = cluster.dbscan(spark.createDataFrame(negative, "id long, v array<double>"), "id", "v", 0.25, 3, **sizes).collect()
    assert {r["key"]: r["label"] for r in labels} == {-1: -1, 5: -1, 6: -1, 7: None}


def test_ties_do_not_depend_on_tiles():
    rng = np.random.default_rng(5)
    for _ in range(200):
        at = rng.normal(size=3) * 1000
        step = rng.normal(size=3)
        left = pairs.Block(np.array([0]), at[None], np.array([0]))
        right = pairs.Block(np.array([4, 2, 9]), np.stack([at + step, at - step, at + 3 * step]), np.array([40, 20, 90]))
        whole, split = pairs.NearestLabel(), pairs.NearestLabel()
        one = whole.finish(whole.update(whole.start(left), left, right), left)
        state = split.start(left)
        for tile in right.tiles(1):
            state = split.update(state, left, tile)
        two = split.finish(state, left)
        assert [list(x) for x in one] == [list(x) for x in two]


def test_within_far_from_the_origin():
    rng = np.random.default_rng(6)
    a, b = (rng.normal(size=(300, 8)) + 3e6 for _ in range(2))
    near = pairs.within(pairs.Block(np.arange(300), a, np.zeros(300)), pairs.Block(np.arange(300), b, np.zeros(300)), 3.5)
    assert (near == (np.sqrt(((a[:, None] - b[None]) ** 2).sum(2)) <= 3.5)).all()


def test_assignment_of_new_points(spark):
    train = spark.createDataFrame([(i, [0.1 * i, 0.0]) for i in range(6)], "id long, v array<double>")
    clusters = cluster.dbscan(train, "id", "v", 0.25, 3)
    new = spark.createDataFrame([(100, [0.2, 0.1]), (101, [9.0, 9.0])], "id long, v array<double>")
    got = {r["key"]: r["label"] for r in cluster.assign_to_clusters(new, clusters, "id", "v", 0.25).collect()}
    assert got == {100: 0, 101: None}
    noise = spark.createDataFrame([(1, [0.0]), (2, [9.0])], "id long, v array<double>")
    nothing = cluster.dbscan(noise, "id", "v", 0.5, 3)
    assert {r["label"] for r in nothing.collect()} == {None}
    assert cluster.assign_to_clusters(noise, nothing, "id", "v", 0.5).count() == 2


def test_connected_labels_on_long_chain(spark):
    nodes = spark.range(300).select(F.col("id").alias("key"))
    order = list(range(250))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(249)], "left_id long, right_id long")
    got = {r["key"]: r["label"] for r in cluster.connected_labels(nodes, links).collect()}
    assert all(got[i] == 0 for i in range(250)) and all(got[i] == i for i in range(250, 300))


def test_running_totals_with_hot_partition(spark):
    rows = [("hot", i, i % 7) for i in range(900)] + [("cold", i, 1) for i in range(5)] + [(None, 1, 4)]
    frame = spark.createDataFrame(rows, "p string, o int, v int").withColumn("b", F.floor(F.col("o") / 100))
    for inclusive in (True, False):
        out = ordering.running_totals(frame, partition=["p"], bucket="b", order=["o"], values={"s": F.col("v")}, inclusive=inclusive)
        got = {(r["p"], r["o"]): r["s"] for r in out.collect()}
        assert len(got) == len(rows)
        sums = {}
        for p, o, v in rows:
            before = sums.get(p, 0)
            sums[p] = before + v
            assert got[(p, o)] == (sums[p] if inclusive else before)


def test_exact_position_and_picks(spark):
    frame = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    rows = ordering.exact_position(frame, "k", 29).collect()
    assert sorted(r["position"] for r in rows) == list(range(1, 2001))
    import hashlib

    digest = lambda k: hashlib.md5(f"{k}#29".encode()).hexdigest()
    assert [r["k"] for r in sorted(rows, key=lambda r: r["position"])] == sorted((r["k"] for r in rows), key=lambda k: (digest(k), k))
    assert [r["k"] for r in ordering.pick(frame.union(frame), "k", 3, 29).collect()] == [r["k"] for r in sorted(rows, key=lambda r: r["position"])][:3]
    with pytest.raises(ValueError):
        ordering.pick_exactly(frame.limit(4), "k", 5, 1)


@pytest.mark.parametrize("limit", [None, 1, 57, 400])
def test_prefix_within(spark, limit):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.7 else "cold", i, "x" * rng.randint(0, 9)) for i in range(400)]
    frame = spark.createDataFrame(rows, "g string, o int, s string")
    got = {(r["g"], r["o"]): r["start"] for r in skew.prefix_within(frame, group=["g"], order=["o"], length=F.length("s"), limit=limit).collect()}
    want, at = {}, {}
    for g, o, s in rows:
        if limit is None or at.get(g, 0) < limit:
            want[(g, o)] = at.get(g, 0)
        at[g] = at.get(g, 0) + len(s)
    assert got == want


def test_a_wide_join_copies_rows_along_a_grid(spark, monkeypatch):
    """Rows of both sides are copied; before, each row of one side was copied to all slices of its key."""
    many = spark.createDataFrame([("a", i) for i in range(400)] + [("b", 1), ("b", 1), (None, 5)], "k string, x int")
    few = spark.createDataFrame([("a", i, None if i % 9 else "t") for i in range(300)] + [("a", 7, None)] * 2 + [("b", 2, "s"), (None, 1, "s")], "k string, y int, z string")
    moved, kind = [], type(many)
    repartition = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, *a: (moved.append(self.count()), repartition(self, *a))[1])
    for weight in (1.0, 50.0):
        moved.clear()
        got = skew.wide_join(many, few, ["k"], ["x"], 100, weight)
        want = many.join(few, "k")
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
        if weight == 1:
            assert len(moved) == 2 and sum(moved) < 20_000  # 120,800 rows in the result; 256 slices took 77,000
        else:
            assert moved[0] < 1300, "what is dear to copy is copied less"


def test_latest_first_and_updates(spark):
    log = spark.createDataFrame([("s", "1", 5, None), ("s", "2", 5, "old"), ("t", "1", 1, "keep")], "session_id string, query_id string, timestamp int, feedback string")
    assert {(r["session_id"], r["query_id"]) for r in keyed.latest_per_key(log, ["session_id"], ["timestamp", "query_id"]).collect()} == {("s", "2"), ("t", "1")}
    assert keyed.first_per_key(log, ["session_id"], ["query_id"]).where("session_id = 's'").first()["query_id"] == "1"
    updates = spark.createDataFrame([("s", "2", "a", 1), ("s", "2", "b", 2), ("zz", "9", "c", 1), ("t", "1", None, 3)], "session_id string, query_id string, feedback string, timestamp int")
    out = {(r["session_id"], r["query_id"]): r["feedback"] for r in keyed.apply_updates(log, updates, ["session_id", "query_id"], "feedback", "timestamp").collect()}
    assert out == {("s", "1"): None, ("s", "2"): "b", ("t", "1"): None}


def test_archive_moves_once(spark, scratch):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    spark.createDataFrame([(1,), (2,)], schema).write.parquet(scratch + "/live")
    assert keyed.archive(spark, scratch + "/live", scratch + "/hist", schema, "b1") == 2
    assert spark.read.schema(schema).parquet(scratch + "/live").count() == 0
    assert spark.read.parquet(scratch + "/hist").count() == 2
    with pytest.raises(ValueError):
        keyed.append_rows(spark.createDataFrame([("x",)], "a string"), scratch + "/live", schema)


def test_map_batches_keeps_failing_rows(spark):
    frame = spark.createDataFrame([(1, 2), (2, 0), (3, 4)], "id int, d int").coalesce(1)

    def divide(pdf: pd.DataFrame) -> pd.DataFrame:
        if (pdf["d"] == 0).any():
            raise ValueError("zero")
        return pdf.assign(r=12.0 / pdf["d"])

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("r", T.DoubleType())])
    got = {r["id"]: (r["r"], r["error"]) for r in score.map_batches(frame, divide, schema).collect()}
    assert got[1] == (6.0, None) and got[3] == (3.0, None)
    assert got[2][1] == "zero"


def test_score_embed_and_lexicon(spark):
    frame = spark.createDataFrame([(1, "good good bad"), (2, "nothing"), (3, "bad"), (4, "GOOD!")], "id int, text string")
    scored = score.score(frame, lambda: (lambda pdf: pdf["text"].str.len()), "n", T.IntegerType())
    assert {r["id"]: r["n"] for r in scored.collect()}[3] == 3
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "word string, valence double")
    got = {r["id"]: r["sentiment_score"] for r in score.lexicon_sentiment(frame, "id", "text", lexicon).collect()}
    assert got == {1: 4, 2: 3, 3: 1, 4: 5}
    vec = {r["id"]: r["embedding"] for r in score.embed(frame, "text", dim=32).collect()}
    assert len(vec[1]) == 32 and abs(sum(x * x for x in vec[1]) - 1) < 1e-6
    own = score.embed(frame, "text", embedder=lambda c: F.array(F.length(c).cast("float")))
    assert own.where("id = 3").first()["embedding"] == [3.0]


@pytest.mark.parametrize("make", [
    lambda: pairs.Nearest(5), pairs.MinCosine, pairs.DistanceSum, lambda: pairs.NeighbourCount(1.1), lambda: pairs.LowestLabel(1.1),
    lambda: pairs.Links(1.1), pairs.NearestLabel,
])
def test_a_fold_holds_one_matrix_of_a_tile(make):
    """Passes over all pairs of a tile are what a fold costs: one matrix of doubles and some of booleans, not one per step."""
    rng = np.random.default_rng(8)
    a, b = (rng.normal(size=(n, 64)) / 8 for n in (1024, 4096))
    left, right = pairs.Block(np.arange(1024), a, np.ones(1024, int)), pairs.Block(np.arange(4096), b, np.arange(4096) % 7)
    fold = make()
    state = fold.update(fold.start(left), left, right)  # what is kept of a tile is made here
    tracemalloc.start()
    fold.update(state, left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.2 * 1024 * 4096 * 8


def test_nearest_among_many_copies():
    """More rows on the limit than a tile may collect: the smallest ids stay."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(3000, 8))
    base[rng.permutation(3000)[:1500]] = base[0]
    ids, at = rng.permutation(3000), np.stack([base[0], base[1]])
    left = pairs.Block(np.arange(2), at, np.zeros(2))
    fold = pairs.Nearest(5)
    state = fold.start(left)
    for tile in pairs.Block(ids, base, ids).tiles(1000):
        state = fold.update(state, left, tile)
    rows, found, dist, rank = fold.finish(state, left)
    whole = np.round(1.0 - pairs.unit(at) @ pairs.unit(base).T, 12)
    for k in (0, 1):
        want = sorted(zip(whole[k], ids))[:5]
        assert [(d, i) for r, i, d in zip(rows, found, dist) if r == k] == want


def test_map_batches_halves_a_failing_batch(spark):
    """One bad row of a thousand costs some twenty calls, not one for every row; large numbers stay exact."""
    calls = spark.sparkContext.accumulator(0)

    def checked(batch):
        calls.add(1)
        if (batch["id"] == 2**60 + 700).any():
            raise ValueError("bad")
        return batch.assign(r=batch["id"] + 1)

    frame = spark.range(2**60, 2**60 + 1000, 1, 1)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("r", T.LongType())])
    rows = score.map_batches(frame, checked, schema).collect()
    assert {r["id"] for r in rows if r["error"]} == {2**60 + 700}
    assert all(r["r"] == (None if r["error"] else r["id"] + 1) for r in rows) and len(rows) == 1000
    assert calls.value < 40


def test_a_scorer_sees_few_bytes_at_once(spark):
    rows = [(k, None if k % 97 == 0 else "x" * (k % 5) * 3000) for k in range(3000)]
    frame = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    most = score.BATCH_BYTES

    def make():
        def size(pdf):
            assert pdf["text"].str.len().sum() <= most
            return pdf["text"].str.len()

        return size

    got = {r["id"]: r["n"] for r in score.score(frame, make, "n", T.LongType()).collect()}
    assert got == {k: None if t is None else len(t) for k, t in rows}
