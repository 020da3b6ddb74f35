"""Near-duplicate embeddings by E8 lattice hashing.

Each table projects a vector to two blocks of 8 dimensions and decodes both to their nearest E8 lattice points: the
cell.  A vector also probes the cells around its own that its projection is nearest to.  Vectors meet in a cell when one
lies there and the other lies there or probes it; pairs that meet are verified by cosine in double precision.

A pair is counted in the first table where it meets and there once, so links need no list of pairs: blocks of at most
``BLOCK`` by ``BLOCK`` rows return counts and a spanning set of links.  Equal vectors are one row with a weight.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.llm.common import sorted_groups
from quadrivium.llm.components import components
from quadrivium.session import cut_lineage, ship_package

TABLES = 5
PROBES = 8
#: Lattice scale in distances of a pair at the threshold.
SCALE = 4.0
BLOCK = 1024
#: Verified pairs that are traced through the tables at a time.
TRACE = 50_000

CODES = "rep string, weight long, vec binary, cells binary, probes binary, keys array<bigint>"


def lattice_steps() -> np.ndarray:
    """The 240 shortest E8 vectors: two entries of 1 or -1, or eight halves with an even number of minus signs."""
    whole = [v for v in itertools.product((-1, 0, 1), repeat=8) if sum(map(abs, v)) == 2]
    halves = [v for v in itertools.product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + halves, float)


STEPS = lattice_steps()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer vectors with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1).astype(np.int64) & 1)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(1)
    rows = np.arange(len(odd))
    near[odd, worst] += np.where(off[rows, worst] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the nearer of the even integer vector and the even vector shifted by a half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def projections(dim: int, tables: int) -> np.ndarray:
    """(tables, 16, dim), the same on every worker; lengths are kept on average in each block of 8."""
    rng = np.random.default_rng([dim, 8])
    raw = rng.normal(size=(tables, 16, dim))
    if dim >= 16:
        return np.stack([np.linalg.qr(p.T)[0].T * np.sqrt(dim / 8) for p in raw])
    return raw / np.sqrt(8)


def _hash(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of rows of half-integer coordinates."""
    h = np.full(points.shape[:-1], salt & (2**64 - 1), np.uint64)
    for k in range(points.shape[-1]):
        h = (h ^ (points[..., k] * 2).astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def lattice_codes(unit: np.ndarray, salts: np.ndarray, threshold: float, tables: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (n, tables) and probed cells (n, tables, probes) of unit vectors; salts keep labels and dimensions apart."""
    n, dim = unit.shape
    scale = SCALE * np.sqrt(max(2 - 2 * threshold, 1e-12))
    cells, others = np.empty((n, tables), np.int64), np.empty((n, tables, probes), np.int64)
    near = min(probes, len(STEPS))
    for t, p in enumerate(projections(dim, tables)):
        points, moves, costs = [], [], []
        for block in (p[:8], p[8:]):
            x = unit @ block.T / scale
            at = decode(x)
            gain = (x - at) @ STEPS.T  # |x - at - step|^2 is |x - at|^2 + 2 - 2 gain
            best = np.argpartition(-gain, near - 1, 1)[:, :near]
            points.append(at)
            moves.append(np.concatenate([np.zeros((n, 1, 8)), STEPS[best]], 1))
            costs.append(np.concatenate([np.zeros((n, 1)), 2 - 2 * np.take_along_axis(gain, best, 1)], 1))
        joint = (costs[0][:, :, None] + costs[1][:, None, :]).reshape(n, -1)
        order = np.argsort(joint, 1, kind="stable")[:, 1:probes + 1]
        first = points[0][:, None] + np.take_along_axis(moves[0], (order // (near + 1))[:, :, None], 1)
        second = points[1][:, None] + np.take_along_axis(moves[1], (order % (near + 1))[:, :, None], 1)
        cells[:, t] = _hash(np.concatenate(points, 1), t + 1) ^ salts
        others[:, t] = _hash(np.concatenate([first, second], 2), t + 1) ^ salts[:, None]
    return cells, others


def _codes(reps: DataFrame, threshold: float, tables: int, probes: int) -> DataFrame:
    """``reps`` (rep, weight, salt, v) with cells, probes and all keys; rows of one dimension are coded together."""
    ship_package(reps.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                vectors = [np.array(v, float) for v in batch.column(3).to_pylist()]
                salts = batch.column(2).to_numpy(zero_copy_only=False)
                sizes = np.array([len(v) for v in vectors])
                for dim in np.unique(sizes):
                    rows = np.flatnonzero(sizes == dim)
                    v = np.stack([vectors[r] for r in rows])
                    # by a power of two, which changes no angle: squares of very large or small components stay in range
                    v = np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1])
                    unit = v / np.sqrt((v * v).sum(1))[:, None]
                    cells, others = lattice_codes(unit, salts[rows], threshold, tables, probes)
                    keys = np.concatenate([cells[:, :, None], others], 2).reshape(len(rows), -1)
                    part = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array([x.tobytes() for x in v], pa.binary()),
                         pa.array([x.tobytes() for x in cells], pa.binary()), pa.array([x.tobytes() for x in others], pa.binary()),
                         pa.array(list(keys), pa.list_(pa.int64()))],
                        ["rep", "weight", "vec", "cells", "probes", "keys"])

    return reps.select("rep", "weight", "salt", "v").mapInArrow(run, CODES)


def _links_of_group(rep, weight, vec, cells, probes, base, table, threshold):
    """Counted links and a spanning set of links of one block: (ids, counts), (a, b)."""
    _, order = np.unique(rep, return_inverse=True)
    b, q = np.flatnonzero(base), np.flatnonzero(~base)
    norm = np.sqrt((vec * vec).sum(1))
    close = (vec[q] @ vec[b].T) / (norm[q][:, None] * norm[b][None, :]) >= threshold
    i, j = np.nonzero(close)
    i, j = q[i], b[j]
    keep = order[i] != order[j]
    i, j = i[keep], j[keep]
    counted = np.zeros(len(i), bool)
    for at in range(0, len(i), TRACE):
        x, y = i[at:at + TRACE], j[at:at + TRACE]
        same = cells[x] == cells[y]
        there = (probes[x] == cells[y][:, :, None]).any(2)
        back = (probes[y] == cells[x][:, :, None]).any(2)
        first = (same | there | back).argmax(1) == table
        twice = same[:, table] | (there[:, table] & back[:, table])
        counted[at:at + TRACE] = first & (~twice | (order[x] < order[y]))
    i, j = i[counted], j[counted]
    if not len(i):
        return None
    links = np.zeros(order.max() + 1)
    np.add.at(links, order[i], weight[j])
    np.add.at(links, order[j], weight[i])
    label = np.arange(order.max() + 1)
    a, c = order[i], order[j]
    while True:  # smallest label over the block's links
        low = np.minimum(label[a], label[c])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, c, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    names = np.empty(order.max() + 1, object)
    names[order] = rep
    hit = np.flatnonzero(links)
    return names[hit], links[hit].astype(np.int64), names[label[hit]]


def _counted(dealt: DataFrame, threshold: float, tables: int, probes: int) -> DataFrame:
    """Blocks (key, base block, query block) to ``rep, links, root``; a block has at most 2 * BLOCK rows or so."""
    ship_package(dealt.sparkSession)
    block = ["key", "bi", "qi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, block):
            if g.num_rows < 2:
                continue
            raw = g.column("vec").to_pylist()
            base = g.column("base").to_numpy().astype(bool)
            sizes = np.array([len(r) for r in raw])
            if base.all() or not base.any():
                continue
            rep, weight = np.array(g.column("rep").to_pylist(), object), g.column("weight").to_numpy()
            cells = np.stack([np.frombuffer(c, np.int64) for c in g.column("cells").to_pylist()])
            others = np.stack([np.frombuffer(c, np.int64) for c in g.column("probes").to_pylist()]).reshape(len(base), tables, probes)
            for size in np.unique(sizes[base]):
                rows = np.flatnonzero(sizes == size)
                found = _links_of_group(rep[rows], weight[rows], np.stack([np.frombuffer(raw[r]) for r in rows]), cells[rows],
                                        others[rows], base[rows], int(g.column("t")[0].as_py()), threshold)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(found[0]), pa.string()), pa.array(found[1]), pa.array(list(found[2]), pa.string())],
                        ["rep", "links", "root"])

    parts = dealt.repartition(*block).sortWithinPartitions(*block)
    return parts.mapInArrow(run, "rep string, links long, root string")


def near_vectors(vectors: DataFrame, threshold: float, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """One row per vector: id, ``n_links, component_id, kept``.

    Vectors are compared only within equal non-null labels and equal dimensions.  Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, and neither do rows with a null id (their component is null, kept true).
    Equal vectors link with each other.  At the threshold itself a pair meets in one table with a probability of about 0.95 (64
    dimensions, more for closer pairs), so all five miss fewer than one in a million; recall is tested against brute force.
    """
    v, label = F.col("v"), F.col("label")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"), F.col(label_col).alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("id").isNotNull() & label.isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    good = rows.filter(usable)
    reps = good.groupBy("label", "v").agg(F.min("id").alias("least_id"), F.count("*").alias("weight"))
    reps = cut_lineage(reps.withColumn("salt", F.xxhash64("label", F.size("v"))).withColumn(
        "rep", F.concat_ws(":", F.hex(F.xxhash64("label", "v")), F.col("least_id").cast("string"))))
    codes = cut_lineage(_codes(reps, threshold, tables, probes))
    keyed = codes.select("rep", F.posexplode("keys").alias("_k", "key")).select(
        "rep", "key", F.floor(F.col("_k") / (probes + 1)).cast("int").alias("t"), (F.col("_k") % (probes + 1) == 0).alias("own"))
    sizes = keyed.groupBy("key", "t").agg(F.sum(F.col("own").cast("long")).alias("n_base"), F.count("*").alias("n_query")).filter(
        "n_base > 0 AND n_query > 1")
    met = keyed.join(sizes, ["key", "t"])
    nb, nq = F.ceil(F.col("n_base") / BLOCK).cast("int"), F.ceil(F.col("n_query") / BLOCK).cast("int")
    at = F.xxhash64("rep")
    as_query = F.transform(F.sequence(F.lit(0), nb - 1), lambda k: F.struct(
        k.alias("bi"), F.pmod(at, nq).cast("int").alias("qi"), F.lit(0).alias("base")))
    as_base = F.transform(F.sequence(F.lit(0), nq - 1), lambda k: F.struct(
        F.pmod(at, nb).cast("int").alias("bi"), k.alias("qi"), F.lit(1).alias("base")))
    dealt = met.select("rep", "key", "t", F.explode(F.when(F.col("own"), F.concat(as_query, as_base)).otherwise(as_query)).alias("_p")).select(
        "rep", "key", "t", "_p.*")
    found = cut_lineage(_counted(dealt.join(codes.drop("keys"), "rep"), threshold, tables, probes))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = reps.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    lowest = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    facts = named.join(lowest, "component").join(links, "rep", "left").select(
        "label", "v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    linked = good.join(cut_lineage(facts), ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.filter(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", F.col("component_id").cast("long").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
