"""All-pairs vector work folded to small results per left row; pairs are never emitted.

A *fold* turns the distances between a tile of left rows and a tile of right rows into a small state per left row (its k
nearest, a minimum, a sum, a count).  Both sides are dealt to blocks of bounded size.  Each left block asks for the right
blocks that its index does not rule out, the right rows come to it by an equi-join on the block's number, and a task
folds them one block after the other.

Tasks are a grid: several left blocks ask together, and their right blocks are cut into parts.  A right row is moved once
for each group of left blocks, a left row once for each part, so what is moved grows with the sides of the grid.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrivium.operators import blocks
from quadrivium.session import ship_package

#: Rows of a block, and right blocks that one task looks at: those of one left block, and at most those of several.
BLOCK_ROWS = 8192
ASKS = 64
GROUP_ASKS = 16
#: Bytes of vectors of left blocks that ask together, and tasks a core that are worth more copies of rows.
GROUP_BYTES = 34_000_000
TASKS_PER_CORE = 4
LEFT_TILE = 1024
RIGHT_TILE = 2048
#: Right rows whose distances give the nearest rows of a tile a first limit.
FIRST_LOOK = 512
#: Pairs of rows that make a task worthwhile.
PAIRS_PER_TASK = 20_000_000


@dataclass
class Block:
    """Ids, vectors and an optional payload column (label or weight) of some rows."""

    ids: np.ndarray
    vectors: np.ndarray
    payload: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    @cached_property
    def unit(self) -> np.ndarray:
        return unit(self.vectors)

    @cached_property
    def places(self) -> np.ndarray:
        """Place of each row by id."""
        return _ranks(self.ids)

    def tiles(self, size: int) -> Iterator[Block]:
        for i in range(0, len(self), size):
            yield Block(self.ids[i : i + size], self.vectors[i : i + size], self.payload[i : i + size])


def to_block(batch) -> Block:
    """Arrow columns (id, vector, payload) to numpy."""
    if isinstance(batch, pa.Table):
        batch = batch.combine_chunks()
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in batch.columns[:3]]
    else:
        columns = batch.columns[:3]
    columns = [pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for c in columns]
    n = len(columns[0])
    flat = columns[1].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return Block(
        columns[0].to_numpy(zero_copy_only=False),
        flat.reshape(n, -1) if n else np.zeros((0, 0)),
        columns[2].to_numpy(zero_copy_only=False),
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    sizes = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, sizes, out=np.zeros_like(vectors), where=sizes > 0)


def cosine_distance(left: Block, right: Block) -> np.ndarray:
    """1 - cosine, at a resolution of 1e-12 so that equal vectors tie exactly."""
    return np.round(1.0 - left.unit @ right.unit.T, 12)


def squares(left: Block, right: Block, room: float | None = None) -> tuple[np.ndarray, float]:
    """Squared Euclidean distances by one matrix product alone, and one bound of all their rounding errors.

    The squared lengths are two more columns of the product, so no pass over the pairs is needed to add them.  They come
    in single precision where that errs by less than ``room``, which takes less than half the time.
    """
    middle = right.vectors.mean(0) if len(right) else 0.0
    a, b = left.vectors - middle, right.vectors - middle
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    size = aa.max(initial=0.0) + bb.max(initial=0.0)
    error = lambda kind: 8.0 * (a.shape[1] + 6) * float(np.finfo(kind).eps) * size + _moved(left, right, middle)
    kind = np.float32 if room is not None and 1e-20 < size < 1e20 and error(np.float32) <= room else np.float64
    ones = lambda rows: np.ones(len(rows))
    one, other = np.column_stack([a, aa, ones(a)]).astype(kind), np.column_stack([-2.0 * b, ones(b), bb]).astype(kind)
    return one @ other.T, error(kind)


def squared_distance(left: Block, right: Block) -> tuple[np.ndarray, np.ndarray]:
    """Squared Euclidean distances by one matrix product, and a bound of their rounding error.

    Both sides are moved next to the origin first: the error grows with the vectors' lengths.
    """
    middle = right.vectors.mean(0) if len(right) else 0.0
    a, b = left.vectors - middle, right.vectors - middle
    sizes = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    return sizes - 2.0 * (a @ b.T), 4.0 * (a.shape[1] + 4) * np.finfo(float).eps * sizes + _moved(left, right, middle)


def _moved(left: Block, right: Block, middle) -> float:
    """Error that moving may add: rounding of coordinates much larger than their differences."""
    if not len(left) or not len(right):
        return 0.0
    reach = max(np.abs(left.vectors).max(initial=0.0), np.abs(right.vectors).max(initial=0.0))
    step = 2.0 * np.finfo(float).eps * reach
    width = max(np.abs(left.vectors - middle).max(initial=0.0), np.abs(right.vectors - middle).max(initial=0.0))
    return left.vectors.shape[1] * (4.0 * width * step + step * step)


def euclidean_distance(left: Block, right: Block) -> np.ndarray:
    square, _ = squares(left, right)
    np.maximum(square, 0.0, out=square)
    return np.sqrt(square, out=square)


def _direct(left: Block, right: Block, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Distances of some pairs from their differences."""
    gap = left.vectors[rows] - right.vectors[cols]
    return np.sqrt((gap * gap).sum(1))


def _true(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that are true; of few, several times faster than to look for both at once."""
    return np.divmod(np.flatnonzero(matrix), matrix.shape[1])


def within(left: Block, right: Block, eps: float) -> np.ndarray:
    """Boolean matrix of pairs at most ``eps`` apart; pairs that rounding could move across are computed directly."""
    for single in (0.01 * eps * eps, None):
        square, error = squares(left, right, single)
        room = error + 1e-9 * eps * eps
        result = square <= eps * eps + room
        sure = square < eps * eps - room
        doubtful = np.count_nonzero(result) - np.count_nonzero(sure)
        if not doubtful:
            return result
        if square.dtype == np.float64 or doubtful <= result.size // 500:
            break
    rows, cols = _true(result ^ sure)
    for at in range(0, len(rows), 200_000):
        r, c = rows[at:at + 200_000], cols[at:at + 200_000]
        result[r, c] = _direct(left, right, r, c) <= eps
    return result


class Fold:
    """State per left tile; subclasses say how tiles update it, how partial rows merge, and which blocks matter."""

    #: Pairs farther apart than this Euclidean distance do not matter (None: all may).
    radius: float | None = None
    #: Bounds speak of unit vectors.
    by_angle = False

    def wanted(self, least: np.ndarray, most: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Which right blocks a left block needs, by the bounds of their distances and their rows."""
        return least <= np.inf if self.radius is None else least <= self.radius

    def fields(self, left_type, right_type, payload_type) -> list[T.StructField]:
        raise NotImplementedError

    def start(self, left: Block):
        raise NotImplementedError

    def update(self, state, left: Block, right: Block):
        raise NotImplementedError

    def finish(self, state, left: Block) -> list[np.ndarray]:
        raise NotImplementedError

    def begin(self, tiles: list[Block]):
        """State of all left tiles of a task, ``meet`` a right tile with those of them it may matter to, and the rows of ``end``."""
        return [self.start(t) for t in tiles]

    def meet(self, states, tiles: list[Block], right: Block, which: list[int]):
        for k in which:
            states[k] = self.update(states[k], tiles[k], right)
        return states

    def end(self, states, tiles: list[Block]) -> Iterator[list[np.ndarray]]:
        return (self.finish(s, t) for s, t in zip(states, tiles))

    def merge(self, partial: DataFrame) -> DataFrame:
        raise NotImplementedError


class Nearest(Fold):
    """The ``k`` nearest right rows by cosine distance, ties by id."""

    by_angle = True

    def __init__(self, k: int):
        self.k = k

    def wanted(self, least, most, counts):
        return least <= _reach(most, counts, self.k)

    def fields(self, left_type, right_type, payload_type):
        return [
            T.StructField("left_id", left_type),
            T.StructField("right_id", right_type),
            T.StructField("distance", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ]

    def start(self, left):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, object), np.full(len(left), np.inf)

    def update(self, state, left, right):
        rows, dists, ids, limit = state
        near = left.unit @ right.unit.T
        some = near[:, :FIRST_LOOK]
        if some.shape[1] > self.k:
            # k rows are this near for certain
            kth = -np.partition(-some, self.k - 1, axis=1)[:, self.k - 1]
            limit = np.minimum(limit, np.round(1.0 - kth, 12))
        seen = near >= (1.0 - limit - 4e-12)[:, None]
        if np.count_nonzero(seen) <= 32 * self.k * len(left):
            r, c = _true(seen)
        else:
            # many lie on the limit (copies, mostly); the k smallest ids of them will do
            by_id = np.argsort(right.places, kind="stable")
            matrix = np.round(1.0 - near[:, by_id], 12)
            if matrix.shape[1] > self.k:
                limit = np.minimum(limit, np.partition(matrix, self.k - 1, axis=1)[:, self.k - 1])
            tied = matrix == limit[:, None]
            tied &= np.cumsum(tied, axis=1) <= self.k
            r, c = np.nonzero((matrix < limit[:, None]) | tied)
            c = by_id[c]
        if not len(r):
            return rows, dists, ids, limit
        rows = np.concatenate([rows, r])
        dists = np.concatenate([dists, np.round(1.0 - near[r, c], 12)])
        ids = np.concatenate([ids.astype(right.ids.dtype) if not len(ids) else ids, right.ids[c]])
        order = np.lexsort((_ranks(ids), dists, rows))
        rows, dists, ids = rows[order], dists[order], ids[order]
        place = _place(rows)
        keep = place < self.k
        rows, dists, ids = rows[keep], dists[keep], ids[keep]
        full = place[keep] == self.k - 1
        limit = limit.copy()
        limit[rows[full]] = dists[full]
        return rows, dists, ids, limit

    def finish(self, state, left):
        rows, dists, ids, _ = state
        return [left.ids[rows], ids, dists, _place(rows) + 1]

    def merge(self, partial):
        w = Window.partitionBy("left_id").orderBy("distance", "right_id")
        ranked = partial.withColumn("rank", F.row_number().over(w))
        return ranked.where(F.col("rank") <= self.k)


class MinCosine(Fold):
    """Smallest cosine similarity to any right row."""

    by_angle = True

    def wanted(self, least, most, counts):
        return most >= least.max(initial=0.0)

    def fields(self, left_type, right_type, payload_type):
        return [T.StructField("left_id", left_type), T.StructField("similarity", T.DoubleType())]

    def start(self, left):
        return np.full(len(left), np.inf)

    def update(self, state, left, right):
        return np.minimum(state, (left.unit @ right.unit.T).min(axis=1))

    def finish(self, state, left):
        return [left.ids, state]

    def merge(self, partial):
        return partial.groupBy("left_id").agg(F.min("similarity").alias("similarity"))


class DistanceSum(Fold):
    """Sum of Euclidean distances, each right row counted ``payload`` times."""

    def fields(self, left_type, right_type, payload_type):
        return [T.StructField("left_id", left_type), T.StructField("total", T.DoubleType())]

    def start(self, left):
        return np.zeros(len(left))

    def update(self, state, left, right):
        return state + euclidean_distance(left, right) @ right.payload.astype(np.float64)

    def finish(self, state, left):
        return [left.ids, state]

    def merge(self, partial):
        return partial.groupBy("left_id").agg(F.sum("total").alias("total"))


class NeighbourCount(Fold):
    """Weighted number of right rows within ``eps``."""

    def __init__(self, eps: float):
        self.eps = self.radius = eps

    def fields(self, left_type, right_type, payload_type):
        return [T.StructField("left_id", left_type), T.StructField("neighbours", T.LongType())]

    def start(self, left):
        return np.zeros(len(left), np.int64)

    def update(self, state, left, right):
        near = within(left, right, self.eps)
        more = right.payload.astype(np.int64) - 1
        copied = np.flatnonzero(more)
        state = state + near.sum(axis=1)
        return state + near[:, copied] @ more[copied] if len(copied) else state

    def finish(self, state, left):
        return [left.ids, state]

    def merge(self, partial):
        return partial.groupBy("left_id").agg(F.sum("neighbours").alias("neighbours"))


class LowestLabel(Fold):
    """Smallest ``payload`` of the right rows within ``eps``; left rows without one give no row."""

    def __init__(self, eps: float):
        self.eps = self.radius = eps

    def fields(self, left_type, right_type, payload_type):
        return [T.StructField("left_id", left_type), T.StructField("label", payload_type)]

    def start(self, left):
        return np.zeros(len(left), bool), np.empty(len(left), object)

    def update(self, state, left, right):
        found, label = state
        order = np.argsort(right.payload, kind="stable")
        right = Block(right.ids[order], right.vectors[order], right.payload[order])
        hits = within(left, right, self.eps)
        rows = np.flatnonzero(hits.any(axis=1))
        best = right.payload[hits[rows].argmax(axis=1)]
        for row, value in zip(rows, best):
            if not found[row] or value < label[row]:
                found[row], label[row] = True, value
        return found, label

    def finish(self, state, left):
        found, label = state
        return [left.ids[found], label[found]]

    def merge(self, partial):
        return partial.groupBy("left_id").agg(F.min("label").alias("label"))


class NearestLabel(Fold):
    """Distance and ``payload`` of the nearest right row by Euclidean distance, ties by id."""

    def wanted(self, least, most, counts):
        return least <= _reach(most, counts, 1)

    def fields(self, left_type, right_type, payload_type):
        return [
            T.StructField("left_id", left_type),
            T.StructField("distance", T.DoubleType()),
            T.StructField("right_id", right_type),
            T.StructField("label", payload_type),
        ]

    def start(self, left):
        n = len(left)
        return np.full(n, np.inf), np.empty(n, object), np.empty(n, object)

    def update(self, state, left, right):
        best, ids, labels = state
        # all that rounding could make the nearest are measured directly, so ties do not depend on the tiles
        for single in (np.inf, None):
            square, error = squares(left, right, single)
            limit = np.minimum(square.min(axis=1).astype(float) + 2.0 * error, best * best + error) * (1 + 1e-11) + 1e-24
            limit = np.nextafter((limit + 1e-11 * (best < np.inf)).astype(square.dtype), np.inf, dtype=square.dtype)
            near = square <= limit[:, None]
            if square.dtype == np.float64 or np.count_nonzero(near) <= len(near) + near.size // 500:
                break
        rows, cols = _true(near)
        if not len(rows):
            return state
        dist = np.round(_direct(left, right, rows, cols), 12)
        order = np.lexsort((right.places[cols], dist, rows))
        first = order[np.concatenate([[True], np.diff(rows[order]) > 0])]
        for row, col, d in zip(rows[first], cols[first], dist[first]):
            if d < best[row] or (d == best[row] and (ids[row] is None or right.ids[col] < ids[row])):
                best[row], ids[row], labels[row] = d, right.ids[col], right.payload[col]
        return best, ids, labels

    def finish(self, state, left):
        best, ids, labels = state
        seen = np.isfinite(best)
        return [left.ids[seen], best[seen], ids[seen], labels[seen]]

    def merge(self, partial):
        nearest = F.min_by(F.struct("distance", "right_id", "label"), F.struct("distance", "right_id"))
        return partial.groupBy("left_id").agg(nearest.alias("n")).select("left_id", "n.*")


class Links(Fold):
    """Links (row, smallest row of its component so far) that connect rows within ``eps``.

    Each task joins the rows it has seen into components and gives one link per row, not one per
    pair or tile.  The links of all tasks together connect exactly the rows that all pairs would connect.
    """

    def __init__(self, eps: float):
        self.eps = self.radius = eps

    def fields(self, left_type, right_type, payload_type):
        return [T.StructField("left_id", left_type), T.StructField("right_id", right_type)]

    def start(self, left):
        return self.begin([left])

    def update(self, state, left, right):
        return self.meet(state, [left], right, [0])

    def finish(self, state, left):
        return next(iter(self.end(state, [left])))

    def begin(self, tiles):
        """The component of each left row, and the ids of right rows that were reached, each with a left row near it."""
        return np.arange(sum(map(len, tiles))), [], []

    def meet(self, state, tiles, right, which):
        own, ids, places = state
        first = np.cumsum([0, *map(len, tiles)])
        reached = np.full(len(right), -1)
        for k in which:
            near = within(right, tiles[k], self.eps)
            hit = near.any(axis=1)
            if not hit.any():
                continue
            own = self._crossed(own, first[k], near)
            # a right row joins the components of the tiles it is near to
            at = near.argmax(axis=1) + first[k]
            again = hit & (reached >= 0)
            own = _joined(own, own[reached[again]], own[at[again]])
            reached = np.where(hit & (reached < 0), at, reached)
        cols = np.flatnonzero(reached >= 0)
        if len(cols):
            ids.append(right.ids[cols])
            places.append(reached[cols])
        return own, ids, places

    def _crossed(self, own, first, near):
        """``own`` after each right row (a row of ``near``) joined the components of all rows of one tile near it."""
        mine = own[first : first + near.shape[1]]
        names, sizes = np.unique(mine, return_counts=True)
        loose = np.flatnonzero(mine != names[sizes.argmax()])
        # only right rows near a row outside the largest component can join any
        some = near[near[:, loose].any(axis=1)]
        lead = mine[some.argmax(axis=1)] if len(some) else mine[:0]
        at, rows = _true(some & (mine[None, :] != lead[:, None]))
        return _joined(own, mine[rows], lead[at])

    def end(self, state, tiles):
        own, ids, places = state
        own = own.tolist()
        lowest = {}
        left = [i for t in tiles for i in t.ids.tolist()]
        for part, row in zip(own, left):
            lowest[part] = min(row, lowest.get(part, row))
        top = np.array([lowest[part] for part in own], dtype=object)
        rows = np.concatenate([np.array(left, dtype=object), *[i.astype(object) for i in ids]])
        tops = np.concatenate([top, *[top[p] for p in places]])
        linked = rows != tops
        yield [rows[linked], tops[linked]]

    def merge(self, partial):
        return partial.distinct()


def _joined(own: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Components after those in ``one`` joined those in ``other``; the smaller number stays."""
    apart = one != other
    if not apart.any():
        return own
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    links = np.unique(one[apart].astype(np.int64) * len(own) + other[apart])
    for a, b in zip((links // len(own)).tolist(), (links % len(own)).tolist()):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    named = np.arange(len(own))
    named[list(parent)] = [root(x) for x in list(parent)]
    return named[own]


def _reach(most: np.ndarray, counts: np.ndarray, k: int) -> float:
    """A distance within which ``k`` rows lie for certain."""
    order = np.argsort(most)
    enough = np.flatnonzero(np.cumsum(counts[order]) >= k)
    return most[order[enough[0]]] if len(enough) else np.inf


def _ranks(ids: np.ndarray) -> np.ndarray:
    if len(ids) == 0:
        return np.zeros(0, np.int64)
    return np.unique(ids, return_inverse=True)[1]


def _place(rows: np.ndarray) -> np.ndarray:
    """0-based place of each entry among equal, adjacent row numbers."""
    if len(rows) == 0:
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.nonzero(np.diff(rows))[0] + 1])
    sizes = np.diff(np.concatenate([starts, [len(rows)]]))
    return np.arange(len(rows)) - np.repeat(starts, sizes)


def _emit(columns: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(list(c) if c.dtype == object else c).cast(f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _narrow(df: DataFrame, key: str, vector: str, payload: str | None) -> DataFrame:
    return df.select(
        F.col(key).alias("id"), F.col(vector).alias("vector"), (F.col(payload) if payload else F.lit(1).cast("int")).alias("payload")
    ).where(F.col("vector").isNotNull())


def _size(df: DataFrame) -> tuple[int, int]:
    width = F.size("vector")
    row = df.agg(F.count("*").alias("n"), F.min(width).alias("low"), F.max(width).alias("high")).first()
    if row["low"] != row["high"]:
        raise ValueError(f"vectors have {row['low']} to {row['high']} components")
    return row["n"], row["high"] or 0


def fold_pairs(
    left: DataFrame,
    right: DataFrame,
    fold: Fold,
    *,
    left_key: str,
    right_key: str,
    left_vector: str,
    right_vector: str,
    right_payload: str | None = None,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Fold the distances of every left row to every right row; keys must be unique per side.

    Rows without a vector are left out.  ``left`` and ``right`` are read several times, so the caller cuts what is
    expensive to make.
    """
    spark = left.sparkSession
    ship_package(spark)
    left, right = _narrow(left, left_key, left_vector, None), _narrow(right, right_key, right_vector, right_payload)
    if left.schema["vector"].dataType != right.schema["vector"].dataType:
        left, right = (df.withColumn("vector", F.col("vector").cast("array<double>")) for df in (left, right))
    schema = T.StructType(fold.fields(*[left.schema["id"].dataType, right.schema["id"].dataType, right.schema["payload"].dataType]))
    n_left, dim_left = _size(left)
    n_right, dim_right = _size(right)
    if n_left and n_right and dim_left != dim_right:
        raise ValueError(f"vector sizes differ: {dim_left} and {dim_right}")
    if not n_left or not n_right:
        return spark.createDataFrame([], schema)
    shape = unit if fold.by_angle else np.asarray
    rows = [blocks.block_rows(n, dim_left, block) for n in (n_left, n_right)]
    marks = shape(blocks.chosen(right, blocks.LANDMARKS)) if n_left > rows[0] and n_right > rows[1] else np.zeros((0, dim_left))
    left, left_index = blocks.placed(left, n_left, rows[0], marks, shape)
    right, right_index = blocks.placed(right, n_right, rows[1], marks, shape)
    # a left side of one block is dealt to as many tasks as its pairs fill
    spread = min(-(-n_left * n_right // PAIRS_PER_TASK), spark.sparkContext.defaultParallelism) if left_index is None else 1
    left_blocks, right_blocks = len(left_index) if left_index else 1, len(right_index) if right_index else 1
    # one right block is needed by all left ones; several are asked for
    per, most = 1, ASKS
    if left_index and right_index:
        per, most = _grid(left_blocks, right_blocks, rows[0] * dim_left * 8, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    shared = spark.sparkContext.broadcast((left_index, right_index)) if left_index and right_index else None
    groups = -(-left_blocks // per)
    asks = None if right_index is None else _asks(spark, fold, shared, None, groups, right_blocks, spread, per, most)
    parts = -(-right_blocks // most)
    tasks = min(groups * spread * parts, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = _meet(left, right, asks, groups, spread, parts, per).repartitionById(tasks, F.pmod("group", F.lit(tasks)).cast("int"))
    folded = met.sortWithinPartitions("group", "from").mapInArrow(_folding(fold, schema, shared, parts, per), schema)
    return folded if parts == 1 and not isinstance(fold, Links) else fold.merge(folded)


def _grid(left_blocks: int, right_blocks: int, block_bytes: int, tasks: int) -> tuple[int, int]:
    """Left blocks that ask together and right blocks of a part, near a square grid of ``tasks`` within what a task may hold."""
    pairs = left_blocks * right_blocks
    per = max(1, min(math.isqrt(pairs // tasks), GROUP_BYTES // block_bytes))
    return per, max(1, min(-(-pairs // (per * tasks)), GROUP_ASKS))


def _needed(fold: Fold, left_index, right_index, own: int) -> np.ndarray:
    """Whether each right block matters to the left block ``own``."""
    least, most = left_index.bounds(own, right_index)
    return fold.wanted(least, most, right_index.counts)


def _asks(spark, fold: Fold, left_index, right_index, left_blocks: int, right_blocks: int, spread: int, per: int = 1, most: int = ASKS) -> DataFrame:
    """``own, from, part``: which right block each left block (``per`` of them together) needs, and in which of its parts.

    ``left_index`` may be a broadcast of both.
    """
    shared = left_index
    if left_index is not None and right_index is not None:
        shared = spark.sparkContext.broadcast((left_index, right_index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column(0).to_pylist():
                need = np.arange(right_blocks)
                if shared is not None:
                    mine, other = shared.value
                    members = range(own * per, min((own + 1) * per, len(mine)))
                    need = np.flatnonzero(np.any([_needed(fold, mine, other, m) for m in members], axis=0))
                part = np.arange(len(need)) // most
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(need), own, np.int32)), pa.array(need.astype(np.int32)), pa.array(part.astype(np.int32))], ["own", "from", "part"])

    asks = spark.range(left_blocks).select(F.col("id").cast("int").alias("own")).mapInArrow(run, "own int, from int, part int")
    return asks.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))) if spread > 1 else asks.withColumn("piece", F.lit(0))


def _meet(left: DataFrame, right: DataFrame, asks: DataFrame | None, left_blocks: int, spread: int, parts: int, per: int = 1) -> DataFrame:
    """Rows ``group, from, l_id, r_id, vector, payload``; those of left blocks come first in a group.

    The first of ``per`` left blocks has ``from`` -1, the next -2.
    """
    group = (F.col("own").cast("long") * spread + F.col("piece")) * parts + F.col("part")
    columns = ["group", "from", "l_id", "r_id", "vector", "payload"]
    if asks is None:
        to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else F.lit(0)
        came = right.withColumn("own", to_all(left_blocks)).withColumn("piece", to_all(spread)).withColumns({"from": F.lit(0), "part": F.lit(0)})
    else:
        came = asks.join(right, F.col("from") == F.col("block"))
    came = came.select(
        group.alias("group"), "from", F.lit(None).cast(left.schema["id"].dataType).alias("l_id"), F.col("id").alias("r_id"), "vector", "payload")
    own = left.withColumn("own", F.floor(F.col("block") / per)).withColumn("piece", F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))) if parts > 1 else F.lit(0))
    own = own.select(group.alias("group"), (-1 - F.col("block") % per).cast("int").alias("from"), F.col("id").alias("l_id"),
                     F.lit(None).cast(right.schema["id"].dataType).alias("r_id"), "vector", F.lit(None).cast(right.schema["payload"].dataType).alias("payload"))
    return own.select(*columns).union(came.select(*columns))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Table]]:
    """``group, from, rows`` of rows sorted by both."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        key = np.stack([table.column(k).to_numpy() for k in (0, 1)], 1)
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        for s, e in zip([0, *cuts[:-1]], cuts):
            yield int(key[s, 0]), int(key[s, 1]), table.slice(s, e - s)
        rest = table.slice(cuts[-1]) if len(cuts) else table
    if rest is not None and rest.num_rows:
        yield rest.column(0)[0].as_py(), rest.column(1)[0].as_py(), rest


def _folding(fold: Fold, schema: T.StructType, shared=None, parts: int = 1, per: int = 1):
    out = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tiles, needs, state = None, [], [], None

        def ended() -> Iterator[pa.RecordBatch]:
            last = state if state is not None or not tiles else fold.begin(tiles)
            return (_emit(columns, out) for columns in fold.end(last, tiles)) if tiles else iter(())

        for group, source, rows in _runs(batches):
            if source < 0:
                if group != held:
                    yield from ended()
                    held, tiles, needs, state = group, [], [], None
                found = list(to_block(rows.select(["l_id", "vector", "payload"])).tiles(LEFT_TILE))
                need = None if shared is None else _needed(fold, *shared.value, group // parts * per - 1 - source)
                tiles, needs = tiles + found, needs + [need] * len(found)
            elif group == held:  # else no left row fell into the group
                if state is None:
                    state = fold.begin(tiles)
                mine = [k for k, need in enumerate(needs) if need is None or need[source]]
                for other in to_block(rows.select(["r_id", "vector", "payload"])).tiles(RIGHT_TILE) if mine else ():
                    state = fold.meet(state, tiles, other, [k for k in mine if not _apart(tiles[k], other, fold.radius)])
        yield from ended()

    return run


def _apart(left: Block, right: Block, radius: float | None) -> bool:
    """Whether no rows of two tiles can be within ``radius``, by the middle of the right one."""
    if radius is None:
        return False
    middle = right.vectors.mean(0)
    reach = np.sqrt(((right.vectors - middle) ** 2).sum(1).max())
    gap = np.sqrt(((left.vectors - middle) ** 2).sum(1).min())
    return gap - reach > radius + blocks.SLACK * (1.0 + gap + reach + np.abs(middle).max(initial=0.0))


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def distinct_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """One row per distinct vector: smallest key and number of copies."""
    return df.groupBy(F.col(vector).alias("vector")).agg(F.min(key).alias("key"), F.count("*").alias("copies"))


def vector_topk(
    queries: DataFrame,
    base: DataFrame,
    *,
    k: int,
    dim: int,
    query_key: str = "query_id",
    query_vector: str = "query_vector",
    base_key: str = "base_id",
    base_vector: str = "embedding",
    **sizes: int,
) -> DataFrame:
    """The ``k`` nearest base rows of each query by cosine distance; other dimensions are left out."""
    found = fold_pairs(
        queries.where(F.size(query_vector) == dim),
        base.where(F.size(base_vector) == dim),
        Nearest(k),
        left_key=query_key,
        right_key=base_key,
        left_vector=query_vector,
        right_vector=base_vector,
        **sizes,
    )
    return found.select(
        F.col("left_id").alias(query_key), F.col("right_id").alias(base_key), "distance", F.col("rank").cast("int").alias("rank")
    )
