"""Blocks of near vectors, and which pairs of blocks can matter.

A side of at most ``rows`` rows is one block.  A larger one is dealt to the nearest of as many pivots as it fills blocks;
the pivots are rows of the side, chosen by a hash of their key.  Of each block one small row is known: how many rows it
has, its pivot, the largest distance to it, and the smallest and largest distance to each of a few landmarks that both
sides share.  Two bounds follow from the triangle inequality for the distance between any rows of two blocks:

* by pivots: the distance of the pivots, less or plus both radii;
* by landmarks: the gap between the blocks' intervals, or the sum of their far ends.

They only leave out pairs of blocks, never pairs of rows that matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distances from all blocks to as many common rows are kept as bounds.
LANDMARKS = 16
#: Bytes of pivots and bounds that the driver may hold; beyond, blocks grow instead of their number.
INDEX_BYTES = 64 << 20
#: Relative room for rounding in bounds.
SLACK = 1e-9


@dataclass
class Index:
    """One entry per block: rows, pivot, radius, and intervals (blocks, landmarks) of distances."""

    counts: np.ndarray
    pivots: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __len__(self) -> int:
        return len(self.counts)

    def bounds(self, block: int, other: Index) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance that rows of ``block`` and of each block of ``other`` can have."""
        gap = np.sqrt(((other.pivots - self.pivots[block]) ** 2).sum(1))
        reach = other.radius + self.radius[block]
        least, most = gap - reach, gap + reach
        if self.low.shape[1]:
            apart = np.maximum(other.low - self.high[block], self.low[block] - other.high)
            least = np.maximum(least, apart.max(1))
            most = np.minimum(most, (other.high + self.high[block]).min(1))
        room = SLACK * (1.0 + np.abs(most) + np.abs(self.pivots[block]).max(initial=0.0) + np.abs(other.pivots).max(initial=0.0))
        return np.maximum(least - room, 0.0), most + room


def matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` and ``b``, from differences, one row of ``b`` at a time."""
    return np.stack([np.sqrt(((a - x) ** 2).sum(1)) for x in b], 1) if len(b) else np.zeros((len(a), 0))


def block_rows(rows: int, dim: int, block: int) -> int:
    """Rows of a block: ``block``, or more where the index of so many blocks would pass INDEX_BYTES."""
    return max(block, -(-rows * 8 * (dim + 2 * LANDMARKS + 2) // INDEX_BYTES))


def chosen(df: DataFrame, number: int) -> np.ndarray:
    """Vectors of ``number`` rows (id, vector), by a hash of the key, which does not depend on how the table is read."""
    picked = df.orderBy(F.xxhash64("id"), "id").limit(number).select("vector").toArrow()
    return matrix(picked.column(0).combine_chunks()) if picked.num_rows else np.zeros((0, 0))


def placed(df: DataFrame, count: int, rows: int, landmarks: np.ndarray, shape) -> tuple[DataFrame, Index | None]:
    """``block`` and the columns of ``df`` (id, vector, payload; ``count`` rows), and the blocks' index.

    A side of one block has no index.  ``shape`` maps vectors to those whose distances the bounds speak of.
    """
    if count <= rows:
        return df.select(F.lit(0).alias("block"), "*"), None
    pivots = shape(chosen(df, -(-count // rows)))
    shared = df.sparkSession.sparkContext.broadcast((pivots, landmarks))
    kind = df.schema.simpleString().removeprefix("struct<").removesuffix(">")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, landmarks = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                own = shape(matrix(batch.column(1)))
                cell = np.argmin((pivots * pivots).sum(1) - 2.0 * (own @ pivots.T), axis=1).astype(np.int32)
                far = np.sqrt(((own - pivots[cell]) ** 2).sum(1))
                marks = pa.array(list(distances(own, landmarks)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(far), marks, *batch.columns], ["cell", "far", "marks", *batch.schema.names])

    dealt = df.mapInArrow(near, f"cell int, far double, marks array<double>, {kind}")
    ends = [f(F.col("marks")[k]).alias(f"{n}{k}") for n, f in (("low", F.min), ("high", F.max)) for k in range(len(landmarks))]
    found = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far"), *ends).orderBy("cell").collect()
    # a cell that holds more rows than a block is cut by hash; its parts share the bounds
    parts = [max(1, -(-r["n"] // rows)) for r in found]
    first = np.cumsum([0, *parts]).tolist()
    cells = df.sparkSession.createDataFrame([(r["cell"], f, p) for r, f, p in zip(found, first, parts)], "cell int, first int, parts int")
    # as many rows as pivots, which INDEX_BYTES bounds
    dealt = dealt.join(F.broadcast(cells), "cell")
    block = (F.col("first") + F.pmod(F.xxhash64("id"), "parts")).cast("int")
    again = np.repeat(np.arange(len(found)), parts)

    def ends_of(name: str) -> np.ndarray:
        return np.array([[r[f"{name}{k}"] for k in range(len(landmarks))] for r in found], float).reshape(len(found), len(landmarks))[again]

    index = Index(
        np.array([r["n"] // p for r, p in zip(found, parts)])[again], pivots[[r["cell"] for r in found]][again],
        np.array([r["far"] for r in found])[again], ends_of("low"), ends_of("high"))
    return dealt.select(block.alias("block"), *df.columns), index
