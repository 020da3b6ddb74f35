"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrivium.session import cut_lineage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that one block or task should hold; all counts of blocks follow from the input's size.
BLOCK_BYTES = 8_000_000


def whole_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def held_out(key: str, folds: int) -> Column:
    """Whether the checksum of a key's decimal form falls into fold 0; a null key does not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == 0, F.lit(False))


def marked_rows(docs: DataFrame, id_col: str, digest: Column, marks: DataFrame) -> DataFrame:
    """One whole row of ``docs`` for each of ``marks``: ``_kept_id, _kept_digest``, and ``_n``, how many rows have both.

    Of several rows the one whose values have the smallest digest stays.
    """
    marks = cut_lineage(marks)
    keyed = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), digest.alias("digest"))
    same = F.col("id").eqNullSafe(F.col("_kept_id")) & (F.col("digest") == F.col("_kept_digest"))
    repeated = marks.filter("_n > 1")
    if repeated.isEmpty():
        return keyed.join(marks, same, "left_semi").select("row.*")
    one = keyed.join(marks.filter("_n = 1"), same, "left_semi").select("row.*")
    many = keyed.join(repeated, same, "left_semi").groupBy("id", "digest").agg(
        F.min_by("row", F.sha2(F.col("row").cast("string"), 256)).alias("row"))
    return one.unionByName(many.select("row.*"))


def whole_row(docs: DataFrame) -> Column:
    """All columns in one struct, where no name of theirs meets a name made here."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def blocks_for(df: DataFrame, column: str = "text", size: int = BLOCK_BYTES) -> int:
    """How many blocks of about ``size`` bytes the column's texts fill (one aggregate of one row)."""
    total = df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"]
    return max(1, -(-int(total or 0) // size))


def text_batches(batches: Iterator[pa.RecordBatch], text: int = 1, rows: int = 2000, size: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of at most ``rows`` rows and, beyond one row, about ``size`` bytes of text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = min(at + rows, max(at + 1, int(np.searchsorted(ends, base + size, side="right"))))
            yield batch.slice(at, stop - at)
            at = stop


def sorted_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Runs of equal integer ``columns`` in rows sorted by them; the caller bounds how long a run may be."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        key = np.stack([table.column(c).to_numpy().astype(np.int64) for c in columns], 1)
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        if len(cuts):
            done = table.slice(0, cuts[-1]).combine_chunks()
            for s, e in zip([0, *cuts[:-1]], cuts):
                yield done.slice(s, e - s)
            table = table.slice(cuts[-1])
        rest = table
    if rest is not None and rest.num_rows:
        yield rest
