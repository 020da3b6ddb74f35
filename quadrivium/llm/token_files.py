"""Token ids in binary files: one concatenated id array per file, with Elias-Fano coded document boundaries.

A file is ``magic, version, id bytes, shard, part, nulls, least key, n ids``, the keys and the ends of its documents as
two Elias-Fano sequences, and the ids as little-endian integers of 2 bytes (4 when an id needs them).  Documents are in
ascending order of key over all files, in the order of (shard, part).  Files hold about ``FILE_IDS`` ids.

Workers write through pyarrow's file systems to a name of their own and then rename, so a repeated task leaves the same
file.  Reading uses Spark's binary files; a file is decoded where it is read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrivium.llm.common import blocks_for, text_batches, whole_text
from quadrivium.llm.elias_fano import EliasFano, encode
from quadrivium.llm.token_ids import WordIds, loaded
from quadrivium.session import cut_lineage, output_folder, ship_package

MAGIC = b"IDEF"
END_ID = 1
FILE_IDS = 4_000_000
#: Bytes of text that one writing task gets.
TASK_BYTES = 24_000_000

_HEAD = struct.Struct("<4sHHIIIqQ")
MANIFEST = "shard int, part int, n_docs long, n_ids long, n_bytes long"
ROWS = "doc_id long, shard int, part int, place int, local_start long, n_tokens long, ids binary"


def to_bytes(shard: int, part: int, keys: list[int | None], arrays: list[bytes]) -> bytes:
    """One file; keys ascend with nulls first, and each array holds unsigned 32-bit ids."""
    known = np.array([k for k in keys if k is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    spread = [int(k) - least for k in known]
    ids = np.frombuffer(b"".join(arrays), "<u4")
    wide = 2 if not len(ids) or ids.max() < 65536 else 4
    ends = np.cumsum([len(a) // 4 for a in arrays], dtype=np.int64)
    head = _HEAD.pack(MAGIC, 1, wide, shard, part, len(keys) - len(known), least, len(ids))
    return (head + encode(np.array(spread, np.uint64), spread[-1] + 1 if spread else 1)
            + encode(ends, len(ids) + 1) + ids.astype(f"<u{wide}").tobytes())


class TokenFile:
    """Random access to one file's documents."""

    def __init__(self, data: bytes):
        magic, version, self.wide, self.shard, self.part, self.nulls, self.least, self.n_ids = _HEAD.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token file")
        self.data, self.keys = data, EliasFano(data, _HEAD.size)
        self.ends = EliasFano(data, self.keys.end)

    def __len__(self) -> int:
        return len(self.ends)

    def key(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.keys.select(i - self.nulls)

    def span(self, i: int) -> tuple[int, int]:
        """First id and end of document number ``i``."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.span(i)
        return np.frombuffer(self.data, f"<u{self.wide}", end - start, self.ends.end + self.wide * start)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, id_col: str = "doc_id",
                      text_col: str = "text", task_bytes: int = TASK_BYTES, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode, append ``end_id``, write below ``folder``; returns one row per file (``MANIFEST``).

    A null text is empty.  Null keys come first; documents with equal keys are ordered by a hash of their text, and may
    spread over files.  An empty table writes no file.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    order = [F.asc_nulls_first("doc_id"), F.col("_tie")]
    rows = rows.repartitionByRange(blocks_for(rows, size=task_bytes), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        target.create_dir(root, recursive=True)
        ids_of, end, shard = loaded(WordIds, tokenizer), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        keys: list[int | None] = []
        arrays: list[bytes] = []
        held, written = 0, []

        def flush() -> None:
            part = len(written)
            data = to_bytes(shard, part, keys, arrays)
            name, own = f"{root}/tokens-{shard:06d}-{part:04d}.ids", f"{root}/.{uuid.uuid4().hex}"
            with target.open_output_stream(own) as out:
                out.write(data)
            target.move(own, name)
            written.append((shard, part, len(keys), held, len(data)))
            keys.clear()
            arrays.clear()

        for batch in text_batches(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ids_of.ids(text) + end
                if keys and held + len(ids) // 4 > file_ids:
                    flush()
                    held = 0
                keys.append(key)
                arrays.append(ids)
                held += len(ids) // 4
        if keys:
            flush()
        columns = list(zip(*written)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            ["shard", "part", "n_docs", "n_ids", "n_bytes"])

    return cut_lineage(rows.mapInArrow(run, MANIFEST))


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per stored document: ``doc_id, shard, part, place, local_start, n_tokens, ids_crc32`` and its ids.

    ``ids`` are little-endian unsigned 32-bit integers; ``with_ids=False`` leaves them out.
    """
    ship_package(spark)
    fields = "doc_id long, shard int, part int, place int, local_start long, n_tokens long, ids_crc32 long"
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in fields.split(", ")]
    if with_ids:
        fields, types, names = fields + ", ids binary", [*types, pa.binary()], [*names, "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                file = TokenFile(data.as_py())
                n = len(file)
                ends = [file.ends.select(k) for k in range(n)]
                starts = [0, *ends][:n]
                keys = [None] * file.nulls + [file.least + int(k) for k in file.keys.values()]
                ids = np.frombuffer(file.data, f"<u{file.wide}", file.n_ids, file.ends.end)
                arrays = [ids[s:e].astype("<u4").tobytes() for s, e in zip(starts, ends)]
                columns = [keys, [file.shard] * n, [file.part] * n, range(n), starts, [e - s for s, e in zip(starts, ends)],
                           [zlib.crc32(a) for a in arrays]]
                if with_ids:
                    columns.append(arrays)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("content")
    return files.mapInArrow(run, fields)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
               folder: str | None = None) -> DataFrame:
    """Write token files and read them back: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts all ids before.

    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = folder or output_folder(spark)
    files = write_token_files(docs, tokenizer, folder, end_id, id_col, text_col)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    # one row per file; files of a shard first, then shards, so no task meets all of them
    inside = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    above = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    starts = files.withColumn("_in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(shards, "shard").select(
        "shard", "part", (F.col("_above") + F.col("_in")).alias("_before"))
    return read_token_files(spark, folder, with_ids=False).join(starts, ["shard", "part"]).select(
        "doc_id", (F.col("_before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
