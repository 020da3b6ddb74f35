"""Lines repeated across documents: two Bloom filters find suspects, and only suspects are shuffled and confirmed.

1. Each task sends the 64-bit hashes of its lines' keys to the segments of a filter of once-seen hashes.  A hash that
   finds itself there has been seen twice.
2. The hashes seen twice fill a second filter, sized by their number.
3. Documents are read again.  Lines that the second filter knows are suspects: their keys and documents are grouped by
   the whole key, which counts the documents exactly and picks the one that keeps the line.
4. Documents without a suspect are done as they are read; the others meet the digests of the keys they lose.

A false positive of a filter only makes one suspect more.  The once-seen filter lives in the tasks of its segments.  The
second one is broadcast while it fits ``max_bytes``; beyond, suspects come by an equi-join of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.llm.bloom_bits import BITS_EACH, Bits, filter_of, segment_of, segments_for
from quadrivium.llm.common import text_batches, whole_text
from quadrivium.session import cut_lineage, ship_package

GAPS = b" \t\n\x0b\x0c\r"
#: One bit of the once-seen filter for so many bytes of text: a line of 20 bytes has four, one of 100 has twenty.
BYTES_A_BIT = 5
#: Segments of the once-seen filter that one task holds (128 KiB each).
SEGMENTS_A_TASK = 64
MAX_BYTES = 64_000_000


def long_enough(key: bytes, least: int) -> bool:
    """Whether a key has ``least`` code points."""
    if len(key) < least or len(key) >= 4 * least or key.isascii():
        return len(key) >= least
    return len(key.decode()) >= least


def line_keys(text: bytes, least: int) -> list[bytes | None]:
    """The key of each line, None where it is too short: ASCII white space stripped, A-Z in lower case."""
    return [key if long_enough(key, least) else None for key in [line.strip(GAPS) for line in text.lower().split(b"\n")]]


def hashed(keys: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64).view(np.int64)


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _row_hashes(rows: DataFrame, least: int) -> DataFrame:
    """``id, hash``: the distinct hashes of each row's keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            own = [hashed(list(dict.fromkeys(k for k in line_keys(t, least) if k is not None))) for t in _bytes(batch.column(1))]
            at = np.repeat(np.arange(len(own)), [len(h) for h in own])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.concatenate(own))], ["id", "hash"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, hash long")


def seen_twice(rows: DataFrame, least: int, bytes_of_text: int) -> DataFrame:
    """``hash`` of every key that several rows have, and of some others by chance; distinct."""
    spark = rows.sparkSession
    segments = segments_for(bytes_of_text // BYTES_A_BIT)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-segments // SEGMENTS_A_TASK))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            own = [set(k for k in line_keys(t, least) if k is not None) for t in _bytes(batch.column(1))]
            values, n = np.unique(hashed([k for keys in own for k in keys]), return_counts=True)
            values = np.concatenate([values, values[n > 1]])  # twice is as good as more
            yield pa.RecordBatch.from_arrays([pa.array(segment_of(values, segments)), pa.array(values)], ["seg", "hash"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = Bits(segments)
        for batch in batches:
            values, n = np.unique(batch.column(1).to_numpy(), return_counts=True)
            again = once.has(values) | (n > 1)
            once.add(values[~again])
            yield pa.RecordBatch.from_arrays([pa.array(values[again])], ["hash"])

    sent = rows.mapInArrow(send, "seg long, hash long").repartition(tasks, "seg")
    return cut_lineage(sent.mapInArrow(meet, "hash long").distinct())


def _marked(rows: DataFrame, least: int, known, kind: str) -> DataFrame:
    """Rows (id, text, own) after a look at their suspects, which ``known`` or else ``own`` knows.

    kind "suspects": ``id, key, digest``; "clean": ``id, text, n_lines`` of rows without any; "rest": ``id, text`` of the others.
    """
    fields = {"suspects": "key binary, digest binary", "clean": "text string, n_lines long", "rest": "text string"}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            texts = _bytes(batch.column(1))
            keys = [line_keys(t, least) for t in texts]
            own = [list(dict.fromkeys(k for k in ks if k is not None)) for ks in keys]
            at = np.repeat(np.arange(len(own)), [len(k) for k in own])
            flat = [k for ks in own for k in ks]
            values = hashed(flat)
            if known is not None:
                hit = known.value.has(values)
            else:
                lists = [set(x or ()) for x in batch.column(2).to_pylist()]
                hit = np.array([h in lists[r] for h, r in zip(values.tolist(), at.tolist())], bool)
            if kind == "suspects":
                some = [flat[k] for k in np.flatnonzero(hit)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at[hit])), pa.array(some, pa.binary()), pa.array([digest(k) for k in some], pa.binary())],
                    ["id", "key", "digest"])
                continue
            clean = np.bincount(at[hit], minlength=len(own)) == 0
            part = batch.select([0, 1])
            if kind == "rest":
                yield part.filter(pa.array(~clean))
            else:
                lines = pa.array([len(k) for k in keys], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, lines], ["id", "text", "n_lines"]).filter(pa.array(clean))

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {fields}")


def _without(rows: DataFrame, least: int) -> DataFrame:
    """``id, text, n_lines, n_dropped`` of rows (id, text, lost) after the lines of ``lost`` digests are gone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            texts, counts, dropped = [], [], []
            for text, lost in zip(_bytes(batch.column(1)), batch.column(2).to_pylist()):
                lines, lost = text.split(b"\n"), set(lost or ())
                kept = [x for x, k in zip(lines, line_keys(text, least)) if k is None or digest(k) not in lost] if lost else lines
                texts.append(b"\n".join(kept))
                counts.append(len(lines))
                dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                ["id", "text", "n_lines", "n_dropped"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string, n_lines long, n_dropped long")


def dedup_lines(docs: DataFrame, least: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text",
                max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, ``text`` without the repeated lines, ``n_lines`` before, ``n_dropped``.

    A line's key is the line stripped of ASCII white space with A-Z in lower case.  Keys of at least ``least`` code points
    found in at least ``min_docs`` (two or more) documents lose all lines but those in the document with the largest id,
    which keeps every repetition.  Rows with one id are one document; a null id is one document too, smaller than any
    other.  A null or empty text is one empty line.  A text that loses all lines is empty.  An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    if min_docs < 2:
        raise ValueError("a line of one document does not repeat")
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    size = int(rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0)
    twice = seen_twice(rows, least, size)
    n = twice.count()
    known, looked = None, rows.withColumn("own", F.lit(None).cast("array<bigint>"))
    if n * BITS_EACH <= 8 * max_bytes:
        known = filter_of(twice, n, max_bytes)
    else:
        own = _row_hashes(rows, least).join(twice, "hash", "left_semi").groupBy("id").agg(F.collect_set("hash").alias("own"))
        own = cut_lineage(own.withColumnRenamed("id", "_id"))
        looked = rows.join(own, F.col("id").eqNullSafe(F.col("_id")), "left").select("id", "text", "own")
    held = _marked(looked, least, known, "suspects")
    if not rows.groupBy("id").count().filter("count > 1").isEmpty():
        held = held.distinct()
    held = cut_lineage(held.groupBy("key", "digest").agg(F.count("*").alias("n"), F.max("id").alias("keep")).filter(
        F.col("n") >= min_docs).select("digest", "keep"))
    lines = _marked(looked, least, known, "suspects").select("id", "digest")
    lost = lines.join(held, "digest").filter(~F.col("id").eqNullSafe(F.col("keep"))).groupBy("id").agg(F.collect_set("digest").alias("lost"))
    lost = lost.withColumnRenamed("id", "_id")
    rest = _marked(looked, least, known, "rest").join(lost, F.col("id").eqNullSafe(F.col("_id")), "left").select("id", "text", "lost")
    clean = _marked(looked, least, known, "clean").withColumn("n_dropped", F.lit(0).cast("long"))
    return clean.unionByName(_without(rest, least)).select(F.col("id").alias(id_col), F.col("text").alias("text"), "n_lines", "n_dropped")
