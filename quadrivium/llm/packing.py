"""Best-fit packing planned over a histogram of lengths.

1. Every document becomes pieces of at most ``max_len`` tokens (``token_pieces``).
2. The pieces are counted by length; the counts, at most ``max_len`` rows, are all that the plan needs.
3. Best-fit decreasing runs over counts: groups of sequences that look alike are filled together.  The plan is a list
   of slots (length, first rank, sequences, offset) whose size depends on ``max_len``, not on the corpus.
4. Pieces are numbered within their length and take the slot that holds their rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrivium.llm.common import text_batches, whole_text
from quadrivium.llm.token_ids import ByteLevelIds, loaded
from quadrivium.session import cut_lineage, ship_package

MAX_LEN = 1024
END_ID = 2
#: Rows of one length that one task numbers; longer runs are split by a hash of the key.
RANK_ROWS = 20_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter than ``max_len``."""
    first = n % max_len or max_len
    return [(0, first)] + [(s, max_len) for s in range(first, n, max_len)]


def token_pieces(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document's ids followed by ``end_id``: ``doc_id, piece, start, length, ids_crc32``.

    Ids are whole numbers.  A null text is empty and has the end id alone; a null id is carried; repeated rows give their
    pieces each; an empty table gives none.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = loaded(ByteLevelIds, tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in text_batches(batches):
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ids_of.ids(text) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, max_len)):
                    rows.append((key, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, PIECES)


def plan_slots(counts: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, last rank, first sequence, offset) by best-fit decreasing over counts.

    Lengths are placed from the longest down.  Sequences with equal room are a group of consecutive numbers; a length
    goes into the groups with the least room that is enough, then into new sequences.
    """
    open_groups: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, how many)]
    slots, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        room = length
        while left:
            while room <= max_len and not open_groups.get(room):
                room += 1
            if room <= max_len:
                first, n = open_groups[room].pop()
            else:
                room, first, n = max_len, sequences, -(-left // (max_len // length))
                sequences += n
            take = min(left, n)
            slots.append((length, rank, rank + take - 1, first, max_len - room))
            if take < n:
                open_groups.setdefault(room, []).append((first + take, n - take))
            if room > length:
                open_groups.setdefault(room - length, []).append((first, take))
            left, rank = left - take, rank + take
            room = length
    return slots


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``pieces`` with ``rank``, from 0, within the length.  A long run of one length is numbered in hash buckets."""
    spark = pieces.sparkSession
    wanted = [(length, max(1, -(-n // RANK_ROWS))) for length, n in counts.items()]
    buckets = spark.createDataFrame(wanted, "length long, _buckets int")  # at most one row per length
    order = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = pieces.join(F.broadcast(buckets), "length").withColumn("_bucket", F.pmod(F.xxhash64(*order), F.col("_buckets")))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)) - 1
    return dealt.withColumn("_rank", within).join(sizes, ["length", "_bucket"]).withColumn(
        "rank", F.col("_rank") + F.col("_before")).drop("_rank", "_before", "_bucket", "_buckets")


def best_fit_pack(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Each piece's place: its columns, ``sequence_id`` and ``offset``; sequences have no gaps from 0.

    ``pieces`` has ``doc_id, piece, start, length, ids_crc32`` with lengths from 1 to ``max_len``.  Repeated rows are
    separate pieces.  An empty table gives an empty result.
    """
    pieces = cut_lineage(pieces)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most max_len rows
    slots = pieces.sparkSession.createDataFrame(
        plan_slots(counts, max_len), "length long, first_rank long, last_rank long, first_sequence long, offset long")
    placed = ranked(pieces, counts).join(F.broadcast(slots), "length").filter("rank BETWEEN first_rank AND last_rank")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents packed into as few sequences of at most ``max_len`` tokens as best-fit decreasing finds.

    A null text is empty and has the end id alone.  A null id is carried as null.  Rows that repeat an id are packed as
    separate documents.  An empty table gives an empty result.  Ids are whole numbers.  Other columns are ignored,
    whatever their names.
    """
    return best_fit_pack(token_pieces(docs, tokenizer, max_len, end_id, id_col, text_col), max_len)
