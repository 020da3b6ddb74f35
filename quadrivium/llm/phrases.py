"""Collocations: contiguous phrases scored by their weakest cut, counted by multikey quicksort of suffix pointers.

1. Words are counted by partial aggregates.
2. Every suffix of a piece, cut at the greatest depth, is routed by its leading word.  Suffixes that begin with a hot
   word (more than ``HOT`` occurrences) go by their first two words, those that begin with two by all their words, so no
   route but that of equal suffixes holds more than ``HOT`` of them; equal ones are counted before they are sent.  What
   a batch sends to a bucket is one block: its words once, and numbers.
3. A task sorts pointers to its suffixes by three-way partitions at one word after the other.  The weight of an equal
   partition is the count of its phrase; partitions lighter than the least count hold no frequent phrase and go.

Counts and scores are exact; products are decimals of 38 digits, enough for counts up to 10**15.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrivium.llm.common import text_batches, whole_text
from quadrivium.llm.words import mixed
from quadrivium.session import cut_lineage, ship_package

#: No valid UTF-8 has this byte.
STOP = b"\xff"
_TABLE = bytearray(range(256))
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = STOP[0]
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TABLE[_c] = _c + 32
_TABLE = bytes(_TABLE)
#: Bytes of text that are split into words at a time.
BATCH = 8_000_000
#: Suffixes that a task should sort, and occurrences from which a word is hot.
SUFFIXES, HOT = 1_000_000, 250_000
#: Buckets for each task, so that they fall evenly.
BUCKETS_A_TASK = 4


def split_words(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Lists of words in which each piece ends with STOP, of about BATCH bytes or one piece."""
    data, at = STOP.join(texts).translate(_TABLE) + STOP, 0
    while at < len(data):
        end = data.rfind(STOP, at, at + BATCH) + 1 if len(data) - at > BATCH else len(data)
        if not end:
            end = data.find(STOP, at) + 1
        yield data[at:end].replace(STOP, b" \xff ").split()
        at = end


def numbered(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Each word's place in the list of distinct words, -1 for STOP."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    at, names = coded.indices.to_numpy().astype(np.int32), coded.dictionary.to_pylist()
    if STOP in names:
        stop = names.index(STOP)
        at = np.where(at == stop, -1, np.where(at > stop, at - 1, at)).astype(np.int32)
        del names[stop]
    return at, names


def suffixes(at: np.ndarray, depth: int) -> np.ndarray:
    """(words, depth) word numbers from each word on within its piece, -1 beyond its end."""
    padded = np.concatenate([at, np.full(depth, -1, np.int32)])
    heads = np.flatnonzero(at >= 0)
    out = np.full((len(heads), depth), -1, np.int32)
    inside = np.ones(len(heads), bool)
    for k in range(depth):
        own = padded[heads + k]
        inside &= own >= 0
        out[inside, k] = own[inside]
    return out


def distinct_rows(rows: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of word numbers, and how often each occurs."""
    width = max(1, names).bit_length()
    if width * rows.shape[1] > 63:
        return np.unique(rows, axis=0, return_counts=True)
    code = np.zeros(len(rows), np.int64)
    for k in range(rows.shape[1]):
        code = code << width | (rows[:, k] + 1)
    code, n = np.unique(code, return_counts=True)
    shifts = np.arange(rows.shape[1] - 1, -1, -1) * width
    return ((code[:, None] >> shifts & ((1 << width) - 1)) - 1).astype(np.int32), n


def equal_parts(keys: np.ndarray, weight: np.ndarray, least: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``depth, pointer, count`` of all key prefixes whose rows weigh at least ``least[depth - 1]``.

    Multikey three-way quicksort over pointers to the rows, all partitions of a round side by side: each compares the
    word at its depth with that of a pivot row.  Its smaller and larger rows stay at that depth, its equal rows are a
    prefix and go one word deeper.  Partitions lighter than what is looked for are abandoned; -1 is beyond a piece.
    """
    pointer = np.flatnonzero(keys[:, 0] >= 0)
    part = np.zeros(len(pointer), np.int64)
    level, least = np.zeros(1, np.int64), np.asarray(least, np.int64)
    pick = np.random.default_rng(1)
    while len(pointer):
        parts = len(level)
        starts = np.searchsorted(part, np.arange(parts))
        sizes = np.diff(np.append(starts, len(part)))
        own = keys[pointer, level[part]]
        tries = own[starts[:, None] + (pick.random((parts, 3)) * sizes[:, None]).astype(np.int64)]
        pivot = np.sort(tries, axis=1)[:, 1][part]
        side = (own > pivot).astype(np.int64) - (own < pivot) + 1
        code = part * 3 + side
        weights = np.bincount(code, weight[pointer], parts * 3).astype(np.int64)
        count = np.bincount(code, minlength=parts * 3)
        begins = np.cumsum(count) - count
        place = np.empty(len(pointer), np.int64)
        for k in range(3):  # rows keep their order within a side
            mine = side == k
            rank = np.cumsum(mine) - 1
            base = np.cumsum(count[k::3]) - count[k::3]
            place[mine] = (begins[part * 3 + k] + rank - base[part])[mine]
        ordered, sorted_code = np.empty_like(pointer), np.repeat(np.arange(parts * 3), count)
        ordered[place] = pointer
        deeper = np.repeat(level, 3)
        deeper[1::3] += 1
        wanted = least[np.minimum(np.where(np.arange(parts * 3) % 3 == 1, deeper - 1, deeper), len(least) - 1)]
        alive = (count > 0) & (weights >= wanted)
        equal = np.flatnonzero(alive[1::3]) * 3 + 1
        for depth in np.unique(deeper[equal]).tolist():
            these = equal[deeper[equal] == depth]
            yield depth, ordered[begins[these]], weights[these]
        alive &= deeper < keys.shape[1]
        keep = alive[sorted_code]
        pointer, sorted_code = ordered[keep], sorted_code[keep]
        # the -1 rows of a part that went deeper end there
        keep = keys[pointer, deeper[sorted_code]] >= 0
        pointer, sorted_code = pointer[keep], sorted_code[keep]
        left, part = np.unique(sorted_code, return_inverse=True)
        level = deeper[left]


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """``lang, numbers, distinct words`` of batches of rows (lang, text)."""
    for batch in text_batches(batches, size=BATCH):
        texts = batch.column(1).cast(pa.binary())
        coded = batch.column(0).dictionary_encode()
        at = coded.indices.to_numpy()
        for k, lang in enumerate(coded.dictionary.to_pylist()):
            for words in split_words(texts.filter(pa.array(at == k)).to_pylist()):
                yield lang, *numbered(words)


def count_words(rows: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, n`` of the words with at least ``least`` occurrences; a null phrase has the total of its lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, at, names in _by_lang(batches):
            own = at[at >= 0]
            n = np.append(np.bincount(own, minlength=len(names)), len(own)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([*names, None], pa.binary()).cast(pa.string()), pa.array(n)], ["lang", "phrase", "n"])

    counted = rows.mapInArrow(run, "lang string, phrase string, n long")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | F.col("phrase").isNull())


def _routes(rows: np.ndarray, codes: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each suffix's leading words, and whether its first two words are hot."""
    codes, hot = np.append(codes, np.uint64(0)), np.append(hot, False)  # the last stands for -1
    route = mixed(codes[rows[:, 0]])
    warm, both = hot[rows[:, 0]], hot[rows[:, 0]] & hot[rows[:, 1]]
    route = np.where(warm, mixed(route + codes[rows[:, 1]]), route)
    for k in range(2, rows.shape[1]):
        route = np.where(both, mixed(route + codes[rows[:, k]] * np.uint64(2 * k + 1)), route)
    return route, both


def _blocks(rows: DataFrame, depth: int, hot, buckets: int) -> DataFrame:
    """``bucket, lang, split, words, rows, wide, n``: what a batch sends to a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, at, names in _by_lang(batches):
            own, n = distinct_rows(suffixes(at, depth), len(names))
            if not len(own):
                continue
            seed, warm = zlib.crc32(lang.encode()), hot.value.get(lang, frozenset())
            codes = mixed(np.array([zlib.crc32(w, seed) | len(w) << 32 for w in names], np.uint64))
            route, both = _routes(own, codes, np.array([w in warm for w in names], bool))
            bucket = (route % np.uint64(buckets)).astype(np.int64) * 2 + both
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            out = {k: [] for k in ("bucket", "split", "words", "rows", "wide", "n")}
            for part in np.split(order, cuts):
                used, place = np.unique(own[part], return_inverse=True)
                held = used[used >= 0]
                place = place.reshape(len(part), depth).T + (0 if used[0] < 0 else 1)  # 0 is beyond a piece
                wide = 2 if len(held) < 65535 else 4
                for k, v in (("bucket", int(bucket[part[0]]) >> 1), ("split", bool(bucket[part[0]] & 1)), ("words", STOP.join([names[w] for w in held])),
                             ("rows", place.astype(f"<u{wide}").tobytes()), ("wide", wide), ("n", n[part].astype("<u4").tobytes())):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["bucket"], pa.int64()), pa.array([lang] * len(out["bucket"]), pa.string()), pa.array(out["split"], pa.bool_()),
                 pa.array(out["words"], pa.binary()), pa.array(out["rows"], pa.binary()), pa.array(out["wide"], pa.int32()), pa.array(out["n"], pa.binary())],
                ["bucket", "lang", "split", "words", "rows", "wide", "n"])

    return rows.mapInArrow(run, "bucket long, lang string, split boolean, words binary, rows binary, wide int, n binary")


def count_phrases(rows: DataFrame, words: DataFrame, depth: int, least: int) -> DataFrame:
    """``lang, phrase, n`` of all phrases of 2 to ``depth`` words with at least ``least`` occurrences."""
    spark = rows.sparkSession
    total = int(words.filter("phrase IS NULL").agg(F.sum("n").alias("n")).first()["n"] or 0)
    by_lang: dict[str, set[bytes]] = {}
    for row in words.filter(f"phrase IS NOT NULL AND n > {HOT}").toLocalIterator():  # at most total / HOT of them
        by_lang.setdefault(row["lang"], set()).add(row["phrase"].encode())
    hot = spark.sparkContext.broadcast(by_lang)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SUFFIXES))
    blocks = _blocks(rows, depth, hot, tasks * BUCKETS_A_TASK).repartition(tasks, "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, bool], tuple[dict[bytes, int], list, list]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                numbers, keys, weights = seen.setdefault((row["lang"], row["split"]), ({}, [], []))
                own = np.array([-1, *(numbers.setdefault(w, len(numbers)) for w in row["words"].split(STOP))], np.int32)
                keys.append(own[np.frombuffer(row["rows"], f"<u{row['wide']}")].reshape(depth, -1).T)
                weights.append(np.frombuffer(row["n"], "<u4"))
        for lang, split in list(seen):
            numbers, keys, weights = seen.pop((lang, split))
            keys, weights, names = np.concatenate(keys), np.concatenate(weights).astype(np.int64), list(numbers)
            # a split phrase that could go on has parts elsewhere, so none of its counts is too small to matter
            for size, at, n in equal_parts(keys, weights, [1 if split else least] * (depth - 1) + [least]):
                if size > 1:
                    phrases = [b" ".join([names[w] for w in key]) for key in keys[at, :size].tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n)], ["lang", "phrase", "n"])

    found = blocks.mapInArrow(run, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def collocations(docs: DataFrame, depth: int = 3, least: int = 10, top: int = 2000, share: int = 50, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each lang's ``top`` phrases of 2 to ``depth`` words.

    A-Z count as a-z.  Texts are split at ``.,;:!?`` and line ends into pieces, pieces at blanks and tabs into words.
    ``a`` counts the phrase within pieces, overlaps included, and is at least ``least``; ``n`` counts all words of the
    lang.  A cut after k words has l and r, the counts of both parts, and the score floor(1000000 * a * a / (l * r)).
    The lowest cut counts, of equal ones the first.  A phrase goes if a longer candidate holds its words in a row and
    has at least ``share`` per cent of its count.  Order: score and a descending, phrase ascending by bytes.

    A null lang is ``und``; a null or empty text has no words; repeated rows count each.  An empty table gives an empty
    result.  Other columns are ignored, whatever their names.
    """
    if depth < 2:
        raise ValueError("a phrase has two words at least")
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), whole_text(text_col).alias("text"))
    words = cut_lineage(count_words(rows, least))
    grams = cut_lineage(count_phrases(rows, words, depth, least))
    single = words.filter("phrase IS NOT NULL")
    parts = single.unionByName(grams)
    at = F.split("phrase", " ")
    cuts = grams.select("lang", "phrase", F.col("n").alias("a"), at.alias("w"), F.explode(F.sequence(F.lit(1), F.size(at) - 1)).alias("k"))
    joined = lambda start, length: F.concat_ws(" ", F.slice("w", start, length))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"),
                       joined(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    side = lambda name, count: parts.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    scored = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).select(
        "lang", "phrase", "a", "k", "l", "r", (exact("a") * exact("a") * F.lit(1_000_000).cast("decimal(7,0)")).alias("_over"),
        (exact("l") * exact("r")).alias("_under")).withColumn("score", F.expr("_over div _under"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("b"))
    longer = grams.select("lang", F.col("n").alias("of"), at.alias("w")).filter(F.size("w") > 2)
    sizes = F.sequence(F.lit(2), F.size("w") - 1)
    inner = F.flatten(F.transform(sizes, lambda m: F.transform(
        F.sequence(F.lit(1), F.size("w") - m + 1), lambda s: F.concat_ws(" ", F.slice("w", s, m)))))
    longer = longer.select("lang", "of", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.col("of").isNull() | (100 * F.col("of") < share * F.col("b.a")))
    kept = kept.select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = words.filter("phrase IS NULL").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
