"""Spelling variants: words one edit apart, found through words over a reduced alphabet.

1. Runs of letters are counted by partial aggregates.
2. A word is reduced: each letter becomes one of a few symbols.  Two words one edit apart have reduced words that are
   equal or one edit apart.
3. Each word's full neighbourhood is generated: its reduced word and all that one deletion, replacement or insertion
   makes of it, as 64-bit hashes from prefix sums, without building the words.
4. The neighbourhoods join the reduced vocabulary by hash, and every pair is verified on the original strings.

More words want more symbols, or classes of one reduced word grow: ``symbols_for`` follows the size of the vocabulary.
Before the join a Bloom filter of the reduced vocabulary takes out what has no partner; its size is bounded, and a
fuller filter only lets more through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.llm.bloom_bits import filter_of
from quadrivium.llm.common import text_batches, whole_text
from quadrivium.llm.words import mixed
from quadrivium.session import cut_lineage, ship_package

LETTERS = "A-Za-zÀ-ÿ"
MAX_BYTES = 64_000_000
#: Neighbours that are hashed at a time.
CHUNK = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))


def symbols_for(words: int) -> int:
    """The least power of two, 8 at least, with 16 reduced words of six symbols for each word."""
    symbols = 8
    while symbols**6 < 16 * words:
        symbols *= 2
    return symbols


def symbols_of(letters: np.ndarray, symbols: int) -> np.ndarray:
    """Code points to symbols 1 to ``symbols``: neighbours in the alphabet differ, which spreads vowels."""
    return (letters % symbols + 1).astype(np.uint64)


def count_words(docs: DataFrame, shortest: int, id_col: str, text_col: str, typo_every: int | None) -> DataFrame:
    """``word, n`` of all runs of letters, A-Z in lower case, with at least ``shortest`` code points.

    With ``typo_every`` each run of a document whose checksum of ``<id>:<run>`` it divides first loses the letter at the
    checksum's remainder by the run's length: made misspellings, the same at every run.
    """
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            total: Counter[str] = Counter()
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                own = Counter(runs.findall(text.lower().decode()))
                if typo_every:
                    seed = zlib.crc32(f"{key}:".encode())
                    marked = [(w, h) for w in own if not (h := zlib.crc32(w.encode(), seed)) % typo_every]
                    for word, h in marked:
                        n, at = own.pop(word), h % len(word)
                        if len(word) > shortest:
                            total[word[:at] + word[at + 1:]] += n
                total.update(own)
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base)]), dtype=np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``rows, letters``: the places of the words of one length, and their code points as a matrix."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == n)
        yield rows, np.frombuffer("".join([words[r] for r in rows]).encode("utf-32-le"), "<u4").reshape(len(rows), n)


def reduced_hashes(words: list[str], symbols: int) -> np.ndarray:
    """The hash of each word's reduced word."""
    out = np.zeros(len(words), np.uint64)
    for rows, letters in _by_length(words):
        code = symbols_of(letters, symbols)
        out[rows] = mixed((code * _powers(_BASE, code.shape[1])[:-1]).sum(1, dtype=np.uint64))
    return out.view(np.int64)


def neighbourhoods(words: list[str], symbols: int, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``row, hash``: of each word's reduced word, itself and all words one edit away; a row's hash may repeat.

    Edits are made at some places of some words at a time, so a very long word takes no more memory than many short ones.
    """
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    for rows, letters in _by_length(words):
        n = letters.shape[1]
        power = _powers(_BASE, n + 1)
        step = max(1, chunk // ((n + 1) * symbols))
        width = max(1, chunk // symbols)
        for at in range(0, len(rows), step):
            own, code = rows[at:at + step], symbols_of(letters[at:at + step], symbols)
            term = code * power[:n]
            zero = np.zeros((len(own), 1), np.uint64)
            before = np.concatenate([zero, np.cumsum(term, axis=1, dtype=np.uint64)], 1)  # before each of n + 1 places
            whole = before[:, -1:]
            after = whole - before  # from each place on
            yield own, mixed(whole[:, 0]).view(np.int64)
            for s in range(0, n, width):
                e = min(n, s + width)
                gone = before[:, s:e] + after[:, s + 1:e + 1] * _BACK
                yield np.repeat(own, e - s), mixed(gone.ravel()).view(np.int64)
                other = whole[:, :, None] + (every - code[:, s:e, None]) * power[s:e, None]
                yield np.repeat(own, (e - s) * symbols), mixed(other.ravel()).view(np.int64)
            for s in range(0, n + 1, width):
                e = min(n + 1, s + width)
                more = (before[:, s:e] + after[:, s:e] * _BASE)[:, :, None] + every * power[s:e, None]
                yield np.repeat(own, (e - s) * symbols), mixed(more.ravel()).view(np.int64)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = 0
    for x, y in zip(a, b):
        if x != y:
            break
        at += 1
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def near_words(words: DataFrame, symbols: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``word, n, other, other_n``: all ordered pairs of ``words`` (word, n; distinct) that are one edit apart."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array(reduced_hashes(batch.column(0).to_pylist(), symbols))
            yield pa.RecordBatch.from_arrays([keys, *batch.columns], ["key", "other", "other_n"])

    vocabulary = words.select("word", "n").mapInArrow(reduce, "key long, other string, other_n long")
    keys = cut_lineage(vocabulary.select("key").distinct())
    known = filter_of(keys, keys.count(), max_bytes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                part = batch.slice(at, 5000)
                found = []
                for rows, hashes in neighbourhoods(part.column(0).to_pylist(), symbols):
                    hit = known.value.has(hashes)
                    found.append((rows[hit], hashes[hit]))
                rows, hashes = (np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64) for k in (0, 1))
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                first = np.ones(len(rows), bool)
                first[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[first]), *[c.take(pa.array(rows[first])) for c in part.columns]], ["key", "word", "n"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [one_edit(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield batch.filter(pa.array(good, pa.bool_()))

    probes = words.select("word", "n").mapInArrow(probe, "key long, word string, n long")
    pairs = probes.join(vocabulary, "key").filter("word != other").select("word", "n", "other", "other_n")
    return pairs.mapInArrow(verify, "word string, n long, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each chain of forms, by doubling; counts grow along a chain, so it has one."""
    jumps = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = cut_lineage(jumps.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if longer.filter("_moved").isEmpty():
            return longer.select("word", "root")
        jumps = longer.select("word", "root")


def spelling_variants(docs: DataFrame, shortest: int = 6, least: int = 5, ratio: int = 5, id_col: str = "doc_id", text_col: str = "text",
                      typo_every: int | None = None, symbols: int | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word.

    Words are runs of ``A-Za-z`` and U+00C0 to U+00FF, A-Z in lower case, of at least ``shortest`` code points with at
    least ``least`` occurrences.  Two words are near if one edit apart.  A word's form is its near word of largest count
    (ties: the smallest in code-point order) if that has ``ratio`` (at least 2) times its count, else null; its root is
    the last word that forms lead to.  ``n_near`` counts the near words; ``form_n`` is the form's count.

    A null or empty text has no words, a null id is the empty text for ``typo_every`` (see ``count_words``), repeated rows
    count each.  An empty table gives an empty result.  Other columns are ignored, whatever their names.
    """
    if ratio < 2 or shortest < 1:
        raise ValueError("ratio must be 2 or more and shortest 1 or more")
    ship_package(docs.sparkSession)
    words = cut_lineage(count_words(docs, shortest, id_col, text_col, typo_every).filter(F.col("n") >= least))
    pairs = near_words(words, symbols or symbols_for(words.count()), max_bytes)
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other").alias("other"))).alias("b"))
    near = near.select("word", "n_near", F.col("b.other").alias("form"), (-F.col("b.col1")).alias("form_n"))
    named = words.join(near, "word", "left")
    good = F.col("form_n") >= ratio * F.col("n")
    named = cut_lineage(named.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                     F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")))
    roots = _roots(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
