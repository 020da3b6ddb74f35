"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures, confirmed on whole shingle sets.

A signature has ``CHUNKS * CHUNK`` symbols of 16 bits.  Two sets agree in a symbol with a probability of their Jaccard
similarity, so a pair at 0.8 differs in 14 of 70 symbols on average.  By the pigeonhole principle a pair that differs in
at most ``2 * CHUNKS - 1`` = 27 symbols has a chunk with at most one error.  One error within a chunk is enumerated by
leaving each symbol out in turn: the pair shares one of ``CHUNKS * CHUNK`` keys for certain.  (A pair at 0.8 exceeds 27
in one case of 20,000, and then still has all chunks to meet in.)

Members of a key are first compared with the smallest members they meet; the confirmed links make components, whose
smallest members in a key are then compared with that of its largest component.  What is left are keys whose members lie
in several components.  Members outside a key's largest component ask for that component, and are compared with its
members by longer sketches (``SKETCH`` symbols of one bit), block by block; among themselves they are compared by sketches in the
key.  Only those whose sketches allow a link are compared with the other component's members on whole sets.  No list of
the pairs of a group is made, and no link between components is lost.  Equal sets are one row from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrivium.llm.common import marked_rows, sorted_groups, text_batches, whole_text
from quadrivium.llm.components import components
from quadrivium.llm.words import mixed, word_hashes
from quadrivium.session import cut_lineage, ship_package

CHUNKS, CHUNK = 14, 5
SYMBOLS = CHUNKS * CHUNK
#: Symbols of the sketch that is looked at before two sets are compared, of one bit each.  Many symbols of a bit tell
#: sets near the limit from those below it by fewer bytes than few symbols of many bits.
SKETCH = 1024
#: A sketch may differ in so many more standard deviations than a pair at the limit does on average.
DEVIATIONS = 6.0
#: Members with which each document is compared first.
CENTRES = 2
#: Bytes of sets of each side that meet in one task, and pairs that it compares.
BLOCK_BYTES, BLOCK_PAIRS = 8_000_000, 4_000_000
#: Sketches that meet in one task, of each side.
SKETCH_BLOCK = 4096

_RNG = np.random.default_rng(7_070)
_FACTORS = _RNG.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(1, 2**64, SKETCH, dtype=np.uint64)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingles of ``words`` words of each text, as 64-bit hashes; a shorter text is one shingle."""
    hashes, counts = word_hashes(texts)
    out, at = [], 0
    for n in counts.tolist():
        own = hashes[at:at + n]
        at += n
        width = min(words, n)
        if not n:
            out.append(np.empty(0, np.uint64))
            continue
        code = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            code = mixed(code + own[k:n - width + 1 + k] * np.uint64(2 * k + 3))
        out.append(np.unique(code))
    return out


def signatures(sets: list[np.ndarray], symbols: int = SYMBOLS, kind: type = np.uint16) -> np.ndarray:
    """(texts, symbols) low bits of the least hash; zeros for an empty set."""
    out = np.zeros((len(sets), symbols), kind)
    rows = np.flatnonzero([len(s) > 0 for s in sets])
    if not len(rows):
        return out
    values = np.concatenate([sets[r] for r in rows])
    starts = np.cumsum([0, *[len(sets[r]) for r in rows[:-1]]])
    for k in range(symbols):
        out[rows, k] = np.minimum.reduceat(values * _FACTORS[k] + _TERMS[k], starts).astype(kind)
    return out


def sketches(sets: list[np.ndarray]) -> pa.Array:
    """A bit of each least hash; a middle one, which all lower bits of a member and of the factor decide."""
    bits = (signatures(sets, SKETCH, np.uint64) >> np.uint64(32)).astype(np.uint8) & 1
    return pa.array([b.tobytes() for b in np.packbits(bits, axis=1)], pa.binary())


def _sketch_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SKETCH // 64)


def _differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many symbols the sketches in rows differ."""
    return np.bitwise_count(a ^ b).sum(1, dtype=np.int64)


def most_differences(percent: int) -> int:
    """Sketches of a pair that must be found differ in no more symbols; those of other members differ in every second one."""
    miss = (1 - percent / 100) / 2
    return int(SKETCH * miss + DEVIATIONS * np.sqrt(SKETCH * miss * (1 - miss)))


def chunk_keys(signs: np.ndarray) -> np.ndarray:
    """(texts, SYMBOLS) keys: each chunk with each of its symbols left out."""
    code = mixed((signs.astype(np.uint64) + np.uint64(1)) * _FACTORS[None, :SYMBOLS]).reshape(len(signs), CHUNKS, CHUNK)
    rest = code.sum(2, dtype=np.uint64)[:, :, None] - code  # the sum without one symbol; places have factors of their own
    place = np.arange(1, SYMBOLS + 1, dtype=np.uint64).reshape(CHUNKS, CHUNK)
    return mixed(rest + place * np.uint64(0xD1B54A32D192ED03)).reshape(len(signs), SYMBOLS).view(np.int64)


def first_shared(signs: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The place of the first key that each signature shares with another one; -1 where it shares none."""
    differ = (signs != other).reshape(len(signs), CHUNKS, CHUNK)
    errors = differ.sum(2)
    chunk = (errors <= 1).argmax(1)
    rows = np.arange(len(signs))
    out = chunk * CHUNK + differ[rows, chunk].argmax(1)  # without an error all keys of the chunk are shared
    return np.where(errors[rows, chunk] <= 1, out, -1)


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _described(rows: DataFrame, words: int) -> DataFrame:
    """``id, n, digest, signature, text_digest`` of (id, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, rows=1000, size=1_000_000):
            sets = shingle_sets(batch.column(1), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in signatures(sets)], pa.binary()), batch.column(2)], ["id", "n", "digest", "signature", "text_digest"])

    digested = rows.withColumn("text_digest", F.unhex(F.sha2("text", 256)))
    return digested.mapInArrow(run, "id long, n long, digest binary, signature binary, text_digest binary")


def _named(sets: DataFrame) -> DataFrame:
    """``sets`` (digest, least) with ``rep``, a number of each set: its smallest id, or a hash where two sets share one."""
    for name in chain([F.col("least")], (F.xxhash64("digest", F.lit(salt)) for salt in count())):
        named = sets.withColumn("rep", name)
        if named.groupBy("rep").count().filter("count > 1").isEmpty():
            return named


def _keyed(reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys = chunk_keys(np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, SYMBOLS))
                ids = np.repeat(part.column(0).to_numpy(), SYMBOLS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "rep"])

    return reps.select("rep", "signature").mapInArrow(run, "key long, rep long")


def _sets_of(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``rep, n, signature, sketch, shingles`` of the wanted sets (rep, least, digest), from their texts."""
    found = rows.join(wanted, rows["id"] == wanted["least"]).select("rep", "text", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, rows=1000, size=1_000_000):
            sets = shingle_sets(batch.column(1), words)
            own = np.array([_digest(s) == d for s, d in zip(sets, batch.column(2).to_pylist())], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in signatures(sets)], pa.binary()),
                 sketches(sets), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["rep", "n", "signature", "sketch", "shingles"]).filter(pa.array(own))

    return found.mapInArrow(run, "rep long, n long, signature binary, sketch binary, shingles binary").dropDuplicates(["rep"])


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct values."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _numbers(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _confirmed_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""
    left = sets.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"), F.col("shingles").alias("wa"))
    right = sets.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"), F.col("shingles").alias("wb"))
    most = most_differences(percent)
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", "wa", "wb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                near = _differences(_sketch_rows(batch.column(2)), _sketch_rows(batch.column(3))) <= most
                good = np.array([ok and _alike(x, y, percent) for ok, x, y in zip(near, _numbers(batch.column(4)), _numbers(batch.column(5)))], bool)
                yield batch.select([0, 1]).filter(pa.array(good))

    return joined.mapInArrow(run, "a long, b long")


def _first_alike(sizes: np.ndarray, base: list[np.ndarray], asking: list[np.ndarray], percent: int) -> Iterator[int]:
    """For each asking set the place of the first base set that is alike, or -1, by a list of owners for each value."""
    values = np.concatenate(base)
    order = np.argsort(values, kind="stable")
    owner = np.repeat(np.arange(len(base)), sizes)[order]
    known, start = np.unique(values[order], return_index=True)
    end = np.append(start[1:], len(owner))
    for own in asking:
        at = np.searchsorted(known, own)
        at[at == len(known)] = 0
        at = at[known[at] == own]
        both = np.zeros(len(base), np.int64)
        if len(at):
            both = np.bincount(np.concatenate([owner[s:e] for s, e in zip(start[at].tolist(), end[at].tolist())]), minlength=len(base))
        good = 100 * both >= percent * (sizes + len(own) - both)
        yield int(good.argmax()) if good.any() else -1


def _confirmed_blocks(asks: DataFrame, homes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members (rep) with the members of other components (asks: rep, other; homes: rep, component, size).

    A component's members are dealt to blocks of about ``BLOCK_BYTES``, and so are those who ask for it.  One link of a
    block is enough for each who asks: the members are connected with each other already.
    """
    weight = sets.select("rep", (8 * F.col("n") + 64).alias("w"))
    asked = asks.join(weight, "rep").groupBy("other").agg(F.count("*").alias("n_asks"), F.sum("w").alias("ask_bytes"))
    members = homes.join(asked.select("other"), F.col("component") == F.col("other"), "left_semi").select("rep", F.col("component").alias("other"))
    sizes = members.join(weight, "rep").groupBy("other").agg(F.count("*").alias("n_base"), F.sum("w").alias("base_bytes"))
    by_bytes = lambda c: F.ceil(F.col(c) / BLOCK_BYTES)
    nb = by_bytes("base_bytes")
    nq = F.greatest(by_bytes("ask_bytes"), F.ceil(F.col("n_asks") * F.col("n_base") / nb / BLOCK_PAIRS))
    blocks = asked.join(sizes, "other").select("other", nb.cast("int").alias("_nb"), nq.cast("int").alias("_nq"))
    met = _dealt(members, asks, "other", blocks).join(sets.select("rep", "shingles"), "rep")

    def run(table: pa.Table) -> pa.Table:
        ids, inside = table.column("rep").to_numpy(), table.column("base").to_numpy().astype(bool)
        values, b, q = _numbers(table.column("shingles")), np.flatnonzero(inside), np.flatnonzero(~inside)
        found = []
        if len(b) and len(q):
            base = [values[k] for k in b]
            first = _first_alike(np.array([len(v) for v in base]), base, [values[k] for k in q], percent)
            found = [(ids[k], ids[b[at]]) for k, at in zip(q, first) if at >= 0]
        return pa.table([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return met.groupBy("other", "bi", "qi").applyInArrow(run, "a long, b long")


def _dealt(base: DataFrame, asks: DataFrame, group: str, blocks: DataFrame) -> DataFrame:
    """Rows of both sides with ``bi, qi, base``: by a hash a row falls into one of its side's blocks (``_nb``, ``_nq`` of
    its group), and meets all blocks of the other side."""
    at = F.xxhash64("rep")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(at, F.col(n)).cast("int")
    sides = [df.join(blocks, group).withColumn("bi", bi).withColumn("qi", qi).withColumn("base", F.lit(k))
             for df, bi, qi, k in ((base, own("_nb"), every("_nq"), 1), (asks, every("_nb"), own("_nq"), 0))]
    return sides[0].unionByName(sides[1]).drop("_nb", "_nq")


def _spanning(met: DataFrame, homes: DataFrame) -> DataFrame:
    """``key, rep, component, size, top``: members of the keys with several components; ``top`` is the key's largest."""
    placed = met.select("key", "rep").join(homes, "rep")
    keys = placed.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.max(F.struct("size", "component")).alias("t"))
    keys = keys.filter("lo != hi").select("key", F.col("t.component").alias("top"))
    return placed.join(keys, "key")


def _lead_pairs(spanning: DataFrame) -> DataFrame:
    """(a, b): of each key the smallest member of its largest component, and of each other one; a few for each b."""
    leads = spanning.groupBy("key", "component", "top").agg(F.min("rep").alias("b"))
    tops = leads.filter("component = top").select("key", F.col("b").alias("a"))
    pairs = leads.filter("component != top").join(tops, "key").select("a", "b").distinct()
    few = Window.partitionBy("b").orderBy("a")  # a member has SYMBOLS keys at most
    return pairs.withColumn("_k", F.row_number().over(few)).filter(F.col("_k") <= CENTRES).drop("_k")


def _met_blocks(base: DataFrame, asks: DataFrame, group: str, sketches_of: DataFrame) -> DataFrame:
    """Both sides (``group``, rep, ...) dealt to blocks of about SKETCH_BLOCK rows, with their sets' sketches."""
    n_base = base.groupBy(group).agg(F.ceil(F.count("*") / SKETCH_BLOCK).cast("int").alias("_nb"))
    n_asks = asks.groupBy(group).agg(F.ceil(F.count("*") / SKETCH_BLOCK).cast("int").alias("_nq"))
    return _dealt(base, asks, group, n_base.join(n_asks, group)).join(sketches_of, "rep")


def _near_top(spanning: DataFrame, homes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(rep, other): members outside their key's largest component that one of its members' sketches comes near to."""
    asks = cut_lineage(spanning.filter("component != top").select("rep", F.col("top").alias("other")).distinct())
    base = homes.select("rep", F.col("component").alias("other")).join(asks.select("other").distinct(), "other", "left_semi")
    met = _met_blocks(base, asks, "other", sets.select("rep", F.col("n").alias("count"), "sketch"))
    most, block = most_differences(percent), ["other", "bi", "qi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, block):
            inside = table.column("base").to_numpy().astype(bool)
            rep, count = (table.column(c).to_numpy() for c in ("rep", "count"))
            sketch, b, found = _sketch_rows(table.column("sketch")), np.flatnonzero(inside), []
            for q in np.flatnonzero(~inside):
                able = b[_same_size(count[b], count[q], percent)]
                if (_differences(sketch[able], sketch[q]) <= most).any():
                    found.append(int(rep[q]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([table.column("other")[0].as_py()] * len(found), pa.int64())], ["rep", "other"])

    parts = met.repartition(*block).sortWithinPartitions(*block)
    return parts.select("other", "bi", "qi", "base", "rep", "count", "sketch").mapInArrow(run, "rep long, other long").distinct()


def _same_size(count: np.ndarray, other: int, percent: int) -> np.ndarray:
    """Whether sets of so many members can be alike at all."""
    return 100 * np.minimum(count, other) >= percent * np.maximum(count, other)


def _near_others(spanning: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(rep, other): members outside their key's largest component and the larger of the other components they come near to.

    A pair that shares several keys is looked at in the first of them alone.
    """
    rest = spanning.filter("component != top").select("key", "rep", "component", "size")
    several = rest.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi")
    rest = cut_lineage(rest.join(several.select("key"), "key", "left_semi"))
    blocks = rest.groupBy("key").agg(F.ceil(F.count("*") / SKETCH_BLOCK).cast("int").alias("_n"))
    # both sides are the same rows, so a row goes to each pair of blocks once
    own, other = F.pmod(F.xxhash64("rep"), "_n").cast("int"), F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    met = rest.join(blocks, "key").withColumn("own", own).withColumn("_other", other).withColumns(
        {"bi": F.least("own", "_other"), "qi": F.greatest("own", "_other")}).drop("_n", "_other")
    met = met.join(sets.select("rep", F.col("n").alias("count"), "signature", "sketch"), "rep")
    most, block = most_differences(percent), ["key", "bi", "qi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, block):
            rep, component, size, count, own = (table.column(c).to_numpy() for c in ("rep", "component", "size", "count", "own"))
            sketch, one_block = _sketch_rows(table.column("sketch")), table.column("bi")[0] == table.column("qi")[0]
            against = {k: np.flatnonzero((own != k) | one_block) for k in np.unique(own).tolist()}
            sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            place = np.flatnonzero(chunk_keys(sign[:1])[0] == table.column("key")[0].as_py())
            found = set()
            for q in range(len(rep)):
                b = against[own[q]]
                able = b[(size[b] > size[q]) | ((size[b] == size[q]) & (component[b] > component[q]))]
                able = able[_same_size(count[able], count[q], percent)]
                near = able[_differences(sketch[able], sketch[q]) <= most]
                near = near[np.isin(first_shared(sign[near], sign[q]), place)]
                found.update((int(rep[q]), int(c)) for c in np.unique(component[near]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found]), pa.array([y for _, y in found])], ["rep", "other"])

    parts = met.repartition(*block).sortWithinPartitions(*block)
    parts = parts.select("key", "bi", "qi", "own", "rep", "component", "size", "count", "signature", "sketch")
    return parts.mapInArrow(run, "rep long, other long").distinct()


def _homes(members: DataFrame, links: DataFrame) -> DataFrame:
    """``rep, component, size`` of all members; one without a link is a component."""
    homes = members.join(components(links).withColumnRenamed("node", "rep"), "rep", "left")
    homes = homes.withColumn("component", F.coalesce("component", "rep"))
    return cut_lineage(homes.join(homes.groupBy("component").agg(F.count("*").alias("size")), "component"))


def _stars(homes: DataFrame) -> DataFrame:
    """Links that make the components again."""
    return homes.filter("rep != component").select(F.col("rep").alias("a"), F.col("component").alias("b"))


def _grouped(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``id, n, group, component_id, text_digest``; ``group`` is null for an empty set or a null id."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    facts = cut_lineage(_described(rows, words))
    reps = facts.filter("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("least"), F.max("signature").alias("signature"))
    reps = _named(cut_lineage(reps))
    keyed = _keyed(reps)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("centre")).filter("n > 1").drop("n")
    met = cut_lineage(keyed.join(shared, "key"))
    members = cut_lineage(met.select("rep").distinct())
    wanted = members.join(reps, "rep").select("rep", "least", "digest")
    sets = cut_lineage(_sets_of(rows, wanted, words))
    first = Window.partitionBy("b").orderBy("a")  # a member has SYMBOLS keys at most
    pairs = met.filter("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = pairs.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= CENTRES).drop("_k")
    homes = _homes(members, _confirmed_pairs(pairs, sets, percent))
    pairs = _lead_pairs(_spanning(met, homes))
    homes = _homes(members, _stars(homes).unionByName(_confirmed_pairs(pairs, sets, percent)))
    spanning = cut_lineage(_spanning(met, homes))
    asks = _near_top(spanning, homes, sets, percent).unionByName(_near_others(spanning, sets, percent)).distinct()
    more = _confirmed_blocks(cut_lineage(asks), homes, sets, percent)
    groups = components(_stars(homes).unionByName(more)).withColumnRenamed("node", "rep")
    found = reps.join(groups, "rep", "left").select("digest", "least", F.coalesce("component", "rep").alias("group"))
    lowest = found.groupBy("group").agg(F.min("least").alias("component_id"))
    found = cut_lineage(found.join(lowest, "group").select("digest", "group", "component_id"))
    out = ["id", "n", "group", "component_id", "text_digest"]
    linked = facts.filter("n > 0 AND id IS NOT NULL").join(found, "digest").select(*out)
    alone = facts.filter("n = 0 OR id IS NULL").select("id", "n", F.lit(None).cast("long").alias("group"), F.col("id").alias("component_id"), "text_digest")
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles, component_id, kept``.

    Shingles are of ``words`` words of the text with A-Z in lower case; fewer words are one shingle, none an empty set,
    which links with nothing.  A null text is empty.  Links need 100 * intersection >= percent * union.  A component's
    id is its smallest document id; rows that repeat an id and a set are one document, different sets of one id are
    compared like those of two.  A row with a null id links with nothing:
    its component is null and it is kept.  Other columns are ignored, whatever their names.
    """
    return _grouped(docs, words, percent, id_col, text_col).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns.

    Of the rows with the component's id one stays, by the smallest digest of its text, then of its values.  Empty sets of
    one id are one document, and all rows with a null id stay.
    """
    rows = _grouped(docs, words, percent, id_col, text_col)
    texts = rows.filter("id IS NOT NULL AND id = component_id").groupBy("group", "id", "text_digest").agg(F.count("*").alias("_n"))
    # an empty set has no group: its id tells it apart
    best = texts.groupBy("group", "id").agg(F.min(F.struct("text_digest", "_n")).alias("_b")).select(
        F.col("id").alias("_kept_id"), F.col("_b.text_digest").alias("_kept_digest"), F.col("_b._n").alias("_n"))
    own = docs.filter(F.col(id_col).cast("long").isNotNull())
    nulls = docs.filter(F.col(id_col).cast("long").isNull())
    return marked_rows(own, id_col, F.unhex(F.sha2(whole_text(text_col), 256)), best).unionByName(nulls)
