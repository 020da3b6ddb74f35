"""Text quality by compression: the dictionary that describes a text better tells its class.

Two Zstandard dictionaries are trained, one on good and one on bad labelled text.  A text is compressed block by block
with each; the sizes per byte and their normalised difference go through a logistic calibration fitted on labelled
documents that no dictionary has seen.  Only the labelled sample is bounded (``DOCS_PER_CLASS`` documents and
``BLOCKS_PER_CLASS`` blocks a class); every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.llm.common import held_out, text_batches, whole_text
from quadrivium.session import ship_package

#: Labelled documents a class, half for the dictionary and half for the calibration, in the order of a hash of the id.
DOCS_PER_CLASS = 8_000
#: Blocks of text a class that its dictionary is trained on.
BLOCKS_PER_CLASS = 8_000
BLOCK_BYTES = 1024
DICTIONARY_BYTES = 112_640
LEVEL = 3
FOLDS = 5
THRESHOLD = 0.3


@dataclass
class Sizes:
    """Compressed size of texts, block by block, with one dictionary."""

    dictionary: bytes
    compressor: zstandard.ZstdCompressor | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"dictionary": self.dictionary, "compressor": None}

    def of(self, data: bytes) -> int:
        if self.compressor is None:
            known = zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None
            self.compressor = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
        compress = self.compressor.compress
        frame = len(compress(b""))
        return sum(len(compress(data[at:at + BLOCK_BYTES])) - frame for at in range(0, len(data), BLOCK_BYTES))


@dataclass
class Model:
    """Both dictionaries and the calibration.  Without labels of both classes every score is ``prior``."""

    good: Sizes
    bad: Sizes
    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def features(self, text: str) -> tuple[float, float, float]:
        data = text.encode()
        n, good, bad = max(1, len(data)), self.good.of(data), self.bad.of(data)
        return (bad - good) / max(1, bad + good), good / n, bad / n

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        x = (features - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
    return w


def _features_of(rows: DataFrame, model: Model, columns: str) -> DataFrame:
    """``rows`` (first column any, second the text) with the three features; the text is left out."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            x = np.array([model.features(t) for t in batch.column(1).to_pylist()], float).reshape(-1, 3)
            kept = [batch.column(0), *batch.columns[2:]]
            names = [batch.schema.names[0], *batch.schema.names[2:]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x[:, k]) for k in range(3))], [*names, "f0", "f1", "f2"])

    return rows.mapInArrow(run, f"{columns}, f0 double, f1 double, f2 double")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        folds: int = FOLDS, docs_per_class: int = DOCS_PER_CLASS, blocks_per_class: int = BLOCKS_PER_CLASS) -> Model:
    """Learn from labelled rows outside fold 0 of ``folds``.  Labels other than 0 and 1, and null ids, are left out.

    ``prior`` is the share of label 1 among them; 0.5 without labels.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col, folds)).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).distinct()
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    model = Model(Sizes(b""), Sizes(b""), prior)
    if len(counts) < 2:
        return model
    order = F.xxhash64(F.lit(1), "_id")
    picked = [known.filter(F.col("_y") == y).orderBy(order, "_id").limit(docs_per_class) for y in (0, 1)]
    chosen = picked[0].unionAll(picked[1]).withColumn("_use", F.pmod(F.xxhash64(F.lit(2), "_id"), F.lit(2)))
    sample = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text")).join(
        F.broadcast(chosen), "_id").filter("_text != ''")  # at most 2 * docs_per_class small rows
    size = F.lit(BLOCK_BYTES)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.length("_text") - 1) / size).cast("int")),
        lambda k: F.substring("_text", k * size + 1, size))
    pieces = sample.filter("_use = 0").select("_id", "_y", F.posexplode(blocks).alias("_k", "_block"))
    for y, sizes in ((0, model.bad), (1, model.good)):
        own = pieces.filter(F.col("_y") == y).orderBy(F.xxhash64("_id", "_k"), "_id", "_k").limit(blocks_per_class)
        texts = [r["_block"].encode() for r in own.select("_block").collect()]  # at most blocks_per_class blocks
        try:
            sizes.dictionary = zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, texts)) // 4), texts).as_bytes()
        except zstandard.ZstdError:  # too little text for a trained one; its bytes serve as they are
            sizes.dictionary = b"".join(texts)[-DICTIONARY_BYTES:]
    if not (model.good.dictionary and model.bad.dictionary):
        return model
    rows = _features_of(sample.filter("_use = 1").select("_y", "_text"), model, "_y int").collect()  # at most 2 * docs_per_class rows
    x, y = np.array([[r["f0"], r["f1"], r["f2"]] for r in rows], float).reshape(-1, 3), np.array([r["_y"] for r in rows], float)
    if 0 < y.sum() < len(y):
        order_rows = np.lexsort((x[:, 2], x[:, 1], x[:, 0], y))
        x, y = x[order_rows], y[order_rows]
        model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-9)
        model.weights = logistic((x - model.mean) / model.scale, y)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, ``score`` (0 to 1, higher is likelier good) and ``predicted``.

    Null and empty texts get the model's prior.  Repeated rows are scored each.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            texts = batch.column(1).to_pylist()
            s = model.scores(np.array([model.features(t) for t in texts], float).reshape(-1, 3))
            s = np.where([bool(t) for t in texts], s, model.prior)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["_id", "score", "predicted"])

    return rows.mapInArrow(run, f"_id {kind}, score double, predicted int").withColumnRenamed("_id", id_col)


def drop_rejected(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model does not reject, with all their columns, scored row by row.

    Null and empty texts have the model's prior as score.  Null ids and repeated rows are rows like any other; an empty
    table gives an empty result; columns may have any names.
    """
    ship_package(docs.sparkSession)
    at, plain = docs.columns.index(text_col), docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # names with dots do not reach Python

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, text=at):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            s = model.scores(np.array([model.features(t) for t in texts], float).reshape(-1, 3))
            s = np.where([bool(t) for t in texts], s, model.prior)
            yield batch.filter(pa.array(s >= threshold))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
