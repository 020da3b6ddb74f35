"""Hooks for caller-supplied batch functions: enrichment, scoring and embedding."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrivium import constants as C
from quadrivium.functions import text
from quadrivium.session import ship_package

#: Bytes of rows that a scorer sees at once, beyond one row.
BATCH_BYTES = 4_000_000
#: Types whose Arrow columns become the same pandas columns here as in ``mapInPandas``.
PLAIN_TYPES = (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType, T.DateType)


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType) -> DataFrame:
    """Apply ``function`` to Arrow batches and add an ``error`` column.

    When a batch fails, its halves are tried, down to single rows; a failing row is kept with its
    input values, nulls for the new columns and the message in ``error``.
    """
    ship_package(df.sparkSession)
    out = T.StructType([*schema.fields, T.StructField("error", T.StringType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good, bad = [], {}
            tried = [(0, len(batch))]
            while tried:
                start, end = tried.pop()
                try:
                    good.append(function(batch if end - start == len(batch) else batch.iloc[start:end])[names])
                except Exception as problem:  # noqa: BLE001 - any failure falls back to fewer rows, and is reported in the row
                    if end - start > 1:
                        middle = (start + end) // 2
                        tried += [(middle, end), (start, middle)]
                    elif end > start:
                        bad[start] = str(problem)
            # one frame for each set of column types, so that joining them changes no value
            for _, same in groupby(sorted(good, key=_types), key=_types):
                yield pd.concat(same, ignore_index=True).assign(error=None)
            if bad:
                yield batch.iloc[list(bad)].reindex(columns=names).assign(error=list(bad.values()))

    return df.mapInPandas(run, out)


def _types(frame: pd.DataFrame) -> str:
    return str([*map(str, frame.dtypes)])


def score(df: DataFrame, make_scorer: Callable[[], Callable[[pd.DataFrame], pd.Series]], column: str, data_type: T.DataType) -> DataFrame:
    """Add ``column`` from a scorer that is built once per partition (a model client, for instance).

    Columns of plain types reach the scorer in frames of about ``BATCH_BYTES`` and pass by it in Arrow, so a worker's memory
    follows neither the rows nor the texts of a partition.
    """
    ship_package(df.sparkSession)
    out = T.StructType([*df.schema.fields, T.StructField(column, data_type)])
    if all(isinstance(f.dataType, PLAIN_TYPES) for f in out.fields):
        from pyspark.sql.pandas.types import to_arrow_type

        made, names = to_arrow_type(data_type), out.names
        safe = df.sparkSession.conf.get("spark.sql.execution.pandas.convertToArrowArraySafely") == "true"

        def run_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = make_scorer()
            for whole in batches:
                for batch in _small(whole):
                    frame = batch.to_pandas(date_as_object=True)
                    values = frame.assign(**{column: scorer(frame)})[column]
                    array = pa.Array.from_pandas(values, mask=values.isnull(), type=made, safe=safe)
                    yield pa.RecordBatch.from_arrays([*batch.columns, array], names)

        return df.mapInArrow(run_small, out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            yield batch.assign(**{column: scorer(batch)})

    return df.mapInPandas(run, out)


def _small(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch, or its halves where it has more than ``BATCH_BYTES``, down to single rows."""
    if batch.num_rows < 2 or batch.nbytes <= BATCH_BYTES:
        yield batch
    else:
        middle = batch.num_rows // 2
        yield from _small(batch.slice(0, middle))
        yield from _small(batch.slice(middle))


def lexicon_sentiment(df: DataFrame, key: str, column: str, lexicon: DataFrame) -> DataFrame:
    """(key, sentiment_score): mean word valence of a text in five steps; 3 without a listed word.

    ``lexicon`` has one (word, valence) row per word with valence in [-1, 1].  Counts per
    (key, word) come first, so a word that fills the corpus is joined once per text, and
    adaptive execution splits the rows of that word.  Sums are
    decimal: a score on the edge of a step does not depend on the order of the rows.
    """
    tokens = df.select(F.col(key).alias("key"), F.explode(text.words(column)).alias("word"))
    counts = tokens.groupBy("key", "word").agg(F.count("*").alias("n"))
    found = counts.join(lexicon, "word").groupBy("key").agg(
        (F.sum(F.col("valence").cast("decimal(9,6)") * F.col("n")).cast("double") / F.sum("n")).alias("mean")
    )
    step = F.floor((F.col("mean") + 1.0) * 2.5).cast("int") + 1
    joined = df.select(F.col(key).alias("key")).join(found, "key", "left")
    return joined.select(
        F.col("key").alias(key),
        F.when(F.col("mean").isNull(), 3).otherwise(F.least(step, F.lit(5))).cast("int").alias("sentiment_score"),
    )


def embed(df: DataFrame, column: str, output: str = "embedding", dim: int = C.VECTOR_DIM, embedder=None) -> DataFrame:
    """Add a unit-length vector column.

    The default adds a signed unit for each word at a place, both taken from the word's md5: the first eight hex digits
    modulo ``dim`` and the parity of the ninth.  A text without words, or whose words cancel out, gives zeros.
    ``embedder`` replaces it by a caller's column function (a ``predict_batch_udf``, for instance).
    """
    if embedder is not None:
        return df.withColumn(output, embedder(F.col(column)))
    digest = lambda w: F.md5(w.cast("binary"))
    number = lambda h, at, n: F.conv(F.substring(h, at, n), 16, 10).cast("long")
    # places from 0 for a plus, from ``dim`` for a minus
    place = lambda h: (number(h, 1, 8) % dim + F.when(number(h, 9, 1) % 2 == 1, dim).otherwise(0)).cast("string")
    terms = F.transform(F.transform(F.coalesce(text.words(column), F.array().cast("array<string>")), digest), place)
    counter = CountVectorizerModel.from_vocabulary([str(k) for k in range(2 * dim)], "_terms", "_counts")
    counted = counter.transform(df.withColumn("_terms", terms)).withColumn("_both", vector_to_array("_counts"))
    signed = F.zip_with(F.slice("_both", 1, dim), F.slice("_both", dim + 1, dim), lambda x, y: x - y)
    length = F.sqrt(F.aggregate("_signed", F.lit(0.0), lambda a, x: a + x * x))
    unit = counted.withColumn("_signed", signed).withColumn("_length", length)
    scaled = F.transform("_signed", lambda x: F.when(F.col("_length") > 0, x / F.col("_length")).otherwise(x))
    return unit.withColumn(output, scaled).drop("_terms", "_counts", "_both", "_signed", "_length")
