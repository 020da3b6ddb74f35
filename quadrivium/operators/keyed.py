"""Latest-row lookups, keyed updates and archive moves over Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Row with the greatest ``order`` per key, as a partial aggregate (a hot key never meets in one sort)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return best.select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Row with the smallest ``order`` per key."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return best.select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def apply_updates(log: DataFrame, updates: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Set ``value`` on rows whose keys are updated; the latest update of a key wins.

    Updates without a matching row change nothing, rows without an update keep their value.
    """
    last = updates.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(order, value)).alias("_update")
    )
    joined = log.join(last, keys, "left")
    new = F.when(F.col("_update").isNotNull(), F.col("_update.v")).otherwise(F.col(value))
    return joined.select(*[new.alias(c) if c == value else F.col(c) for c in log.columns])


def same_columns(df: DataFrame, target: DataFrame) -> None:
    have = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in target.schema]
    if have != want:
        raise ValueError(f"schema mismatch: {have} against {want}")


def append_rows(df: DataFrame, path: str, schema) -> None:
    """Append after checking names and types against the table schema."""
    have = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in schema]
    if have != want:
        raise ValueError(f"schema mismatch: {have} against {want}")
    df.write.mode("append").parquet(path)


def archive(spark: SparkSession, source: str, history: str, schema, batch: str) -> int:
    """Move all rows of ``source`` to a batch folder of ``history``, then empty the source.

    The batch folder is overwritten, so a run that is repeated after a failure does not append the
    rows twice; the source is emptied only after the row counts agree.
    """
    rows = spark.read.schema(schema).parquet(source)
    target = f"{history}/batch={batch}"
    rows.write.mode("overwrite").parquet(target)
    moved = spark.read.schema(schema).parquet(target).count()
    if moved != rows.count():
        raise RuntimeError("archive is incomplete; the source was kept")
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(source)
    return moved
