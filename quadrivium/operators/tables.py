"""Parquet tables with a manifest: an update rewrites only the files that hold an updated key.

A table is a folder with data files and ``manifest-<n>`` folders; the manifest of the highest number names the live
files.  A change writes its files first and its manifest last, so readers see the table before or after it, and a change
that fails half-way, or is repeated, leaves nothing that a reader would see.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrivium.operators.keyed import apply_updates


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names below ``path`` that begin with ``prefix``, in order, through the table's own file system."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith(prefix)) if fs.exists(root) else []


def _publish(spark: SparkSession, path: str, files: DataFrame) -> None:
    """Make ``files`` (file) the live files of the table."""
    number = len(_folders(spark, path, "manifest-"))
    files.select("file").coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest-{number:06d}")


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """(file): the files of the latest manifest."""
    return spark.read.parquet(f"{path}/{_folders(spark, path, 'manifest-')[-1]}")


def _write_files(df: DataFrame, path: str) -> DataFrame:
    """(file): the files that ``df`` is written to."""
    folder = f"{path}/data-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    spark = df.sparkSession
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select(F.col("path").alias("file"))


def create_table(df: DataFrame, path: str) -> None:
    """Write ``df`` as a new table."""
    _publish(df.sparkSession, path, _write_files(df, path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the latest manifest's files; the driver knows the names of files, as it does for every scan."""
    return spark.read.parquet(*[r["file"] for r in live_files(spark, path).collect()])


def update_table(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], value: str, order: str) -> int:
    """``apply_updates`` on a table; returns how many files were rewritten.

    One pass over the key columns finds the files that hold an updated key; only those are read whole and written again.
    Files whose rows already have the updated values are left as they are, so a repeated update rewrites nothing.
    """
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(order, value)).alias("_new"))
    held = read_table(spark, path).select(*keys, value, F.col("_metadata.file_path").alias("_file")).join(last, keys)
    touched = held.where(~F.col(value).eqNullSafe(F.col("_new.v"))).select(F.col("_file").alias("file")).distinct()
    names = [r["file"] for r in touched.collect()]
    if not names:
        return 0
    written = _write_files(apply_updates(spark.read.parquet(*names), updates, keys, value, order), path)
    untouched = live_files(spark, path).join(F.broadcast(spark.createDataFrame([(n,) for n in names], "file string")), "file", "left_anti")
    _publish(spark, path, untouched.unionByName(written))
    return len(names)
