"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quadrivium")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a table of fewer files than cores before work that is heavy per row.

    A file holds few row groups and a row group is read by one task.  Tables of many files, which
    is what large tables are, come back unchanged and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def _shared(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Only a session of one process may leave it out and gets a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="quadrivium-checkpoint-")
    return folder


#: Whether Spark removes a query's shuffle files when it ends; a DataFrame takes the setting when it is made.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget how it was made.

    The shuffle files it was made from go at once.  Spark removes them only when the driver collects garbage, so a chain
    of materialised steps would keep those of all steps on the executors' disks.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared(spark))
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        made = df.select("*")
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return made.checkpoint(eager=True)


def output_folder(spark: SparkSession) -> str:
    """A new folder for output that is read back, below the shared one."""
    return f"{_shared(spark).rstrip('/')}/{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per Spark context.

    Needed wherever workers run package code and the cluster image does not contain it.
    """
    context = spark.sparkContext
    if getattr(context, "_quadrivium_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quadrivium-package-")) / "quadrivium.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._quadrivium_shipped = True
