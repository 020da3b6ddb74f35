import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("TZ", "UTC")

from quadrivium.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4, 4, **{"spark.driver.memory": "6g", "spark.sql.autoBroadcastJoinThreshold": "1048576"}
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-checkpoint-"))
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate one column expression over one row of literal values."""

    def run(column, **values):
        from pyspark.sql import functions as F

        frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
        return frame.select(column.alias("out")).first()["out"]

    return run
