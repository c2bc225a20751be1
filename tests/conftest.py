import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate column expressions over single text inputs: value(fn, input) -> result."""
    from pyspark.sql import functions as F

    def run(build, *inputs):
        frame = spark.createDataFrame([inputs], ", ".join(f"c{i} string" for i in range(len(inputs))))
        return frame.select(build(*[F.col(f"c{i}") for i in range(len(inputs))]).alias("r")).first()["r"]

    return run
