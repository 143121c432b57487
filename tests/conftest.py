import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pressgauge.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.maxMetadataStringLength": "10000",  # plan tests read whole plan lines
        "spark.checkpoint.dir": str(shared),
    }
    session = local_session(4, "tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def one(spark):
    """Evaluate a column function on literal strings: ``one(fn, 'a', None)`` gives a list."""
    from pyspark.sql import functions as F

    def run(fn, *values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
