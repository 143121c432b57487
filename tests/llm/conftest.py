import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_rows import HOSTILE  # noqa: E402


@pytest.fixture
def hostile(spark):
    """Documents with every awkward case, and columns whose names clash with those of results."""
    rows = [(i, t, "x", 7, 1.5, "k") for i, t in HOSTILE]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, size int, shard double, key string").repartition(3)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def folder(tmp_path):
    """Write tables as a data directory: ``folder(documents=df, ...)``."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
