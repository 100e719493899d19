import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from dimflow.session import apply_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples of the named columns."""

    def collect(df, *columns):
        found = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
        return sorted(found, key=repr)

    return collect
