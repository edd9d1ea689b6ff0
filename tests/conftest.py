import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from garimpo.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def fresh_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def value(spark):
    """Evaluate a column builder on one text."""
    from pyspark.sql import functions as F

    def run(build, text):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(build(F.col("t")).alias("v")).first()["v"]

    return run
