import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from tessella.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=8,
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__execution__arrow__pyspark__enabled="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column function over texts, one result per text."""

    def run(fn, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fn("t").alias("r"))
        return [r.r for r in sorted(rows.collect())]

    return run
