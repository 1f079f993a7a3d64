import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from textmill.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def rows(spark):
    """Make a frame from tuples and a DDL schema."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The physical plan after running, as AQE left it."""
    frame = df._jdf
    frame.collectToPython()
    return frame.queryExecution().executedPlan().toString()
