"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest
from oracle import compare, connect

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


@pytest.mark.parametrize("name", ["streamed_clean", "streamed_score_agreement"])
def test_streams_over_a_table_of_several_files(spark, con, tmp_path, name):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    assert compare(spark, con, name, str(tmp_path)) is None


def test_entry(spark):
    words = contract.entry(spark)
    assert words.columns == ["word", "count"]
    assert 0 < words.count() <= 15


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_registry_loads_without_spark_home(monkeypatch, tmp_path):
    """Names and SQL need no file of Spark's installation and no session."""
    import subprocess
    import sys

    code = (
        "import pyspark, __spark_entry__ as e; pyspark.__file__ = 'nowhere/__init__.py'; "
        "q, s = e.queries(), e.oracle_sql(); assert len(q) >= 68 and set(s) <= set(q); "
        "from pyspark import SparkContext; assert SparkContext._active_spark_context is None"
    )
    root = Path(contract.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
