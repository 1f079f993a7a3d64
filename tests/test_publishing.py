"""Publishing without a gap, retention by file, appends that count once."""

import threading

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from textmill.operators import retention
from textmill.operators.health import health, location
from textmill.operators.retention import retain
from textmill.sinks import publish as publishing
from textmill.sinks.publish import VERSION, parts_of, publish


def files_read(df) -> int:
    """Files that the scans of a plan without shuffles opened."""
    frame = df._jdf
    frame.collectToPython()
    leaves, total = frame.queryExecution().executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        total += metrics.apply("numFiles").value() if metrics.contains("numFiles") else 0
    return total


def versions(spark, name):
    return [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(name + VERSION)]


def test_readers_never_miss_a_table(spark, rows, tmp_path):
    """Whole contents in every read, while schema, partitioning and rows change."""
    name, root, seen, errors, stop = "gapless", str(tmp_path), set(), [], threading.Event()
    publish(spark.range(10).select(F.col("id"), F.lit("a").alias("day")), name, root)

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for turn in range(2, 8):
            df = spark.range(10 * turn).select(F.col("id"), F.lit("a").alias("day"), *[F.lit(1).alias(f"c{turn}")][: turn % 2])
            publish(df, name, root, ("day",) if turn % 3 else ())
    finally:
        stop.set()
        reader.join()
    assert not errors and seen <= {10 * t for t in range(1, 8)}
    assert spark.table(name).count() == 70
    assert len(versions(spark, name)) == 2  # the current one and the one before


def test_failure_between_leaves_the_old_table(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish(rows([(1,)], "id int"), "steady", root)
    real = SparkSession.sql

    def failing(self, statement, *args, **kwargs):
        if statement.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("the catalog went away")
        return real(self, statement, *args, **kwargs)

    monkeypatch.setattr(SparkSession, "sql", failing)
    with pytest.raises(RuntimeError):
        publish(rows([(2,), (3,)], "id int"), "steady", root)
    monkeypatch.undo()
    assert [r.id for r in spark.table("steady").collect()] == [1]
    publish(rows([(4,)], "id int"), "steady", root)
    assert [r.id for r in spark.table("steady").collect()] == [4]
    assert [tuple(r)[:3] for r in health(spark, ["steady"]).collect()] == [("steady", "OK", 1)]


def test_plain_tables_move_or_give_way(spark, rows, tmp_path):
    rows([(1,)], "id int").write.parquet(str(tmp_path / "a"))
    rows([(2,)], "id int").write.parquet(str(tmp_path / "b"))
    for folder in "ab":
        publishing.point_table(spark, "plain_t", str(tmp_path / folder))
        assert location(spark, "plain_t").endswith(f"/{folder}")
    assert [r.id for r in spark.table("plain_t").collect()] == [2] and parts_of(spark, "plain_t") == []
    publish(spark.table("plain_t"), "plain_t", str(tmp_path))
    assert [r.id for r in spark.table("plain_t").collect()] == [2]


def dated(spark, expired, files=20):
    """Twenty files of fifty rows; in the given ones some rows or all are old."""
    df = spark.range(0, files * 50, 1, files).select("id", F.floor(F.col("id") / 50).alias("file"))
    old = F.coalesce(*[F.when(F.col("file") == f, F.col("id") % 50 < n) for f, n in expired.items()], F.lit(False))
    return df.select("id", F.when(old, "2023-01-01").otherwise("2024-01-20").alias("date"), (F.col("id") % 2).alias("half"))


def test_retention_rewrites_only_files_with_expired_rows(spark, tmp_path):
    publish(dated(spark, {3: 10, 7: 50}), "by_file", str(tmp_path))
    assert files_read(spark.table("by_file")) == 20
    done = retain(spark, "by_file", "2024-01-20", str(tmp_path))
    assert (done.rows_before, done.rows_kept, done.rows_expired, done.changed) == (1000, 940, 60, True)
    first, added = parts_of(spark, "by_file")
    assert len(first.without) == 2 and added.without == ()
    assert spark.table(added.table).count() == 40  # the other rows of one file; the old file has none
    assert files_read(spark.table("by_file")) == 19
    assert spark.table("by_file").filter("date < '2024'").count() == 0
    assert sorted(r.id for r in spark.table("by_file").collect()) == sorted(
        i for i in range(1000) if not 150 <= i < 160 and not 350 <= i < 400
    )
    assert not retain(spark, "by_file", "2024-01-20", str(tmp_path)).changed
    assert retain(spark, "by_file", "2025-01-20", str(tmp_path)).rows_kept == 0
    assert spark.table("by_file").count() == 0
    publish(dated(spark, {}), "by_file", str(tmp_path))
    assert spark.table("by_file").count() == 1000 and len(parts_of(spark, "by_file")) == 1


def test_retention_of_other_partitions_and_many_parts(spark, tmp_path, monkeypatch):
    publish(dated(spark, {5: 20}), "by_half", str(tmp_path), ("half",))
    assert retain(spark, "by_half", "2024-01-20", str(tmp_path)).rows_kept == 980
    assert len(parts_of(spark, "by_half")) == 2
    assert spark.table("by_half").groupBy("half").count().count() == 2
    monkeypatch.setattr(retention, "_MOST_PARTS", 2)
    later = spark.table("by_half").select("id", F.when(F.col("id") < 30, "2023-01-01").otherwise("2024-01-20").alias("date"), "half")
    publish(later, "by_half", str(tmp_path), ("half",))
    assert retain(spark, "by_half", "2024-01-20", str(tmp_path)).rows_expired == 30
    later = spark.table("by_half").select("id", F.when(F.col("id") < 60, "2023-01-01").otherwise("2024-01-20").alias("date"), "half")
    monkeypatch.setattr(retention, "_MOST_PARTS", 1)
    publish(later, "by_half", str(tmp_path), ("half",))
    assert retain(spark, "by_half", "2024-01-20", str(tmp_path)).rows_kept == 920
    assert len(parts_of(spark, "by_half")) == 1 and spark.table("by_half").count() == 920
