"""Readers, writers, tables, retention and health."""

import json
import os
import time
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pytest
from conftest import final_plan, plan
from pyspark.sql import functions as F

from textmill.functions.dates import day_key
from textmill.operators.clean import training_rows
from textmill.operators.health import health, list_tables, location, previews, sample_rows
from textmill.operators.retention import expiry, retain
from textmill.session import (
    cached,
    file_bytes,
    shared_root,
    sized_shuffles,
    stage,
    staging_path,
)
from textmill.sinks.files import (
    _json_arrays,
    append_training,
    append_training_csv,
    balanced,
    discard,
    write_day_buckets,
    write_json_batches,
)
from textmill.sinks.publish import point_table, publish
from textmill.sources.json_files import broken_files, read_json_arrays, read_json_lines
from textmill.sources.label_lines import read_label_lines
from textmill.sources.raw_files import modified_after, raw_file_ages
from textmill.sources.tables import MissingTable, local_rows, read_parquet, require_table
from textmill.sources.training_csv import malformed_records, read_training_csv

CSV = """is_destructive,text
0,"say ""hi"", ok"
1,one,extra field
1
word,not a number
0,
1,plain
"""


def test_label_lines(spark, tmp_path):
    (tmp_path / "lines.txt").write_text(
        "__label__NORMAL good day\n"
        "__label__INSULT,__label__THREAT you there\n"
        "__label__NORMAL,__label__INSULT mixed\n"
        "__label__NORMAL\n"
        "\n"
        "   __label__NORMAL padded   \n"
        "__label__NORMAL,__label__NORMAL twice  spaced\n"
    )
    found = read_label_lines(spark, str(tmp_path / "lines.txt"))
    assert sorted(tuple(r) for r in found.collect()) == [
        (0, ""),
        (0, "good day"),
        (0, "padded"),
        (0, "twice  spaced"),
        (1, "mixed"),
        (1, "you there"),
    ]


def test_csv_quotes_and_malformed_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    read = read_training_csv(spark, str(tmp_path))
    assert [r.text for r in read.collect()] == ['say "hi", ok', "not a number", None, "plain"]
    # The answer does not depend on the columns selected.
    assert read.count() == 4
    assert read.select("text").count() == 4
    assert read.select("is_destructive").count() == 4
    assert sorted(tuple(r) for r in training_rows(read).collect()) == [
        ("plain", 1.0),
        ('say "hi", ok', 0.0),
    ]


def test_csv_headers(spark, tmp_path):
    """Each file by its own header: either order, quoted, padded, `label`; without one it is an error."""
    for name, content in {
        "a": "is_destructive,text\n0,calm\n", "b": "text,is_destructive\nrude,1\n",
        "c": '"is_destructive","text"\n1,quoted\n', "d": "label,text\n0,other\n", "e": ' Text , "label"\nlast,1\n',
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(content)
    read = training_rows(read_training_csv(spark, str(tmp_path)))
    assert sorted(tuple(r) for r in read.collect()) == [
        ("calm", 0.0), ("last", 1.0), ("other", 0.0), ("quoted", 1.0), ("rude", 1.0),
    ]
    (tmp_path / "f.csv").write_text("class,text\n0,calm\n")
    with pytest.raises(Exception, match="no header of a text and a label"):
        read_training_csv(spark, str(tmp_path)).collect()


def test_csv_malformed_records_are_told(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    assert malformed_records(spark, str(tmp_path)).count() == 2


def test_cut_off_json_files_are_told(spark, tmp_path):
    schema = "id bigint, text string"
    (tmp_path / "a.json").write_text('[{"id": 1, "text": "a"}]')
    (tmp_path / "b.json").write_text('[{"id": 2, "text": "b"}, {"id": 3, "te')
    from pyspark.sql.types import StructType

    broken = broken_files(spark, str(tmp_path), StructType.fromDDL(schema)).collect()
    assert [r.file.rsplit("/", 1)[1] for r in broken] == ["b.json"]


def test_csv_append_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    texts = ['a "quoted", word', "back\\slash", " padded ", "comma, only", '"', "one\ntwo", "", "\\", "a\r\n", "\n"]
    for part in (texts[:3], texts[3:]):
        append_training_csv(rows([(t, 1) for t in part], "text string, is_destructive int"), path)
    assert sorted(r.text for r in read_training_csv(spark, path).collect()) == sorted(texts)


def test_appended_training_rows_bind_by_name(spark, rows, tmp_path):
    path = str(tmp_path / "training")
    append_training(rows([(0, "calm")], "is_destructive int, text string"), path, "base")
    append_training(rows([("rude", 1)], "text string, is_destructive int"), path, "forest")
    stored = spark.read.parquet(path)
    assert sorted(tuple(r) for r in stored.collect()) == [
        ("calm", 0, "base"),
        ("rude", 1, "forest"),
    ]
    assert training_rows(stored).count() == 2


def test_json_batches_are_arrays_below_dates(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    df = rows([(i, f"t\n{i}") for i in range(95)], "id bigint, text string").repartition(2)
    write_json_batches(df, path, F.lit("2024-01-01"), rows_per_file=10)
    files = list((tmp_path / "raw").rglob("*.txt"))
    assert 10 <= len(files) <= 12
    sizes = [len(json.loads(f.read_text())) for f in files]
    assert sum(sizes) == 95 and max(sizes) <= 10
    back = read_json_arrays(spark, path, df.schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_json_batches_of_long_records_are_cut_in_pieces():
    long = [json.dumps({"id": i, "text": "x" * (1 << 20)}) for i in range(12)]
    batch = pa.RecordBatch.from_pydict({"date": ["2024-01-01"] * 12 + [None], "value": [*long, "{}"]})
    cut = list(_json_arrays(500)(iter([batch, batch.slice(0, 0)])))
    assert max(part.nbytes for part in cut) < 6 << 20
    back = [record for part in cut for text in part.column("value").to_pylist() for record in json.loads(text)]
    assert back == [*map(json.loads, long), {}]


def test_day_buckets(spark, rows, tmp_path):
    path = str(tmp_path / "days")
    df = rows(
        [(1, "2024-01-01 10:00:00"), (2, "2024-01-02"), (3, None)], "id bigint, date string"
    )
    write_day_buckets(df, path, day_key(text=F.col("date"), as_of="2024-05-05"))
    assert sorted(os.listdir(path))[-3:] == [
        "date=2024-01-01",
        "date=2024-01-02",
        "date=2024-05-05",
    ]
    back = read_json_lines(spark, path, df.schema)
    assert sorted((r.id, r.date) for r in back.collect()) == [
        (1, "2024-01-01 10:00:00"),
        (2, "2024-01-02"),
        (3, None),
    ]


def test_crowded_day_is_split(spark, rows, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32KB")
    try:
        df = spark.range(0, 40000, 1, 4).select(
            F.lit("2024-01-01").alias("day"), F.md5(F.col("id").cast("string")).alias("text")
        )
        balanced(df, "day").write.partitionBy("day").parquet(str(tmp_path / "p"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(list((tmp_path / "p" / "day=2024-01-01").glob("*.parquet"))) > 1


def test_publish_replaces_and_keeps_on_empty(spark, rows, tmp_path):
    root = str(tmp_path)
    assert publish(rows([(1, "a")], "id int, t string"), "pub_a", root) == 1
    first = location(spark, "pub_a")
    assert publish(rows([], "id int, t string"), "pub_a", root) == 0
    assert spark.table("pub_a").count() == 1 and location(spark, "pub_a") == first
    # A table may be rewritten from itself.
    assert publish(spark.table("pub_a").withColumn("id", F.col("id") + 1), "pub_a", root) == 1
    assert [tuple(r) for r in spark.table("pub_a").collect()] == [(2, "a")]


def test_publish_partitioned(spark, rows, tmp_path):
    df = rows([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "id int, day string")
    assert publish(df, "pub_days", str(tmp_path), ("day",)) == 3
    back = spark.table("pub_days")
    assert back.dtypes == [("id", "int"), ("day", "string")]
    assert sorted((r.id, r.day) for r in back.collect()) == [
        (1, "2024-01-01"),
        (2, "2024-01-02"),
        (3, None),
    ]
    assert "PartitionFilters: [isnotnull(day" in final_plan(back.filter("day = '2024-01-02'"))


def test_missing_table(spark):
    with pytest.raises(MissingTable):
        require_table(spark, "no_such_table")


@pytest.mark.parametrize("partitions", [(), ("date",)])
def test_retention(spark, rows, tmp_path, partitions):
    name = f"kept_{len(partitions)}"
    dates = ["2024-01-20", "2024-01-13", "2024-01-12", None, "it's\\left"]
    df = rows(list(enumerate(dates)), "id int, date string")
    publish(df, name, str(tmp_path), partitions)
    done = retain(spark, name, "2024-01-20", str(tmp_path))
    assert (done.rows_before, done.rows_kept, done.rows_expired) == (5, 2, 3)
    assert done.rows_undated == 2 and done.changed
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 1]
    place = location(spark, name)
    assert not retain(spark, name, "2024-01-20", str(tmp_path)).changed
    assert location(spark, name) == place
    assert retain(spark, name, "2025-01-20", str(tmp_path)).rows_kept == 0
    assert spark.table(name).count() == 0


def test_expiry_counts_in_one_pass(rows):
    df = rows([("2024-01-20",), ("x",)], "date string")
    assert expiry(df, "2024-01-20").first().asDict() == {
        "rows_before": 2,
        "rows_kept": 1,
        "rows_expired": 1,
        "rows_undated": 1,
    }


def test_raw_file_ages(spark, tmp_path):
    now = datetime(2024, 1, 20, 12, 0, 0, tzinfo=UTC)
    for name, days in (("new", 1), ("edge", 7), ("old", 8)):
        folder = tmp_path / "date=x"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text('[{"id": 1}]')
        stamp = (now - timedelta(days=days)).timestamp()
        os.utime(folder / f"{name}.json", (stamp, stamp))
    ages = raw_file_ages(spark, str(tmp_path), now)
    keep = {r.path.rsplit("/", 1)[1]: r.keep for r in ages.collect()}
    assert keep == {"new.json": True, "edge.json": True, "old.json": False}
    options = modified_after(now)
    read = spark.read.options(**options).option("recursiveFileLookup", True)
    assert read.schema("id int").json(str(tmp_path)).count() == 2


def test_health(spark, rows, tmp_path):
    publish(rows([(1,)], "id int"), "h_ok", str(tmp_path))
    publish(rows([], "id int"), "h_empty", str(tmp_path), keep_empty=True)
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("not parquet")
    like = rows([], "id int")
    point_table(spark, "h_broken", str(broken), like)
    report = {
        r.table: (r.status, r.rows, bool(r.location))
        for r in health(spark, ["h_ok", "h_empty", "h_broken", "h_none"]).collect()
    }
    assert report == {
        "h_ok": ("OK", 1, True),
        "h_empty": ("EMPTY", 0, True),
        "h_broken": ("ERROR", None, False),
        "h_none": ("MISSING", None, False),
    }
    names = {r.tableName for r in list_tables(spark).collect()}
    assert {"h_ok", "h_empty", "h_broken"} <= names
    assert {r.table for r in health(spark).collect()} == names
    spark.sql("DROP TABLE h_broken")


def test_health_of_many_tables_takes_few_statements(spark, tmp_path, monkeypatch):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    names = [f"many_{i}" for i in range(60)]
    for name in names:
        point_table(spark, name, str(tmp_path / "t"))
    publish(spark.range(2), "many_published", str(tmp_path))
    statements, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: statements.append(text) or real(self, text, *a, **k))
    report = {r.table: (r.status, r.rows, r.location) for r in health(spark, [*names, "many_published", "many_none"]).collect()}
    assert len(statements) == 1
    assert all(report[n][:2] == ("OK", 3) and report[n][2].endswith("/t") for n in names)
    assert report["many_published"][:2] == ("OK", 2) and "/many_published/" in report["many_published"][2]
    assert report["many_none"] == ("MISSING", None, None)
    monkeypatch.undo()
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_samples_and_previews(rows):
    df = rows([(i, "x" * 200) for i in range(9, 0, -1)], "id int, text string")
    assert [r.id for r in sample_rows(df, "id").collect()] == [1, 2, 3]
    shown = previews(df, "id").collect()
    assert len(shown) == 5 and {len(r.preview) for r in shown} == {80}


def test_local_rows_cached_and_counted(spark):
    with cached(local_rows(spark, [("a", 1.0), ("b", 0.0)], "text string, label double")) as df:
        assert df.count() == 2
        assert "InMemoryTableScan" in final_plan(df)
    assert not df.is_cached


def test_cached_lets_go_after_an_error(spark):
    with pytest.raises(RuntimeError), cached(spark.range(3)) as df:
        df.count()
        raise RuntimeError
    assert not df.is_cached


def test_pruned_and_pushed_scan(spark, rows, tmp_path):
    df = rows([(1, "a", 1.0), (2, "b", 0.0)], "id int, text string, is_toxic_pred double")
    df.write.parquet(str(tmp_path / "p"))
    read = read_parquet(spark, str(tmp_path / "p"), ["id"], F.col("is_toxic_pred") == 1)
    text = final_plan(read)
    assert [r.id for r in read.collect()] == [1]
    assert "EqualTo(is_toxic_pred,1.0)" in text
    assert "ReadSchema: struct<id:int,is_toxic_pred:double>" in text


def test_staging_uses_the_shared_folder(spark, rows):
    assert staging_path(spark, "x").startswith(shared_root(spark) + "/textmill/x-")
    staged = stage(rows([(1, None)], "a int, b string"), "t")
    assert [tuple(r) for r in staged.collect()] == [(1, None)]


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get(setting, None)
    for size, parts in ((0, usual), (2**39, 12_288), (100 * 2**40, 2_457_600)):
        with sized_shuffles(spark, size) as n:
            assert n == parts and spark.conf.get(setting) == str(parts)
        assert spark.conf.get(setting, None) == before
    # A plan made meanwhile starts with that many partitions, and AQE joins them.
    with sized_shuffles(spark, 2**32):
        grouped = spark.range(1000).groupBy(F.col("id") % 7).count()
        assert "hashpartitioning" in plan(grouped) and ", 96)" in plan(grouped)
        assert len(grouped.collect()) == 7
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x").write_bytes(b"x" * 10)
    (tmp_path / "a" / "b" / "y").write_bytes(b"y" * 7)
    assert file_bytes(spark, str(tmp_path / "a")) == 17


def test_discard(spark):
    start = time.perf_counter()
    discard(spark.range(10))
    assert time.perf_counter() - start < 60
