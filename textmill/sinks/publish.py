"""Publishing a frame as a table that readers never find missing.

A published name is a view over version tables, each of which stands for the
files of one location. New files get a version table of their own; then one
catalog statement, `CREATE OR REPLACE VIEW`, moves the name to it. Whatever
fails before leaves the name on the version it had. The version before the
current one stays in the catalog for readers that have resolved it; older
entries are dropped. No file is deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.sinks.files import balanced, counted, write_parquet

# Version tables end with this and 32 hexadecimal digits.
VERSION = "__v_"
VERSION_PATTERN = VERSION + "[0-9a-f]{32}$"
PARTS = "textmill.parts"
_BEFORE, _WITHOUT = "textmill.before", "textmill.without"


@dataclass(frozen=True)
class Part:
    """A version table, less the files that no longer count."""

    table: str
    without: tuple[str, ...] = ()


def quoted(value: str | None) -> str:
    """A SQL string."""
    if value is None:
        return "null"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def publish(
    df: DataFrame, name: str, root: str, partition_by: tuple[str, ...] = (), keep_empty: bool = False
) -> int:
    """Write the frame to a new folder below `root/name` and move the name to it.

    Returns the number of rows written. With no rows the table
    keeps what it has, unless `keep_empty` is set. The old files stay, so a
    frame may be published over the table it is read from, and a failed write
    leaves the table whole.
    """
    location, count = write_version(df, name, root, partition_by)
    if count or keep_empty:
        switch(df.sparkSession, name, [Part(add_version(df, name, location, partition_by))])
    return count


def write_version(df: DataFrame, name: str, root: str, partition_by: tuple[str, ...] = ()) -> tuple[str, int]:
    """The folder the frame was written to, and the number of rows, counted on their way."""
    location = f"{root}/{name}/{uuid.uuid4().hex}"
    with counted(balanced(df, *partition_by) if partition_by else df) as (rows, count):
        write_parquet(rows, location, partition_by)
    return location, count()


def add_version(like: DataFrame, name: str, location: str, partition_by: tuple[str, ...] = ()) -> str:
    """A new version table for the files at a location, which no reader sees yet."""
    version = f"{name}{VERSION}{uuid.uuid4().hex}"
    _create(like.sparkSession, version, location, like.schema, partition_by)
    return version


def parts_of(spark: SparkSession, name: str) -> list[Part]:
    """The version tables that a published name stands for; none for other tables and views."""
    properties = _properties(spark, name)
    parts = {t: [] for t in properties.get(PARTS, "").split(",") if t}
    for key, value in properties.items():
        if key.startswith(_WITHOUT):
            table, _, file = value.partition("|")
            parts[table].append(file)
    return [Part(table, tuple(sorted(files))) for table, files in parts.items()]


def part_rows(spark: SparkSession, part: Part) -> DataFrame:
    """The rows of a part; files that no longer count are not opened."""
    rows = spark.table(part.table)
    return rows.filter(~F.col("_metadata.file_path").isin(*part.without)) if part.without else rows


def switch(spark: SparkSession, name: str, parts: Sequence[Part]) -> None:
    """Let a name stand for these parts, in one catalog statement.

    Only a plain table of that name, as `point_table` makes it, has to be dropped first.
    """
    before, stale = [], []
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")
        else:
            kept = {p.table for p in parts}
            before = [p.table for p in parts_of(spark, name) if p.table not in kept]
            older = [t for t in _properties(spark, name).get(_BEFORE, "").split(",") if t]
            stale = [t for t in older if t not in kept and t not in before]
    columns = ", ".join(f"`{c}`" for c in spark.table(parts[0].table).columns)
    selects = []
    for part in parts:
        where = f" WHERE _metadata.file_path NOT IN ({', '.join(map(quoted, part.without))})" if part.without else ""
        selects.append(f"SELECT {columns} FROM {part.table}{where}")
    properties = {PARTS: ",".join(p.table for p in parts), _BEFORE: ",".join(before)}
    files = [f"{p.table}|{file}" for p in parts for file in p.without]
    properties |= {f"{_WITHOUT}.{number}": value for number, value in enumerate(files)}
    listed = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS {' UNION ALL '.join(selects)}")
    for table in stale:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def without_files(part: Part, files: Sequence[str]) -> Part:
    return replace(part, without=tuple(sorted({*part.without, *files})))


def point_table(
    spark: SparkSession,
    name: str,
    location: str,
    like: DataFrame | None = None,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Let a plain catalog table stand for the Parquet files at a location.

    A table without partitions that has the same columns already is moved by one
    statement; another one is dropped and made anew.
    """
    if spark.catalog.tableExists(name):
        plain = spark.catalog.getTable(name).tableType != "VIEW"
        wanted = like.schema if like is not None else spark.read.parquet(location).schema
        same = [(f.name, f.dataType) for f in wanted] == [(f.name, f.dataType) for f in spark.table(name).schema]
        partitioned = partition_by or any(c.isPartition for c in spark.catalog.listColumns(name))
        if plain and same and not partitioned:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(location)}")
            spark.sql(f"REFRESH TABLE {name}")
            return
        spark.sql(f"DROP {'TABLE' if plain else 'VIEW'} {name}")
    _create(spark, name, location, like.schema if like is not None else None, partition_by)


def _create(
    spark: SparkSession, name: str, location: str, schema: T.StructType | None, partition_by: tuple[str, ...]
) -> None:
    columns, partitions = "", ""
    if schema is not None:
        fields = sorted(schema, key=lambda f: f.name in partition_by)
        columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ")"
    if partition_by:
        partitions = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    spark.sql(f"CREATE TABLE {name} {columns} USING parquet {partitions} LOCATION {quoted(location)}")
    if partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
