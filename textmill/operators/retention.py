"""Date retention of tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.dates import within_days
from textmill.session import cached
from textmill.sinks.publish import (
    Part,
    add_version,
    part_rows,
    parts_of,
    publish,
    quoted,
    switch,
    without_files,
    write_version,
)
from textmill.sources.tables import require_table

# Fixed value.
RETENTION_DAYS = 7

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_DROPPED_AT_ONCE = 500
# A table of more parts, or with more files left out, is written anew instead.
_MOST_PARTS = 16
_MOST_FILES = 2000

_COUNTS = ("rows_before", "rows_kept", "rows_expired", "rows_undated")


def recent(
    df: DataFrame, as_of: str, days: int = RETENTION_DAYS, date_col: str = "date"
) -> DataFrame:
    """The rows dated on or after `as_of - days`; unreadable dates count as expired."""
    return df.filter(within_days(F.col(date_col), as_of, days))


def expiry(
    df: DataFrame, as_of: str, days: int = RETENTION_DAYS, date_col: str = "date", by: Sequence[str] = ()
) -> DataFrame:
    """`rows_before, rows_kept, rows_expired, rows_undated` in one pass over the date column, for each `by`."""
    keep = within_days(F.col(date_col), as_of, days)
    undated = F.col(date_col).try_cast("date").isNull()
    return df.groupBy(*by).agg(
        F.count("*").alias("rows_before"),
        F.count_if(keep).alias("rows_kept"),
        F.count_if(~keep).alias("rows_expired"),
        F.count_if(undated).alias("rows_undated"),
    )


@dataclass(frozen=True)
class Retained:
    rows_before: int
    rows_kept: int
    rows_expired: int
    rows_undated: int
    changed: bool


def retain(
    spark: SparkSession,
    name: str,
    as_of: str,
    root: str,
    days: int = RETENTION_DAYS,
    date_col: str = "date",
) -> Retained:
    """Take expired rows out of a table; it stays untouched if none expire.

    A table partitioned by the date column alone loses its expired partitions,
    and no row is read or written. Of any other published table only the files
    with expired rows are read again and their other rows written; the rest of
    its files stay where they are. A table that was not published is published
    anew with the kept rows.
    """
    table = require_table(spark, name)
    parts = parts_of(spark, name)
    single = parts[0].table if parts else name
    partitions = tuple(c.name for c in spark.catalog.listColumns(single) if c.isPartition)
    if parts and partitions != (date_col,):
        return _retain_files(spark, name, parts, partitions, as_of, root, days, date_col)
    counts = expiry(table, as_of, days, date_col).first().asDict()
    stale = counts["rows_expired"] > 0
    if stale:
        if partitions == (date_col,):
            for held in [p.table for p in parts] or [name]:
                _drop_partitions(spark, held, as_of, days, date_col)
        else:
            publish(recent(table, as_of, days, date_col), name, root, partitions, keep_empty=True)
    return Retained(**counts, changed=stale)


def _retain_files(
    spark: SparkSession, name: str, parts: Sequence[Part], partitions: tuple[str, ...],
    as_of: str, root: str, days: int, date_col: str,
) -> Retained:
    """Leave out the files with expired rows, and add a part with the other rows of those files."""
    marked = [
        part_rows(spark, p).select(F.lit(n).alias("_part"), F.col("_metadata.file_path").alias("_file"), date_col)
        for n, p in enumerate(parts)
    ]
    files = expiry(reduce(DataFrame.unionByName, marked), as_of, days, date_col, ["_part", "_file"])
    with cached(files) as files:  # one row a file
        totals = files.agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS], F.count_if(F.col("rows_expired") > 0).alias("files")
        ).first().asDict()
        count = totals.pop("files")
        whole = len(parts) >= _MOST_PARTS or sum(len(p.without) for p in parts) + count > _MOST_FILES
        touched = [] if whole else files.filter("rows_expired > 0").select("_part", "_file", "rows_kept").collect()
    if count:
        if whole:
            publish(recent(spark.table(name), as_of, days, date_col), name, root, partitions, keep_empty=True)
        else:
            gone = [[r["_file"] for r in touched if r["_part"] == n] for n in range(len(parts))]
            left = [without_files(p, f) for p, f in zip(parts, gone)]
            if any(r["rows_kept"] for r in touched):
                mixed = {r["_file"] for r in touched if r["rows_kept"]}
                some = [
                    spark.table(p.table).filter(F.col("_metadata.file_path").isin(*own))
                    for p, f in zip(parts, gone) if (own := [x for x in f if x in mixed])
                ]
                kept = recent(reduce(DataFrame.unionByName, some), as_of, days, date_col)
                location, _ = write_version(kept, name, root, partitions)
                left.append(Part(add_version(kept, name, location, partitions)))
            switch(spark, name, left)
    return Retained(**totals, changed=count > 0)


def _drop_partitions(spark: SparkSession, name: str, as_of: str, days: int, date_col: str) -> None:
    """Drop what the catalog lists and the rule expires, some partitions a statement.

    The table is external: its folders stay until whoever runs the warehouse
    removes those that no table lists any more.
    """
    value = F.expr("substring(partition, locate('=', partition) + 1)")
    # The list writes some characters as %XX.
    value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    value = F.when(value != _NULL_PARTITION, value)
    listed = spark.sql(f"SHOW PARTITIONS {name}").select(value.alias("day"))
    specs = [
        f"PARTITION (`{date_col}` = {quoted(r['day'])})"
        for r in listed.filter(~within_days(F.col("day"), as_of, days)).toLocalIterator()
    ]
    for start in range(0, len(specs), _DROPPED_AT_ONCE):
        some = ", ".join(specs[start : start + _DROPPED_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {some}")
