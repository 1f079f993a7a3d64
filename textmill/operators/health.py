"""Table health: existence, row counts, locations, previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import preview
from textmill.sinks.publish import PARTS, VERSION, VERSION_PATTERN, quoted

_REPORT = "table string, status string, rows bigint, location string"


def list_tables(spark: SparkSession) -> DataFrame:
    """`namespace, tableName, isTemporary` of the current database, without the versions of published tables."""
    return spark.sql("SHOW TABLES").filter(~F.col("tableName").rlike(VERSION_PATTERN))


def located(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """`table, location` of those of the tables that exist, from one statement for each database.

    A published table lies where its first version table does; the location is null for other views.
    """
    by_database: dict[str, list[str]] = {}
    for name in names:
        database, _, table = name.rpartition(".")
        by_database.setdefault(database, []).append(table)
    listings = []
    for database, tables in by_database.items():
        pattern = "|".join(f"{t}|{t}{VERSION}*" for t in tables)
        inside = f" IN {database}" if database else ""
        listed = spark.sql(f"SHOW TABLE EXTENDED{inside} LIKE {quoted(pattern)}")
        prefix = F.lit(f"{database}." if database else "")
        listings.append(listed.select(
            F.concat(prefix, "tableName").alias("table"),
            F.regexp_extract("information", r"(?m)^Location: (.*)$", 1).alias("own"),
            F.regexp_extract("information", rf"{PARTS}=([^,\]]*)", 1).alias("part"),
        ))
    tables = reduce(DataFrame.union, listings)
    versions = tables.filter(F.col("table").rlike(VERSION_PATTERN)).select(F.col("table").alias("part"), F.col("own").alias("there"))
    found = tables.filter(~F.col("table").rlike(VERSION_PATTERN)).join(versions, "part", "left")
    return found.select("table", F.nullif(F.coalesce("there", "own"), F.lit("")).alias("location"))


def location(spark: SparkSession, name: str) -> str | None:
    """Where a table's files lie, the first place of several; null for a view that was not published."""
    row = located(spark, [name]).first()
    return row["location"] if row else None


def health(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """`table, status, rows, location` with status OK, EMPTY, MISSING or ERROR.

    Without names, the tables of the current database are checked. However many
    they are, one statement for each database lists them and one query counts
    them; only if that fails are they counted one by one, to find the broken ones.
    """
    if names is None:
        names = [r["tableName"] for r in list_tables(spark).collect()]
    if not names:
        return spark.createDataFrame([], _REPORT)
    present = {r["table"]: r["location"] for r in located(spark, names).collect()}
    given = {name: name.lower() for name in names}  # the catalog lists names in lower case
    counted = _counts(spark, [n for n in names if given[n] in present])
    if counted is None:
        counted = {}
        for name in names:
            if given[name] in present:
                counted.update(_counts(spark, [name]) or {})
    report = []
    for name in names:
        rows = counted.get(name)
        if given[name] not in present:
            report.append((name, "MISSING", None, None))
        elif rows is None:
            report.append((name, "ERROR", None, None))
        else:
            report.append((name, "OK" if rows else "EMPTY", rows, present[given[name]]))
    return spark.createDataFrame(report, _REPORT)


def _counts(spark: SparkSession, names: Sequence[str]) -> dict[str, int] | None:
    if not names:
        return {}
    try:
        return {r["table"]: r["rows"] for r in row_counts(spark, names).collect()}
    except (PySparkException, Py4JJavaError):
        return None


def row_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """`table, rows`, one row per table; no column is read."""
    counts = [
        spark.table(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows")
        for n in names
    ]
    return reduce(DataFrame.unionByName, counts)


def sample_rows(df: DataFrame, order: str, n: int = 3) -> DataFrame:
    """A few rows for a look at a table, the same ones each time."""
    return df.orderBy(order).limit(n)


def previews(df: DataFrame, order: str, text: str = "text", n: int = 5) -> DataFrame:
    """The starts of the first n texts. Texts are cut before they are compared or moved."""
    return df.select(order, preview(F.col(text)).alias("preview")).orderBy(order).limit(n)
