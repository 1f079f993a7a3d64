"""Replication for load tests."""

from pyspark.sql import functions as F

from textmill.operators.replicate import grow_to, replicate, replicate_dates, take_exact
from textmill.queries import query
from textmill.queries.inputs import table
from textmill.session import staging_path
from textmill.sinks.files import write_parquet

_COPIES = """
    select conv_id + idx * {shift} as id, turn, role, text
    from conversations, range(5) t(idx)"""


def _conversations(spark, folder):
    return table(spark, folder, "conversations").withColumnRenamed("conv_id", "id")


@query("replicated_by_rows", _COPIES.format(shift="(select count(*) from conversations)"))
def replicated_by_rows(spark, folder):
    return replicate(_conversations(spark, folder), 5)


@query(
    "replicated_by_range",
    _COPIES.format(shift="(select max(conv_id) - min(conv_id) + 1 from conversations)"),
)
def replicated_by_range(spark, folder):
    return replicate(_conversations(spark, folder), 5, shift="range")


@query(
    "replicated_dates",
    """select event_id, cast(cast(ts as date) - cast(idx as integer) as varchar) as date,
              true as is_synthetic
       from events, range(5) t(idx)""",
)
def replicated_dates(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.col("ts").alias("date"))
    return replicate_dates(events, 5).withColumn("date", F.col("date").cast("string"))


@query(
    "grown_rows",
    """select 2 * count(*) + count(*) // 2 as rows, count(*) as ids, 2 as fewest, 3 as most
       from documents""",
)
def grown_rows(spark, folder):
    """The documents grown to two and a half times their number."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    path = staging_path(spark, "grow")
    write_parquet(documents, path)
    rows = documents.count()
    copies = grow_to(spark, path, 2 * rows + rows // 2).groupBy("doc_id").agg(
        F.count("*").alias("copies")
    )
    return copies.agg(
        F.sum("copies").alias("rows"),
        F.count("*").alias("ids"),
        F.min("copies").cast("int").alias("fewest"),
        F.max("copies").cast("int").alias("most"),
    )


@query(
    "exact_part",
    """select count(*) * 3 // 5 as rows, count(*) * 3 // 5 as ids from documents""",
)
def exact_part(spark, folder):
    """Three fifths of the stored rows, each once."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    path = staging_path(spark, "part")
    write_parquet(documents, path)
    part = take_exact(spark, path, documents.count() * 3 // 5)
    return part.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids"))
