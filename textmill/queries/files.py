"""Round trips through files and catalog tables, and streams over files."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from textmill.functions.dates import day_key
from textmill.operators.clean import clean_comments, training_rows
from textmill.operators.health import health, list_tables, previews, row_counts, sample_rows
from textmill.operators.retention import retain
from textmill.plans.cycle import (
    broken_raw_files,
    clean_new_comments,
    clean_new_posts,
    current_comments,
    current_posts,
)
from textmill.queries import query
from textmill.queries.cleaning import COMMENTS_SQL, POSTS_SQL
from textmill.queries.inputs import (
    labelled,
    line_form,
    raw_comments,
    raw_posts,
    scored,
    table,
    table_stream,
)
from textmill.session import staging_path
from textmill.sinks.files import (
    append_training_csv,
    write_day_buckets,
    write_json_batches,
    write_parquet,
)
from textmill.sinks.publish import point_table, publish
from textmill.sources.json_files import read_json_arrays, read_json_lines
from textmill.sources.label_lines import read_label_lines
from textmill.sources.raw_files import modified_after, raw_file_ages
from textmill.sources.tables import read_parquet, require_table
from textmill.sources.training_csv import read_training_csv
from textmill.streaming.incremental import append_new, clean_stream, new_files

HEALTH_TABLES = ("documents", "labels", "conversations", "events", "benchmark")


def _batches(spark, folder):
    """The documents as raw JSON-array files below date folders."""
    path = staging_path(spark, "batches")
    documents = table(spark, folder, "documents")
    write_json_batches(documents, path, F.lit("2024-01-01"))
    return path, documents.schema


@query("json_array_files", "select doc_id, text, lang, source, n_chars from documents")
def json_array_files(spark, folder):
    path, schema = _batches(spark, folder)
    return read_json_arrays(spark, path, schema)


@query("recent_raw_files", "select doc_id, n_chars from documents")
def recent_raw_files(spark, folder):
    """The rows of files not older than seven days, which all just written are."""
    path, schema = _batches(spark, folder)
    recent = modified_after(datetime.now(UTC))
    return read_json_arrays(spark, path, schema, **recent).select("doc_id", "n_chars")


@query("raw_file_ages")
def file_ages(spark, folder):
    path, _ = _batches(spark, folder)
    return raw_file_ages(spark, path, datetime.now(UTC)).select("bytes", "keep")


@query(
    "day_bucket_files",
    """select substr(cast(ts as varchar), 1, 10) as day, count(*) as events,
              count(distinct event_id) as ids
       from events group by 1""",
)
def day_bucket_files(spark, folder):
    path = staging_path(spark, "days")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("string"))
    write_day_buckets(events, path, day_key(text=F.col("ts")))
    back = spark.read.schema("event_id bigint, date string").json(path)
    return back.groupBy(F.col("date").alias("day")).agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("ids")
    )


@query("json_line_files", "select event_id, user_id, event_type, value, props from events")
def json_line_files(spark, folder):
    path = staging_path(spark, "lines")
    events = table(spark, folder, "events").drop("ts")
    write_day_buckets(events, path, F.lit("2024-01-01"))
    return read_json_lines(spark, path, events.schema)


@query(
    "training_csv_files",
    """select d.text, cast(l.toxic as double) as label
       from documents d join labels l using (doc_id)
       where d.text is not null and l.toxic is not null""",
)
def training_csv_files(spark, folder):
    path = staging_path(spark, "csv")
    append_training_csv(labelled(spark, folder).select("is_destructive", "text"), path)
    return training_rows(read_training_csv(spark, path))


@query(
    "raw_training_csv_files",
    """select d.text, cast(l.toxic as varchar) as is_destructive
       from documents d join labels l using (doc_id)""",
)
def raw_training_csv_files(spark, folder):
    """The texts as they are: line breaks, blanks at the ends and empty texts come back."""
    path = staging_path(spark, "csv")
    append_training_csv(labelled(spark, folder).select("is_destructive", "text"), path)
    return read_training_csv(spark, path)


@query(
    "label_line_files",
    r"""select l.toxic as is_destructive,
               regexp_replace(regexp_replace(d.text, '[\n\r]', ' ', 'g'),
                              '^\s+|\s+$', '', 'g') as text
        from documents d join labels l using (doc_id)""",
)
def label_line_files(spark, folder):
    path = staging_path(spark, "label-lines")
    label = F.when(F.col("is_destructive") == 1, "__label__INSULT,__label__NORMAL").otherwise(
        "__label__NORMAL"
    )
    lines = labelled(spark, folder).select(
        F.concat_ws(" ", label, line_form(F.col("text"))).alias("value")
    )
    lines.write.text(path)
    return read_label_lines(spark, path)


@query(
    "parquet_files",
    "select doc_id, text, lang, source, n_chars from documents",
)
def parquet_files(spark, folder):
    path = staging_path(spark, "parquet")
    write_parquet(table(spark, folder, "documents"), path, ("lang",))
    documents = spark.read.schema(table(spark, folder, "documents").schema).parquet(path)
    return documents.select("doc_id", "text", "lang", "source", "n_chars")


@query(
    "published_table",
    "select lang, count(*) as rows, cast(sum(n_chars) as bigint) as chars "
    "from documents group by lang",
)
def published_table(spark, folder):
    publish(table(spark, folder, "documents"), "published_documents", staging_path(spark, "tables"))
    return (
        require_table(spark, "published_documents")
        .groupBy("lang")
        .agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars"))
    )


@query(
    "flagged_scan",
    """select id, toxicity_score from (
           select doc_id as id,
                  floor(cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 4) as integer)
                        * 101 / cast(65536 as double)) / 100 as toxicity_score
           from documents) s
       where toxicity_score > cast(0.40 as double)""",
)
def flagged_scan(spark, folder):
    path = staging_path(spark, "predictions")
    write_parquet(scored(spark, folder), path)
    return read_parquet(spark, path, ["id", "toxicity_score"], F.col("is_toxic_pred") == 1)


@query(
    "retained_table",
    """select event_id, cast(cast(ts as date) as varchar) as day from events
       where cast(ts as date) >= date '2024-01-20' - 7""",
)
def retained_table(spark, folder):
    root = staging_path(spark, "retention")
    events = table(spark, folder, "events").select(
        "event_id", F.to_date("ts").cast("string").alias("day")
    )
    publish(events, "retained_events", root, ("day",))
    retain(spark, "retained_events", "2024-01-20", root, 7, "day")
    return spark.table("retained_events")


@query(
    "retained_files",
    """select event_id, cast(cast(ts as date) as varchar) as day from events
       where cast(ts as date) >= date '2024-01-20' - 7""",
)
def retained_files(spark, folder):
    """As `retained_table`, of a table without partitions: only files with expired rows are read and written again."""
    root = staging_path(spark, "retention")
    events = table(spark, folder, "events").select("event_id", F.to_date("ts").cast("string").alias("day"))
    publish(events.repartitionByRange(16, "day", "event_id"), "file_retained_events", root)
    retain(spark, "file_retained_events", "2024-01-20", root, 7, "day")
    return spark.table("file_retained_events")


@query(
    "retained_by_time",
    """select id, cast(date '2024-01-01' + cast(turn as integer) as varchar) as day
       from (select conv_id as id, max(turn) as turn from conversations group by conv_id) t
       where date '2024-01-01' + cast(turn as integer) >= date '2024-01-12' - 7""",
)
def retained_by_time(spark, folder):
    """Comments of which half have no date: their time gives the day that retention goes by."""
    root = staging_path(spark, "retention")
    comments = raw_comments(spark, folder)
    seconds = F.unix_timestamp(F.to_timestamp("date"))
    undated = F.when(F.col("comment_id") % 2 == 0, F.col("date"))
    timed = comments.withColumns({"ts": seconds, "date": undated})
    publish(clean_comments(timed, day="day"), "timed_comments", root, ("day",))
    retain(spark, "timed_comments", "2024-01-12", root, 7, "day")
    return spark.table("timed_comments").select("id", "day")


@query(
    "republished_table",
    "select lang, source, count(*) as rows, cast(sum(n_chars) as bigint) as chars from documents group by lang, source",
)
def republished_table(spark, folder):
    """A table published twice, the second time from itself, with a column and a partitioning more."""
    root, name = staging_path(spark, "tables"), "republished_documents"
    documents = table(spark, folder, "documents")
    publish(documents.select("doc_id", "n_chars", "lang"), name, root)
    more = require_table(spark, name).join(documents.select("doc_id", "source"), "doc_id")
    publish(more, name, root, ("lang",))
    return (
        require_table(spark, name)
        .groupBy("lang", "source")
        .agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars"))
    )


@query("set_aside_files", "select doc_id from documents")
def set_aside_files(spark, folder):
    """All documents' ids in cut-off raw files, which the incremental clean sets aside with their contents."""
    path = staging_path(spark, "cycle")
    posts = table(spark, folder, "documents").select(F.col("doc_id").alias("post_id"))
    write_json_batches(posts, f"{path}/whole", F.lit("2024-01-01"))
    files = spark.read.text(f"{path}/whole", wholetext=True, recursiveFileLookup=True)
    # Without the array's last bracket; every file stays a file of its own.
    cut = files.select(F.rtrim("value", F.lit("]\n")).alias("value"), F.md5(F.col("value").cast("binary")).alias("file"))
    cut.write.partitionBy("file").text(f"{path}/raw")
    clean_new_posts(spark, f"{path}/raw", path)
    kept = current_posts(spark, path).select("id")
    ids = F.regexp_extract_all("content", F.lit('"post_id":([0-9]+)')).cast("array<bigint>")
    return broken_raw_files(spark, path).select(F.explode(ids).alias("doc_id")).union(kept)


@query(
    "table_health",
    "\nunion all\n".join(
        [
            f"""select 'health_{t}' as "table",
                       case when count(*) > 0 then 'OK' else 'EMPTY' end as status,
                       count(*) as rows, '{t}.parquet' as location from {t}"""
            for t in HEALTH_TABLES
        ]
        + ["""select 'health_missing', 'MISSING', cast(null as bigint), cast(null as varchar)"""]
    ),
)
def table_health(spark, folder):
    for name in HEALTH_TABLES:
        point_table(spark, f"health_{name}", f"{folder}/{name}.parquet")
    names = [f"health_{name}" for name in (*HEALTH_TABLES, "missing")]
    # Where a table lies, without the folder of this run's tables.
    last = F.regexp_extract("location", "[^/]+$", 0)
    return health(spark, names).withColumn("location", F.when(last != "", last))


@query("listed_tables", "select 'listed_documents' as name union all select 'listed_labels'")
def listed_tables(spark, folder):
    for name in ("documents", "labels"):
        point_table(spark, f"listed_{name}", f"{folder}/{name}.parquet")
    return list_tables(spark).filter("tableName like 'listed_%'").select(F.col("tableName").alias("name"))


@query(
    "table_row_counts",
    "\nunion all\n".join(
        f"""select 'count_{t}' as "table", count(*) as rows from {t}""" for t in HEALTH_TABLES
    ),
)
def table_row_counts(spark, folder):
    for name in HEALTH_TABLES:
        point_table(spark, f"count_{name}", f"{folder}/{name}.parquet")
    return row_counts(spark, [f"count_{name}" for name in HEALTH_TABLES])


@query(
    "sample_rows",
    "select doc_id, lang, source, n_chars from documents order by doc_id limit 3",
)
def first_rows(spark, folder):
    documents = table(spark, folder, "documents")
    return sample_rows(documents.select("doc_id", "lang", "source", "n_chars"), "doc_id")


@query(
    "text_previews",
    "select doc_id, substr(text, 1, 80) as preview from documents order by doc_id limit 5",
)
def text_previews(spark, folder):
    return previews(table(spark, folder, "documents"), "doc_id")


@query(
    "streamed_clean",
    r"""select doc_id, trim(regexp_replace(text, '[\n\r]', ' ', 'g')) as text, lang
        from documents""",
)
def streamed_clean(spark, folder):
    cleaned = clean_stream(table_stream(spark, folder, "documents")).select("doc_id", "text", "lang")
    path = staging_path(spark, "stream")
    append_new(cleaned, f"{path}/rows", f"{path}/progress", ["doc_id"], "lang")
    return spark.read.schema(cleaned.schema).parquet(f"{path}/rows")


@query("streamed_clean_recent", "select event_id, trim(props) as props from events")
def streamed_clean_recent(spark, folder):
    """All events, from files in no order of time, taken a few at a time and every event twice."""
    path = staging_path(spark, "stream")
    events = table(spark, folder, "events")
    twice = events.union(events).repartition(8, F.xxhash64("event_id") % 5)
    twice.write.parquet(f"{path}/raw")
    stream = new_files(spark, f"{path}/raw", events.schema, maxFilesPerTrigger="2")
    timed = stream.withColumn("day", F.to_date("ts").cast("string"))
    cleaned = clean_stream(timed, "props").select("event_id", "props", "day")
    append_new(cleaned, f"{path}/rows", f"{path}/progress", ["event_id"])
    stored = spark.read.schema("event_id bigint, props string").parquet(f"{path}/rows")
    return stored.select("event_id", "props")


@query("cycled_posts", POSTS_SQL)
def cycled_posts(spark, folder):
    """The documents as raw files, taken in by the incremental clean."""
    path = staging_path(spark, "cycle")
    write_json_batches(raw_posts(spark, folder), f"{path}/raw", F.lit("2024-01-01"))
    clean_new_posts(spark, f"{path}/raw", path)
    return current_posts(spark, path)


@query("cycled_comments", COMMENTS_SQL)
def cycled_comments(spark, folder):
    """All turns of a conversation as versions of a comment, in files by date."""
    path = staging_path(spark, "cycle")
    write_json_batches(raw_comments(spark, folder), f"{path}/raw", F.col("date"))
    clean_new_comments(spark, f"{path}/raw", path)
    return current_comments(spark, path)
