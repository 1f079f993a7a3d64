"""Cleaning, deduplication, content and date checks."""

from pyspark.sql import functions as F

from textmill.functions.dates import day_key
from textmill.functions.labels import numeric_label
from textmill.functions.text import one_line
from textmill.operators.clean import clean_comments, clean_posts, training_rows, with_content
from textmill.operators.dedup import first_per_text
from textmill.operators.retention import expiry, recent
from textmill.queries import query
from textmill.queries.inputs import labelled, raw_comments, raw_posts, table


POSTS_SQL = r"""
    select doc_id as id, -1000000000000 - cast(substr(source, 4) as bigint) as chat_id,
           '2024-01-01' as date, trim(regexp_replace(text, '[\n\r]', ' ', 'g')) as text,
           n_chars as views
    from documents"""
COMMENTS_SQL = r"""
    select id, post_id, chat_id, author_name, date, text from (
        select conv_id as id, conv_id as post_id, -1000000000000 as chat_id,
               role as author_name,
               cast(date '2024-01-01' + cast(turn as integer) as varchar) as date,
               trim(regexp_replace(text, '[\n\r]', ' ', 'g')) as text,
               row_number() over (partition by conv_id order by turn desc) as rn
        from conversations) s
    where rn = 1"""


@query(
    "normalized_texts",
    r"""select doc_id, trim(regexp_replace(text, '[\n\r]', ' ', 'g')) as text from documents""",
)
def normalized_texts(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", one_line(F.col("text")).alias("text")
    )


@query("cleaned_posts", POSTS_SQL)
def cleaned_posts(spark, folder):
    return clean_posts(raw_posts(spark, folder))


@query("cleaned_comments", COMMENTS_SQL)
def cleaned_comments(spark, folder):
    return clean_comments(raw_comments(spark, folder))


@query(
    "first_document_per_text",
    """select doc_id, text from (
           select doc_id, text, row_number() over (partition by text order by doc_id) as rn
           from documents) s
       where rn = 1""",
)
def first_document_per_text(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return first_per_text(documents, "text", ("doc_id",))


@query("distinct_texts", "select distinct text, lang from documents")
def distinct_texts(spark, folder):
    return table(spark, folder, "documents").select("text", "lang").distinct()


@query(
    "content_documents",
    """select doc_id, n_chars from documents
       where text is not null and lower(trim(text)) <> 'nan' and length(trim(text)) > 1""",
)
def content_documents(spark, folder):
    return with_content(table(spark, folder, "documents"), "text").select("doc_id", "n_chars")


@query(
    "training_rows",
    """select d.text, cast(l.toxic as double) as label
       from documents d join labels l using (doc_id)
       where d.text is not null and l.toxic is not null""",
)
def valid_training_rows(spark, folder):
    return training_rows(labelled(spark, folder))


@query(
    "numeric_props",
    """select event_id, try_cast(regexp_extract(props, '[0-9]+') as double) as number,
              cast(value as bigint) is not null as has_value
       from events""",
)
def numeric_props(spark, folder):
    digits = F.regexp_extract("props", "[0-9]+", 0)
    return table(spark, folder, "events").select(
        "event_id",
        numeric_label(digits).alias("number"),
        F.col("value").try_cast("bigint").isNotNull().alias("has_value"),
    )


@query(
    "recent_events",
    """select event_id, cast(cast(ts as date) as varchar) as day from events
       where cast(ts as date) >= date '2024-01-20' - 7""",
)
def recent_events(spark, folder):
    days = table(spark, folder, "events").select(
        "event_id", F.to_date("ts").cast("string").alias("day")
    )
    return recent(days, "2024-01-20", 7, "day")


@query(
    "event_expiry",
    """select count(*) as rows_before,
              count(*) filter (where cast(ts as date) >= date '2024-01-20' - 7) as rows_kept,
              count(*) filter (where cast(ts as date) < date '2024-01-20' - 7) as rows_expired,
              count(*) filter (where ts is null) as rows_undated
       from events""",
)
def event_expiry(spark, folder):
    return expiry(table(spark, folder, "events"), "2024-01-20", 7, "ts")


@query(
    "event_days",
    """select event_id, substr(cast(ts as varchar), 1, 10) as from_text,
              substr(cast(ts as varchar), 1, 10) as from_seconds,
              substr(cast(ts as varchar), 1, 10) as from_moment
       from events""",
)
def event_days(spark, folder):
    days = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60
    return table(spark, folder, "events").select(
        "event_id",
        day_key(text=F.col("ts").cast("string")).alias("from_text"),
        day_key(seconds=seconds).alias("from_seconds"),
        day_key(moment=F.col("ts")).alias("from_moment"),
    )
