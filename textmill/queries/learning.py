"""Features, classifiers, and jobs that train and score."""

from pyspark.sql import functions as F

from textmill.functions.stopwords import forest_stop_words, spark_stop_words
from textmill.operators.classify import (
    forest,
    load,
    logistic,
    predict_class,
    predict_score,
    save,
    train,
)
from textmill.operators.features import (
    bucket_total,
    hashed_counts,
    inverse_document_frequency,
    remove_stop_words,
    term_counts,
    tokenize,
)
from textmill.operators.sample import TRAINING_FRACTIONS
from textmill.plans.medallion import Medallion
from textmill.plans.scalability import scoring_times, training_times
from textmill.queries import query
from textmill.queries.inputs import (
    digest_in_sample_sql,
    labelled,
    messages,
    raw_comments,
    raw_posts,
    table,
    table_stream,
    training,
)
from textmill.session import file_bytes, staging_path
from textmill.sinks.files import append_training, write_parquet
from textmill.streaming.incremental import run_available, score_stream


def _tokens_sql(pick: str = "tokens") -> str:
    """The token lists in SQL: split on white space, trailing blanks give no token."""
    return f"""
        select doc_id, {pick} as tokens from (
            select doc_id,
                   case when text <> '' and regexp_matches(text, '^\\s+$') then []
                        else regexp_split_to_array(
                            regexp_replace(lower(text), '\\s+$', ''), '\\s') end as tokens
            from documents where text is not null) s"""


def _kept_sql(words) -> str:
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return _tokens_sql(f"list_filter(tokens, lambda t: t not in ({listed}))")


def _digest_sql(tokens: str) -> str:
    return f"""select doc_id, len(tokens) as tokens,
                      md5(array_to_string(tokens, ' ')) as digest from ({tokens}) t"""


def _digest(df, words):
    joined = F.concat_ws(" ", F.col(words)).cast("binary")
    return df.select(
        "doc_id", F.size(words).cast("bigint").alias("tokens"), F.md5(joined).alias("digest")
    )


def _tokens(spark, folder):
    return tokenize(table(spark, folder, "documents").select("doc_id", "text"))


@query("tokens", _digest_sql(_tokens_sql()))
def tokens(spark, folder):
    return _digest(_tokens(spark, folder), "words")


@query("tokens_without_english", _digest_sql(_kept_sql(spark_stop_words("english"))))
def tokens_without_english(spark, folder):
    kept = remove_stop_words(_tokens(spark, folder), spark_stop_words("english"))
    return _digest(kept, "filtered")


@query("tokens_without_russian", _digest_sql(_kept_sql(forest_stop_words())))
def tokens_without_russian(spark, folder):
    return _digest(remove_stop_words(_tokens(spark, folder), forest_stop_words()), "filtered")


@query(
    "hashed_term_totals",
    f"""select doc_id, cast(len(tokens) as double) as total_1000,
               cast(len(tokens) as double) as total_2000,
               cast(len(tokens) as double) as total_5000
        from ({_tokens_sql()}) t""",
)
def hashed_term_totals(spark, folder):
    """Hash buckets may merge terms but lose none: each row's counts add up to its tokens."""
    counts = _tokens(spark, folder)
    for buckets in (1000, 2000, 5000):
        counts = hashed_counts(counts, buckets, out=f"raw_{buckets}")
    return counts.select(
        "doc_id", *(bucket_total(f"raw_{n}").alias(f"total_{n}") for n in (1000, 2000, 5000))
    )


@query(
    "term_counts",
    f"""select doc_id, term, count(*) as tf
        from (select doc_id, unnest(tokens) as term from ({_tokens_sql()}) t) u
        group by doc_id, term""",
)
def counts_of_terms(spark, folder):
    size = file_bytes(spark, f"{folder}/documents.parquet")
    return term_counts(_tokens(spark, folder), "doc_id", size=size)


@query(
    "inverse_document_frequency",
    f"""select term, count(*) as df,
               round(ln(((select count(*) from documents where text is not null) + 1.0)
                        / (count(*) + 1)), 9) as idf
        from (select distinct doc_id, unnest(tokens) as term from ({_tokens_sql()}) t) u
        group by term""",
)
def idf_of_terms(spark, folder):
    idf = inverse_document_frequency(_tokens(spark, folder))
    return idf.withColumn("idf", F.round("idf", 9))


def _fitted(spark, folder, stages):
    return train(stages, training(spark, folder))


@query("class_predictions")
def class_predictions(spark, folder):
    model = _fitted(spark, folder, logistic())
    return predict_class(model, messages(spark, folder)).select("id", "is_toxic_pred")


@query("score_predictions")
def score_predictions(spark, folder):
    model = _fitted(spark, folder, forest())
    scores = predict_score(model, messages(spark, folder))
    return scores.select("id", "author_name", "toxicity_score", "is_toxic_pred")


@query(
    "score_agreement",
    """select doc_id as id, true as in_range, true as decided
       from documents where text is not null""",
)
def score_agreement(spark, folder):
    """Every document has one score from 0 to 1 and the decision that follows from it."""
    model = _fitted(spark, folder, forest())
    score = F.col("toxicity_score")
    return predict_score(model, messages(spark, folder)).select(
        "id",
        score.between(0, 1).alias("in_range"),
        (F.col("is_toxic_pred") == (score > 0.40).cast("double")).alias("decided"),
    )


@query(
    "reloaded_model_agreement",
    "select doc_id as id, true as agrees from documents where text is not null",
)
def reloaded_model_agreement(spark, folder):
    """A saved and loaded model predicts what the fitted one does, for every document."""
    model = _fitted(spark, folder, logistic())
    path = staging_path(spark, "model")
    save(model, path)
    first = predict_class(model, messages(spark, folder)).select(
        "id", F.col("is_toxic_pred").alias("fitted")
    )
    second = predict_class(load(path), messages(spark, folder)).select(
        "id", F.col("is_toxic_pred").alias("loaded")
    )
    agrees = (F.col("fitted") == F.col("loaded")).alias("agrees")
    return first.join(second, "id").select("id", agrees)


@query(
    "streamed_score_agreement",
    "select doc_id as id, true as agrees from documents where text is not null",
)
def streamed_score_agreement(spark, folder):
    """Scoring the documents as a stream gives the batch scores, for every document."""
    model = _fitted(spark, folder, logistic())
    stream = table_stream(spark, folder, "documents")
    scores = score_stream(model, stream.withColumnRenamed("doc_id", "id"))
    path = staging_path(spark, "stream-scores")
    run_available(scores.select("id", "is_toxic_pred"), f"{path}/rows", f"{path}/progress")
    streamed = spark.read.parquet(f"{path}/rows").withColumnRenamed("is_toxic_pred", "streamed")
    batch = predict_class(model, messages(spark, folder)).drop("text")
    agrees = (F.col("streamed") == F.col("is_toxic_pred")).alias("agrees")
    return batch.join(streamed, "id").select("id", agrees)


@query(
    "medallion_job",
    """with newest as (
           select conv_id, max(turn) as turn from conversations group by conv_id
       ), sizes as (
           select (select count(*) from documents) as posts, count(*) as comments,
                  count(*) filter (where date '2024-01-01' + cast(turn as integer)
                                         >= date '2024-01-12' - 7) as recent
           from newest
       )
       select 'clean' as stage, 'OK' as status, posts + comments as rows from sizes
       union all select 'replicate', 'OK', 3 * posts + 5 * comments from sizes
       union all select 'class_model', 'OK', 5 * comments from sizes
       union all select 'score_model', 'OK', comments from sizes
       union all select 'retain', 'OK', recent from sizes""",
)
def medallion_job(spark, folder):
    root = staging_path(spark, "medallion")
    known = f"{root}/training"
    append_training(labelled(spark, folder), known, "base")
    job = Medallion(spark, root, known, as_of="2024-01-12", prefix="job_")
    return job.run(raw_posts(spark, folder), raw_comments(spark, folder))


def _timed(times):
    """Times differ from run to run; the row counts do not."""
    rate = F.abs(F.col("rows_per_sec") * F.col("time_sec") - F.col("rows")) < 1e-6 * F.col("rows") + 1e-6
    return times.select("rows", (F.col("time_sec") > 0).alias("timed"), rate.alias("rated"))


@query(
    "training_times",
    "\nunion all\n".join(
        f"""select count(*) as rows, true as timed, true as rated from documents join labels using (doc_id)
            where {digest_in_sample_sql("doc_id", f)}"""
        for f in TRAINING_FRACTIONS
    ),
)
def times_of_training(spark, folder):
    return _timed(training_times(training(spark, folder), "doc_id"))


@query(
    "scoring_times",
    "\nunion all\n".join(
        f"""select count(*) * 2 * {tenths} // 10 as rows, true as timed, true as rated from documents"""
        for tenths in (2, 4, 6, 8, 10)
    ),
)
def times_of_scoring(spark, folder):
    """Scores the documents grown to twice their number."""
    path = staging_path(spark, "messages")
    write_parquet(messages(spark, folder), path)
    model = _fitted(spark, folder, logistic(2000))
    rows = 2 * table(spark, folder, "documents").count()
    return _timed(scoring_times(spark, model, path, rows))
