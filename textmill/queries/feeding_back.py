"""Thresholds, samples and feedback on a given score column."""

from pyspark.sql import functions as F

from textmill.functions.scores import surely_safe, surely_toxic
from textmill.operators.feedback import (
    confident_conflicts,
    confident_feedback,
    confident_labels,
    new_texts,
    sampled_positives,
)
from textmill.operators.sample import TRAINING_FRACTIONS, sample_by_key, sample_sizes
from textmill.queries import query
from textmill.queries.inputs import SCORED_SQL, digest_in_sample_sql, labelled, scored, table
from textmill.session import stage, staging_path
from textmill.sinks.files import append_training
from textmill.sinks.ledger import append_once, read_training

_CONTENT = "lower(trim(original_content)) <> 'nan' and length(trim(original_content)) > 1"
_TOXIC = "toxicity_score > cast(0.85 as double)"
_SAFE = "toxicity_score < cast(1.0 as double) - cast(0.85 as double)"
_CANDIDATES = f"""
    select distinct text, is_destructive from (
        select original_content as text, 1 as is_destructive from ({SCORED_SQL}) p
        where {_CONTENT} and {_TOXIC}
        union all
        select original_content as text, 0 as is_destructive from ({SCORED_SQL}) p
        where {_CONTENT} and {_SAFE}) c"""
_KNOWN = "select d.text from documents d join labels l using (doc_id)"


@query("decisions", f"select id, toxicity_score, is_toxic_pred from ({SCORED_SQL}) p")
def decisions(spark, folder):
    return scored(spark, folder).select("id", "toxicity_score", "is_toxic_pred")


@query("confident_labels", _CANDIDATES)
def labels_of_confident(spark, folder):
    return confident_labels(scored(spark, folder))


@query(
    "confident_conflicts",
    f"""select count(*) as conflicts from (
            select text from ({_CANDIDATES}) c group by text having count(*) = 2) t""",
)
def conflicts_of_confident(spark, folder):
    return confident_conflicts(scored(spark, folder))


@query(
    "confident_feedback",
    f"""select c.text, c.is_destructive from ({_CANDIDATES}) c
        where not exists (select 1 from ({_KNOWN}) k where k.text = c.text)""",
)
def feedback_of_confident(spark, folder):
    known = stage(labelled(spark, folder).select("text"), "labelled")  # a join, and read twice
    return confident_feedback(scored(spark, folder), known)


@query(
    "new_texts",
    f"""select d.doc_id, d.text from documents d
        where not exists (select 1 from ({_KNOWN}) k where k.text = d.text)""",
)
def texts_not_trained_on(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    known = stage(labelled(spark, folder).select("text"), "labelled")  # a join, and read twice
    return new_texts(documents, known)


@query(
    "sampled_feedback",
    f"""select original_content as text, 1 as is_destructive from ({SCORED_SQL}) p
        where is_toxic_pred = 1 and {digest_in_sample_sql("id", 0.1)}""",
)
def feedback_of_sampled(spark, folder):
    predictions = scored(spark, folder).withColumnRenamed("original_content", "text")
    return sampled_positives(predictions)


@query(
    "repeated_feedback",
    f"""select original_content as text, 1 as is_destructive, 'logistic' as origin, run from ({SCORED_SQL}) p,
               (values ('first'), ('second')) r(run)
        where is_toxic_pred = 1 and {digest_in_sample_sql("id", 0.1)}""",
)
def feedback_of_repeated_runs(spark, folder):
    """Of two runs, one stopped half-way and was made again, twice: every run's rows count once."""
    path = staging_path(spark, "training")
    append_training(labelled(spark, folder), path, "base")
    fed = sampled_positives(scored(spark, folder).withColumnRenamed("original_content", "text"))
    marked = fed.select("text", "is_destructive", F.lit("logistic").alias("origin"), F.lit("first").alias("run"))
    marked.filter(F.crc32(F.col("text").cast("binary")) % 3 == 0).write.mode("append").parquet(path)
    for run in ("first", "first", "second"):
        append_once(fed, path, "logistic", run)
    return read_training(spark, path).filter(F.col("origin") == "logistic")


@query(
    "key_sample",
    f"select doc_id, lang from documents where {digest_in_sample_sql('doc_id', 0.3)}",
)
def key_sample(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    return sample_by_key(documents, "doc_id", 0.3)


@query(
    "nested_sample_sizes",
    "\nunion all\n".join(
        f"""select cast({f} as double) as fraction,
                   count(*) filter (where {digest_in_sample_sql("doc_id", f)}) as rows
            from documents"""
        for f in TRAINING_FRACTIONS
    ),
)
def nested_sample_sizes(spark, folder):
    return sample_sizes(table(spark, folder, "documents").select("doc_id"), "doc_id")


@query(
    "thresholds",
    f"""select id, case when {_TOXIC} then 'toxic' when {_SAFE} then 'safe'
                        else 'unsure' end as certainty
        from ({SCORED_SQL}) p""",
)
def thresholds(spark, folder):
    score = F.col("toxicity_score")
    certainty = (
        F.when(surely_toxic(score), "toxic").when(surely_safe(score), "safe").otherwise("unsure")
    )
    return scored(spark, folder).select("id", certainty.alias("certainty"))
