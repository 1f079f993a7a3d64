"""Features, classifiers, feedback, jobs and streams."""

import json
import os
from pathlib import Path

import pytest
from conftest import final_plan, plan
from pyspark.sql import functions as F

from textmill.functions.scores import decision, surely_safe, surely_toxic
from textmill.operators.classify import (
    fitted,
    class_counts,
    forest,
    load,
    logistic,
    predict_class,
    predict_score,
    save,
    train,
)
from textmill.operators.clean import clean_posts
from textmill.operators.dedup import latest_by_key
from textmill.operators.features import (
    COUNTED_BYTES,
    bucket_total,
    hashed_counts,
    inverse_document_frequency,
    remove_stop_words,
    term_counts,
    tokenize,
)
from textmill.operators.feedback import (
    confident_conflicts,
    confident_feedback,
    confident_labels,
    new_texts,
    sampled_positives,
)
from textmill.operators.membership import maybe_known, sketch, without_known
from textmill.plans.medallion import Medallion
from textmill.plans.scalability import scoring_times, training_times
from textmill.session import shared_root
from textmill.schemas import RAW_COMMENTS, RAW_POSTS
from textmill.sinks.files import append_training
from textmill.sources.json_files import read_json_arrays
from textmill.streaming.incremental import (
    append_new,
    clean_stream,
    new_files,
    new_json_arrays,
    run_available,
    score_stream,
)

SCORED = "original_content string, toxicity_score double"


@pytest.fixture(scope="module")
def training(spark):
    data = [(i, f"you are trash number {i}", 1.0) for i in range(20)]
    data += [(100 + i, f"what a lovely day number {i}", 0.0) for i in range(40)]
    return spark.createDataFrame(data, "id bigint, text string, label double").cache()


@pytest.fixture(scope="module")
def model(training):
    return train(logistic(), training.select("text", "label"))


def messages(spark):
    data = [(1, "ann", "you trash"), (2, None, "a lovely day"), (3, "bob", None), (4, "bob", "")]
    return spark.createDataFrame(data, "id bigint, author_name string, text string")


# --- thresholds and feedback -------------------------------------------------


def test_thresholds_are_strict_in_double(rows):
    df = rows([(0.40,), (0.41,), (0.85,), (0.86,), (0.15,), (0.14,)], "s double").select(
        decision(F.col("s")), surely_toxic(F.col("s")), surely_safe(F.col("s"))
    )
    assert [tuple(r) for r in df.collect()] == [
        (0.0, False, False),
        (1.0, False, False),
        (1.0, False, False),
        (1.0, True, False),
        (0.0, False, True),  # 1 - 0.85 lies just above 0.15
        (0.0, False, True),
    ]


def test_confident_feedback(rows):
    scored = rows(
        [
            ("rude", 0.95), ("rude", 0.99), ("kind", 0.05), ("both", 0.95), ("both", 0.05),
            ("known", 0.9), ("unsure", 0.5), ("NaN", 0.9), ("x", 0.9), (None, 0.9), ("edge", 0.85),
        ],
        SCORED,
    )
    known = rows([("known",), ("known",), (None,)], "text string")
    expected = [("both", 0), ("both", 1), ("kind", 0), ("rude", 1)]
    assert sorted(map(tuple, confident_feedback(scored, known).collect())) == expected
    labels = sorted(map(tuple, confident_labels(scored).collect()))
    assert labels == sorted([*expected, ("known", 1)])
    assert confident_conflicts(scored).first().conflicts == 1
    # Running it again on the enlarged training set adds nothing.
    enlarged = known.union(confident_feedback(scored, known).select("text"))
    assert confident_feedback(scored, enlarged).count() == 0


def test_surely_new_candidates_do_not_move(rows, spark):
    """Most candidates skip the join, and nothing is sorted by text before its digest."""
    candidates = spark.range(20000).select("id", F.concat(F.lit("text "), F.col("id")).alias("text"))
    known = spark.range(19900, 40000).select(F.concat(F.lit("text "), F.col("id")).alias("text"))
    marked = maybe_known(candidates, "text", sketch(known, "text"))
    assert marked.filter("id >= 19900 and not _maybe").count() == 0
    moved = marked.filter("_maybe").count()
    assert 100 <= moved < 110  # a bit in 6,700 is set
    few = maybe_known(candidates, "text", sketch(known, "text", 1), 1).filter("_maybe").count()
    assert 6000 < few < 12000 and sketch(known, "text", 1).count() == 1
    for bitmaps in (1, 4096):
        fresh = without_known(candidates, known, bitmaps=bitmaps)
        assert fresh.count() == 19900 and fresh.agg(F.max("id")).first()[0] == 19899
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(without_known(candidates, known))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin [_text_digest" in text and "Sort [text" not in text


def test_new_texts_splits_a_hot_text(spark, rows):
    candidates = spark.range(0, 60000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("text")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert new_texts(candidates, rows([("other",), ("other",)], "text string")).count() == 60000
        # The hot text may be known, and so is a candidate of the join.
        near = candidates.filter("id % 6 = 1").select("text").union(rows([("hot",)], "text string"))
        fresh = new_texts(candidates, near)
        text = final_plan(fresh)
        assert fresh.count() == 30000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in text


def test_null_texts_are_new(rows):
    candidates = rows([("a",), (None,)], "text string")
    assert new_texts(candidates, rows([("a",), (None,)], "text string")).count() == 1


def test_sampled_positives(spark):
    df = spark.range(10000).select(
        "id", F.lit("t").alias("text"), (F.col("id") % 2).cast("int").alias("is_toxic_pred")
    )
    fed = sampled_positives(df)
    assert fed.columns == ["text", "is_destructive"]
    assert 400 < fed.count() < 600 and fed.count() == sampled_positives(df).count()


# --- features ------------------------------------------------------------------


def test_term_features(rows):
    df = tokenize(rows([(1, "The cat the CAT sat"), (2, "a cat"), (3, None)], "id int, text string"))
    tf = {(r.id, r.term): r.tf for r in term_counts(df, "id").collect()}
    assert tf[1, "the"] == 2 and tf[1, "cat"] == 2 and tf[2, "cat"] == 1
    idf = {r.term: (r.df, round(r.idf, 6)) for r in inverse_document_frequency(df).collect()}
    assert idf["cat"] == (2, 0.0) and idf["sat"] == (1, 0.405465)
    again = inverse_document_frequency(df, rows=2)
    assert {r.term: (r.df, round(r.idf, 6)) for r in again.collect()} == idf
    kept = remove_stop_words(df, ["the", "a"])
    assert [r.filtered for r in kept.orderBy("id").collect()] == [["cat", "cat", "sat"], ["cat"]]
    hashed = hashed_counts(df, 5000).select(bucket_total("raw").alias("n"), F.size("words").alias("m"))
    assert all(r.n == r.m for r in hashed.collect())


def test_tasks_that_count_terms_follow_the_input(rows):
    df = rows([(i, ["a", "b", "a"]) for i in range(50)], "id bigint, words array<string>")
    counts = term_counts(df, "id", size=40 * COUNTED_BYTES - 1)
    assert counts.rdd.getNumPartitions() == 40
    assert counts.filter("tf = 2 and term = 'a' or tf = 1 and term = 'b'").count() == 100


def test_hashed_idf_uses_the_same_formula(rows):
    from pyspark.ml.feature import IDF

    df = hashed_counts(tokenize(rows([("a b",), ("a",), ("a c",)], "text string")), 5000)
    weights = set(IDF(inputCol="raw", outputCol="f").fit(df).idf.toArray().round(9))
    exact = {round(r.idf, 9) for r in inverse_document_frequency(df).collect()}
    assert exact <= weights


# --- classifiers ---------------------------------------------------------------


def test_logistic(spark, training, model, tmp_path):
    fitted = predict_class(model, training)
    right = fitted.join(training, "id").filter("is_toxic_pred = label").count()
    assert right >= 40  # at least the majority class
    scored = predict_class(model, messages(spark))
    assert scored.dtypes == [("id", "bigint"), ("text", "string"), ("is_toxic_pred", "int")]
    found = {r.id: r.is_toxic_pred for r in scored.collect()}
    assert set(found) == {1, 2, 4} and found[1] == 1 and found[2] == 0
    save(model, str(tmp_path / "m"))
    save(model, str(tmp_path / "m"))
    again = {r.id: r.is_toxic_pred for r in predict_class(load(str(tmp_path / "m")), messages(spark)).collect()}
    assert again == found


def test_forest_scores(spark, training):
    fitted = train(forest(features=500, trees=5, depth=4), training.select("text", "label"))
    scored = predict_score(fitted, messages(spark))
    assert scored.columns == [
        "id", "author_name", "original_content", "toxicity_score", "is_toxic_pred",
    ]
    found = scored.collect()
    assert {r.id for r in found} == {1, 2, 4}
    for r in found:
        assert 0.0 <= r.toxicity_score <= 1.0
        assert r.is_toxic_pred == (1.0 if r.toxicity_score > 0.40 else 0.0)
    assert sum(r["count"] for r in class_counts(scored).collect()) == 3
    assert "Python" not in plan(scored)


def test_a_forest_depends_on_the_rows_alone(spark):
    """Equal trees from the same rows in other files and another order, a hot row among them."""
    data = [(f"w{i % 37} x{i % 11} y{i % 5} {'bad' if i % 3 else 'fine'}", float(i % 3 > 0)) for i in range(900)]
    data += [("the same words", 1.0)] * 2500
    one = spark.createDataFrame(data, "text string, label double").repartition(7)
    other = spark.createDataFrame(data[::-1], "text string, label double").coalesce(1).orderBy("text").repartition(3)
    trees = [train(forest(features=200, trees=4, depth=4), df).stages[-1].toDebugString for df in (one, other)]
    assert trees[0].split("\n")[1:] == trees[1].split("\n")[1:] and "If (feature" in trees[0]


def test_training_rows_are_laid_out_evenly(spark):
    from textmill.operators.classify import prepared

    data = [(f"text {i}", 0.0) for i in range(5000)] + [("hot", 1.0)] * 5000 + [(None, 0.0)] * 10
    with prepared(spark.createDataFrame(data, "text string, label double")) as rows:
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        counts = {(r.text, r.label): r["count"] for r in rows.groupBy("text", "label").count().collect()}
    assert counts["hot", 1.0] == 5000 and counts[None, 0.0] == 10 and sum(counts.values()) == 10010
    assert max(sizes) < 3000  # at most a few runs of the hot row in a part


@pytest.mark.parametrize("kind", [logistic, forest])
def test_fitted_in_one_pass_over_the_texts(spark, kind):
    """The same model as the pipeline's own fit; the texts are read by one job only."""
    data = [(("The good Day " if i % 3 else "i BAD и Day ") * (i % 4 + 1), float(i % 3 == 0)) for i in range(60)]
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    rows = spark.createDataFrame(data, "text string, label double").repartition(2).cache()
    stages = kind(50)
    own, once = stages.fit(rows), fitted(stages, rows.withColumn("text", counted("text")))
    assert reads.value == len(data)
    assert own.stages[-1].numFeatures == once.stages[-1].numFeatures
    scores = [[(r.label, r.text, r.probability.toArray().tolist()) for r in m.transform(rows).collect()] for m in (own, once)]
    assert scores[0] == scores[1]


def test_training_on_nothing_is_an_error(training):
    with pytest.raises(ValueError):
        train(logistic(), training.filter("false").select("text", "label"))


def test_scalability_reports(spark, training, model, tmp_path):
    times = training_times(training, "id", (0.5, 1.0)).collect()
    assert [r.rows for r in times][1] == 60 and times[0].rows < 60
    messages(spark).write.parquet(str(tmp_path / "m"))
    scored = scoring_times(spark, model, str(tmp_path / "m"), 50, fractions=(0.2, 1.0))
    assert [r.rows for r in scored.collect()] == [10, 50]


# --- jobs ------------------------------------------------------------------------


def raw_tables(spark):
    posts = spark.createDataFrame(
        [(1, -5, None, None, "2024-01-01", 1, "a\nb", 1, 0), (2, -5, None, None, "2024-01-02", 1, "c", 1, 0)],
        RAW_POSTS,
    )
    comments = spark.createDataFrame(
        [
            (i, None, 1, -5, None, "you are trash" if i % 2 else "lovely day", 1, "ann",
             f"2024-01-{1 + i % 20:02d}", 1, 0, False)
            for i in range(40)
        ],
        RAW_COMMENTS,
    )
    return posts, comments


def base_training(training, path):
    append_training(training.select("text", F.col("label").cast("int").alias("is_destructive")), path, "base")


def test_a_scored_part_has_work_for_all_cores(spark, model, tmp_path):
    path = str(tmp_path / "messages")
    spark.range(1000).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")).coalesce(1).write.parquet(path)
    before = set(Path(shared_root(spark), "textmill").glob("scoring-*"))
    assert scoring_times(spark, model, path, 2000, fractions=(0.2,)).first().rows == 400
    (grown,) = set(Path(shared_root(spark), "textmill").glob("scoring-*")) - before
    assert len(list(grown.glob("*.parquet"))) > spark.sparkContext.defaultParallelism / 0.2


def test_medallion(spark, training, tmp_path):
    root = str(tmp_path)
    base_training(training, f"{root}/training")
    job = Medallion(spark, root, f"{root}/training", "2024-01-20", prefix="m_")
    report = [tuple(r) for r in job.run(*raw_tables(spark)).collect()]
    assert report == [
        ("clean", "OK", 42),
        ("replicate", "OK", 206),
        ("class_model", "OK", 200),
        ("score_model", "OK", 40),
        ("retain", "OK", 16),
    ]
    assert spark.table("m_gold_toxic_predictions").columns == ["id", "text", "is_toxic_pred"]
    origins = {r.origin for r in spark.read.parquet(f"{root}/training").select("origin").distinct().collect()}
    assert {"base", "logistic"} <= origins


def test_medallion_gates(spark, training, tmp_path):
    root = str(tmp_path)
    posts, comments = raw_tables(spark)
    untrained = Medallion(spark, root, f"{root}/none", "2024-01-20", prefix="g_")
    status = {r.stage: r.status.split(":")[0] for r in untrained.run(posts, comments).collect()}
    assert status == {
        "clean": "OK", "replicate": "OK", "class_model": "FAILED", "score_model": "FAILED",
        "retain": "OK",
    }
    unclean = Medallion(spark, root, f"{root}/none", "2024-01-20", prefix="u_")
    status = {r.stage: r.status.split(":")[0] for r in unclean.run(posts.drop("text"), comments).collect()}
    assert status == {
        "clean": "FAILED", "replicate": "SKIPPED", "class_model": "SKIPPED",
        "score_model": "SKIPPED", "retain": "SKIPPED",
    }


# --- streams -----------------------------------------------------------------------


def write_raw(folder, name, *posts):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(list(posts), indent=2))


def raw_post(number, text, views=1, ts=1704067200, date="2024-01-01"):
    return {"channel_id": -5, "post_id": number, "date": date, "ts": ts, "text": text, "views": views}


def test_stream_takes_new_files_only_and_drops_repeats(spark, tmp_path):
    raw, out, progress = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "progress")

    def cycle():
        stream = new_json_arrays(spark, str(raw), RAW_POSTS)
        cleaned = clean_stream(stream).select("channel_id", "post_id", "text", "date")
        append_new(cleaned, out, progress, ["channel_id", "post_id"], "date")
        return sorted((r.post_id, r.text) for r in spark.read.parquet(out).collect())

    write_raw(raw / "date=2024-01-01", "a.json", raw_post(1, " a\nb "), raw_post(1, "a\nb"))
    assert cycle() == [(1, "a b")]
    write_raw(raw / "date=2024-01-01", "b.json", raw_post(1, "a\nb"), raw_post(2, "c"))
    assert cycle() == [(1, "a b"), (2, "c")]
    assert cycle() == [(1, "a b"), (2, "c")]


def test_stream_of_versions_equals_the_batch_result(spark, tmp_path):
    """Keeping every version in the stream and the newest on reading is the batch clean."""
    raw, out, progress = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "progress")
    for i in range(4):
        write_raw(
            raw / f"date=2024-01-0{i + 1}", "a.json",
            *(raw_post(n, f"text {n}", views=10 * i + n) for n in range(i, 6)),
        )
        stream = new_json_arrays(spark, str(raw), RAW_POSTS)
        append_new(clean_stream(stream), out, progress, ["channel_id", "post_id", "ts", "views"], "date")
    versions = spark.read.schema(RAW_POSTS).parquet(out)
    keys = ("channel_id", "post_id")
    newest = latest_by_key(versions, keys, ("ts", "views")).select("post_id", "text", "views")
    batch = clean_posts(read_json_arrays(spark, str(raw), RAW_POSTS)).select("id", "text", "views")
    assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, batch.collect()))


@pytest.mark.parametrize("files", ["1", "1000"])
def test_stream_keeps_old_messages_whatever_the_steps(spark, tmp_path, files):
    """Newest first, one file a step: nothing counts as late, and repeats go, null days too."""
    raw, out, progress = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "progress")
    for i in range(4):
        days = [f"2024-01-{28 - 7 * i - k:02d}" for k in range(7)] + [None]
        rows = [raw_post(7 * i + k, "x", date=d) for k, d in enumerate(days)]
        write_raw(raw, f"{i}.json", *rows, *rows[:2])
        os.utime(raw / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = new_json_arrays(spark, str(raw), RAW_POSTS, maxFilesPerTrigger=files)
    append_new(clean_stream(stream), out, progress, ["post_id"], "date")
    stored = spark.read.schema(RAW_POSTS).parquet(out)
    assert stored.count() == 32 and stored.select("post_id", "date").distinct().count() == 32


def test_a_step_that_runs_again_adds_nothing(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    write_raw(raw, "a.json", raw_post(1, "a"), raw_post(2, "b", date=None))
    for progress in ("p1", "p2"):  # a lost checkpoint takes all files again
        stream = new_json_arrays(spark, str(raw), RAW_POSTS)
        append_new(clean_stream(stream), out, str(tmp_path / progress), ["post_id"], "date")
    assert spark.read.schema(RAW_POSTS).parquet(out).count() == 2


def test_a_step_writes_a_file_a_day(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    rows = [raw_post(i, "x", date=f"2024-01-{i % 30 + 1:02d}") for i in range(600)]
    write_raw(raw, "a.json", *rows)
    append_new(clean_stream(new_json_arrays(spark, str(raw), RAW_POSTS)), str(out), str(tmp_path / "p"), ["post_id"], "date")
    assert len(list(out.rglob("*.parquet"))) == 30


def test_stream_scores_equal_batch_scores(spark, model, tmp_path):
    raw, out, progress = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "progress")
    messages(spark).write.parquet(raw)
    scores = score_stream(model, new_files(spark, raw, messages(spark).schema))
    run_available(scores, out, progress)
    streamed = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert streamed == sorted(map(tuple, predict_class(model, messages(spark)).collect()))
    assert len(streamed) == 3


def test_final_plan_of_scores_has_no_python(spark, model):
    assert "Python" not in final_plan(predict_class(model, messages(spark)))
