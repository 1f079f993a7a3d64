"""License notices in text blocks, with DataFrame functions only.

Base labels come from fixed phrases. The method's labels come from an exact
set-similarity join of blocks (lines) with templates: a block meets a template
if it holds at least `THRESHOLD` of the template's distinct words. Words are
ordered by their frequency in all blocks, rarest first. For an overlap of n
words, a template's first |T| - n + 1 words and a block's first |B| - n + 1 must
have one in common (prefix filter), the block needs n words (length filter), and
after the words in common there must be enough left on both sides (positional
filter). What passes is counted in full, so no match is lost. A block is reduced
to the templates' words first, as no other word can count.

Templates are a parameter; their words are the only thing every task gets.

Defined cases: null and empty texts have no word and no label; phrases may span
lines, blocks don't; equal words count once in a block; rows that repeat are
scanned each; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.session import stage

THRESHOLD = 0.8

# The contract's phrases.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Usual notices of common licenses, one block each.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "copyright all rights reserved"),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def needed(size: int, threshold: float = THRESHOLD) -> int:
    """The overlap that a template of so many distinct words asks for."""
    return math.ceil(round(threshold * size, 9))


def _words_before(text: F.Column) -> F.Column:
    """How many words a prefix of a normalised text holds."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _scan(df: DataFrame, id_col: str, text: str, vocabulary: list[str], least: int) -> DataFrame:
    """A row a document: words, places of phrases, and blocks of `least` template words or more."""
    low = df.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
        F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase).alias("_low"),
    )
    normal = low.withColumn("_norm", F.trim(F.regexp_replace("_low", SEPARATORS, " ")))
    # " a b c ": a phrase stands where it is found with a space at both ends.
    spaced = normal.withColumn("_norm", F.when(F.col("_norm") == "", "").otherwise(F.concat(F.lit(" "), "_norm", F.lit(" "))))
    found = spaced
    firsts, lasts, counts, labels = [], [], [], []
    for number, (phrase, label) in enumerate(PHRASES.items()):
        has = F.contains("_norm", F.lit(f" {phrase} "))
        start = F.substring_index("_norm", f" {phrase} ", 1)
        end = F.substring_index("_norm", f" {phrase} ", -1)
        words = phrase.count(" ") + 1
        found = found.withColumns({
            f"_n{number}": F.when(has, F.regexp_count("_norm", F.lit(f" {phrase}(?= )"))).otherwise(0),
            f"_f{number}": F.when(has, _words_before(start)),
            # What follows the last place ends with a space that no word follows.
            f"_l{number}": F.when(
                has, F.size(F.split("_norm", " ")) - 2 - words - _words_before(end)
            ),
        })
        counts.append(F.col(f"_n{number}"))
        firsts.append(F.col(f"_f{number}"))
        lasts.append(F.col(f"_l{number}"))
        labels.append(F.when(F.col(f"_n{number}") > 0, F.lit(label)))
    known = F.array(*[F.lit(w) for w in vocabulary])
    blocks = F.filter(
        F.transform(F.split("_low", "\n"), lambda line: F.array_intersect(F.split(line, SEPARATORS), known)),
        lambda block: F.size(block) >= least,
    )
    return found.select(
        "_row", "_id",
        F.when(F.col("_norm") == "", 0).otherwise(F.size(F.split("_norm", " ")) - 2).cast("bigint").alias("n_words"),
        sum(counts).cast("bigint").alias("n_base"),
        F.least(*firsts).cast("bigint").alias("first_word"),
        F.greatest(*lasts).cast("bigint").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"),
        blocks.alias("blocks"),
    )


def template_matches(blocks: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """`_row, block, template, label, share`: every block that holds enough of a template.

    `blocks` has _row, block and its distinct words `tokens`.
    """
    spark = blocks.sparkSession
    counts = blocks.select(F.explode("tokens").alias("word")).groupBy("word").count()
    # As many rows as the templates have words.
    order = {r["word"]: (r["count"], r["word"]) for r in counts.collect()}
    sets = [sorted(set(text.split()), key=lambda w: order.get(w, (0, w))) for _, text in templates]
    ranks = {w: i for i, w in enumerate(sorted({w for s in sets for w in s}, key=lambda w: order.get(w, (0, w))))}
    prefixes = [
        (number, label, ranks[word], place, len(words), needed(len(words), threshold), [ranks[w] for w in words])
        for number, ((label, _), words) in enumerate(zip(templates, sets))
        for place, word in enumerate(words[: len(words) - needed(len(words), threshold) + 1])
    ]
    wanted = spark.createDataFrame(
        prefixes, "template int, label string, rank int, place int, size int, least int, ranks array<int>"
    )
    rank_of = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    ordered = blocks.withColumn("mine", F.array_sort(F.transform("tokens", lambda w: rank_of[w]))).drop("tokens")
    placed = ordered.select("_row", "block", "mine", F.posexplode("mine").alias("at", "rank"))
    length = F.size("mine")
    passed = placed.join(F.broadcast(wanted), "rank").filter(
        (length >= F.col("least"))
        & (F.col("at") <= length - F.col("least"))
        & (1 + F.least(F.col("size") - F.col("place") - 1, length - F.col("at") - 1) >= F.col("least"))
    )
    common = F.size(F.array_intersect("mine", "ranks"))
    return (
        passed.filter(common >= F.col("least"))
        .select("_row", "block", "template", "label", (common / F.col("size")).alias("share"))
        .distinct()
    )


def scan(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The id with n_words, n_base, first_word, last_word, base_labels, labels, score and n_blocks."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    least = min(needed(len(set(t.split())), threshold) for _, t in templates)
    docs = stage(_scan(df, id_col, text, vocabulary, least), "license-blocks")
    blocks = docs.select("_row", F.posexplode("blocks").alias("block", "tokens"))
    met = template_matches(blocks, templates, threshold).groupBy("_row").agg(
        F.collect_set("label").alias("met"),
        F.max("share").alias("share"),
        F.count_distinct("block").alias("n_blocks"),
    )
    none = F.array().cast("array<string>")
    joined = docs.drop("blocks").join(met, "_row", "left")
    return joined.select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("met", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("bigint").alias("n_blocks"),
    )


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same rows from every pair of line and template, in DuckDB."""
    low = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    words = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    places = " || ".join(
        "list_transform(list_filter(range(1, len(w) + 1), lambda i: "
        + " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split()))
        + f"), lambda i: {{'at': i - 1, 'label': '{label}'}})"
        for phrase, label in PHRASES.items()
    )
    rows = ", ".join(
        f"('{label}', {sorted(set(t.split()))!r}, {needed(len(set(t.split())), threshold)})" for label, t in templates
    )
    return f"""
        with d as (select row_number() over () as r, doc_id, {low} as low from documents),
        p as (select r, doc_id, low, w, {places} as found from (select *, {words.format("low")} as w from d)),
        t(label, ts, least) as (values {rows}),
        l as (select r, unnest(string_split(low, chr(10))) as line from d),
        b as (select r, row_number() over () as block, list_distinct({words.format("line")}) as ws from l),
        m as (select r, block, label, len(list_intersect(ws, ts)) / len(ts) as share from b, t
              where len(list_intersect(ws, ts)) >= least),
        g as (select r, list(distinct label) as met, max(share) as share, count(distinct block) as n from m group by r)
        select p.doc_id, len(w) as n_words, len(found) as n_base,
               list_min(list_transform(found, lambda x: x.at)) as first_word,
               list_max(list_transform(found, lambda x: x.at)) as last_word,
               coalesce(array_to_string(list_sort(list_distinct(list_transform(found, lambda x: x.label))), ','), '')
                 as base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_transform(found, lambda x: x.label)
                 || coalesce(met, []))), ','), '') as labels,
               cast(case when len(found) > 0 then 1 else coalesce(share, 0) end as double) as score,
               coalesce(n, 0) as n_blocks
        from p left join g using (r)"""
