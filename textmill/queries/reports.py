"""Word reports, class counts and stop lists."""

from pyspark.sql import functions as F

from textmill.functions.stopwords import REPORT_STOP_WORDS
from textmill.functions.text import ANY_SCRIPT, letter_words, one_line, stripped_words
from textmill.operators.classify import class_counts
from textmill.operators.dedup import first_per_text
from textmill.operators.words import (
    count_words,
    flagged,
    frequent_letter_runs,
    frequent_lower_pieces,
    frequent_pieces,
    frequent_stripped,
    top_words,
)
from textmill.queries import query
from textmill.queries.inputs import SCORED_SQL, scored, table
from textmill.sources.tables import local_rows

# The report's own list is Russian; the given texts are not, so the checks add
# words that do occur in them.
STOP_WORDS = [*REPORT_STOP_WORDS, "that", "with", "this", "dans", "pour", "nicht", "auch", "para"]
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
_NON_LETTERS = "[^а-яА-Яa-zA-Z]"


def _top_sql(words: str, where: str, k: int) -> str:
    return f"""
        select word, count(*) as "count" from ({words}) w
        where {where}
        group by word order by "count" desc, word limit {k}"""


_FLAGGED_SQL = f"(select original_content as text from ({SCORED_SQL}) p where is_toxic_pred = 1)"


@query(
    "top_pieces",
    _top_sql(
        f"select unnest(string_split(text, ' ')) as word from {_FLAGGED_SQL} t",
        "length(word) > 4",
        10,
    ),
)
def top_pieces(spark, folder):
    return frequent_pieces(flagged(scored(spark, folder)), "original_content")


@query(
    "top_lower_pieces",
    _top_sql(
        f"select unnest(string_split(lower(text), ' ')) as word from {_FLAGGED_SQL} t",
        f"length(word) > 3 and word not in ({_STOP_SQL})",
        10,
    ),
)
def top_lower_pieces(spark, folder):
    return frequent_lower_pieces(flagged(scored(spark, folder)), "original_content", STOP_WORDS)


@query(
    "top_letter_runs",
    _top_sql(
        f"""select unnest(regexp_split_to_array(lower(text), '{_NON_LETTERS}+')) as word
            from {_FLAGGED_SQL} t""",
        "length(word) > 2",
        300,
    ),
)
def top_letter_runs(spark, folder):
    return frequent_letter_runs(flagged(scored(spark, folder)), "original_content")


@query(
    "top_any_script_runs",
    _top_sql(
        r"select unnest(regexp_split_to_array(lower(text), '\P{L}+')) as word from documents",
        "length(word) > 2",
        300,
    ),
)
def top_any_script_runs(spark, folder):
    counts = count_words(
        table(spark, folder, "documents"), "text", lambda t: letter_words(t, ANY_SCRIPT), 2
    )
    return top_words(counts, 300)


@query(
    "top_stripped_words",
    _top_sql(
        f"""select lower(regexp_replace(piece, '{_NON_LETTERS}', '', 'g')) as word
            from (select unnest(string_split(text, ' ')) as piece from {_FLAGGED_SQL} t) s""",
        f"length(word) > 3 and word not in ({_STOP_SQL})",
        15,
    ),
)
def top_stripped_words(spark, folder):
    return frequent_stripped(flagged(scored(spark, folder)), "original_content", STOP_WORDS)


@query(
    "toxic_word_report",
    _top_sql(
        rf"""select lower(regexp_replace(piece, '{_NON_LETTERS}', '', 'g')) as word
             from (
                 select unnest(string_split(text, ' ')) as piece
                 from (
                     select doc_id, trim(regexp_replace(text, '[\n\r]', ' ', 'g')) as text,
                            row_number() over (
                                partition by trim(regexp_replace(text, '[\n\r]', ' ', 'g'))
                                order by doc_id) as rn
                     from documents) d
                 join labels l using (doc_id)
                 where rn = 1 and l.toxic = 1) s""",
        f"length(word) > 3 and word not in ({_STOP_SQL})",
        15,
    ),
)
def toxic_word_report(spark, folder):
    """Normalise, keep the first of equal texts, keep toxic ones, count words."""
    documents = table(spark, folder, "documents").select(
        "doc_id", one_line(F.col("text")).alias("text")
    )
    toxic = table(spark, folder, "labels").filter("toxic = 1").select("doc_id")
    firsts = first_per_text(documents, "text", ("doc_id",))
    return frequent_stripped(firsts.join(toxic, "doc_id", "left_semi"), "text", STOP_WORDS)


@query(
    "word_counts",
    """select word, count(*) as "count"
       from (select unnest(string_split(text, ' ')) as word from documents) w group by word""",
)
def word_counts(spark, folder):
    return count_words(table(spark, folder, "documents"), "text")


@query(
    "word_counts_without_list",
    f"""select word, count(*) as "count"
        from (select lower(regexp_replace(piece, '{_NON_LETTERS}', '', 'g')) as word
              from (select unnest(string_split(text, ' ')) as piece from documents) p) w
        where length(word) > 3 and word not in ({_STOP_SQL}) group by word""",
)
def word_counts_without_list(spark, folder):
    """The stop list as a small cached frame of local rows, anti-joined to the counts."""
    stop = local_rows(spark, [(w,) for w in STOP_WORDS], "word string").cache()
    return count_words(table(spark, folder, "documents"), "text", stripped_words, 3, stop)


@query(
    "class_counts",
    f"""select is_toxic_pred, count(*) as "count" from ({SCORED_SQL}) p group by is_toxic_pred""",
)
def counts_by_class(spark, folder):
    return class_counts(scored(spark, folder))


@query(
    "label_counts",
    """select toxic, count(*) as "count" from labels group by toxic""",
)
def counts_by_label(spark, folder):
    return class_counts(table(spark, folder, "labels"), "toxic")
