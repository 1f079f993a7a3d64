"""Explicit schemas of every source and table."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
}


def _struct(columns: str) -> T.StructType:
    """`name type, ...` as a schema; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Both key spellings of the collector's files: (post_id, channel_id) and (id, chat_id).
RAW_POSTS = _struct(
    "post_id bigint, channel_id bigint, id bigint, chat_id bigint, date string, "
    "ts bigint, text string, views bigint, replies_count bigint"
)
RAW_COMMENTS = _struct(
    "comment_id bigint, id bigint, post_id bigint, channel_id bigint, chat_id bigint, "
    "text string, author_id bigint, author_name string, date string, ts bigint, "
    "reply_to_msg_id bigint, is_reply_to_user boolean"
)
# Raw files that held no whole JSON array.
QUARANTINE = _struct("file string, content string")
POSTS = _struct("id bigint, chat_id bigint, date string, text string, views bigint")
COMMENTS = _struct(
    "id bigint, post_id bigint, chat_id bigint, author_name string, date string, text string"
)
# `run` is null for rows that no job appended.
TRAINING = _struct("text string, is_destructive int, origin string, run string")
LEDGER = _struct("run string, origin string, rows bigint, committed string")
# What the incremental clean appends: every version of a message, marked and dated.
POST_VERSIONS = _struct(
    "id bigint, chat_id bigint, date string, text string, views bigint, ts bigint, "
    "version string, day string"
)
COMMENT_VERSIONS = _struct(
    "id bigint, post_id bigint, chat_id bigint, author_name string, date string, "
    "text string, ts bigint, version string, day string"
)
# The log of a state that is kept step by step.
EPOCHS = _struct("epoch bigint, bucket int, base boolean, rows bigint")
# Scored comment versions with what decides which of them is current.
SCORED_VERSIONS = _struct(
    "id bigint, post_id bigint, chat_id bigint, author_name string, date string, "
    "text string, ts bigint, version string, day string, is_toxic_pred int"
)
