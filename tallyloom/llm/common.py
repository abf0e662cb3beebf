"""Column helpers that the text operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def text_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(doc_id, text, more ...) of a table with any other columns; a null text counts as empty."""
    return docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
        *[docs[c].alias(c) for c in more],
    )


def fold(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the fast path; both give the same there."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    """Number of words: pieces between runs of blanks, without the empty ones at the ends."""
    trimmed = F.btrim(text, F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANKS))).cast("long")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also inside lambda functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality of column pairs in which null equals null."""
    out = F.lit(True)
    for a, b in pairs:
        out = out & left[a].eqNullSafe(right[b])
    return out


def carried(docs: DataFrame, text_col: str, **keys: str) -> DataFrame:
    """(row, text_hash, key ...): each row of docs as one struct, so that its columns meet no others.

    `keys` are the columns to join by, under names of their own.
    """
    return docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(F.coalesce(docs[f"`{text_col}`"], F.lit(""))).alias("text_hash"),
        *[docs[f"`{c}`"].alias(name) for name, c in keys.items()],
    )


def keep_rows(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they were, that the decisions (doc_id, text_hash) name.

    If the decisions have a column `one`, repeated rows give one row where it is true.
    """
    one = F.col("one") if "one" in decisions.columns else F.lit(False)
    named = decisions.groupBy(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).agg(
        F.bool_or(one).alias("one")
    )
    rows = carried(docs, text_col, doc_id=id_col)
    joined = rows.join(named, same(rows, named, [("doc_id", "kept_id"), ("text_hash", "kept_hash")]))
    if "one" in decisions.columns:
        single = joined.where("one").dropDuplicates(["kept_id", "kept_hash"])
        joined = joined.where("not one").unionByName(single)
    return joined.select("row.*")
