"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Only rows whose length is shared go on to the prefix, only rows whose length and prefix
are shared go on to the full hash, and the full text is read for those alone. Each step
counts narrow rows with a combine before the shuffle, so a group of any size costs each
task one row.

Defined results: a null text is the empty text; empty texts are equal to each other; of
equal texts the row with the largest id stays, and of repeated rows with that id one; a
null id is smaller than any other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import fold, keep_rows, same, text_of
from tallyloom.sources.stage import stage

PREFIX_CHARS = 128


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur in another row too."""
    counts = rows.groupBy(*keys).agg(F.sum("copies").alias("_n")).where(F.col("_n") > 1).select(*keys)
    return rows.join(counts, keys, "left_semi")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, text_hash.

    text_sha256 is the digest of the folded text. Without hash_all it is null for rows
    that an earlier step has shown to be alone. text_hash tells texts with one id apart.
    """
    texts = text_of(docs, id_col, text_col).select("doc_id", "text", fold(F.col("text")).alias("norm"))
    length, prefix = F.octet_length("norm"), F.xxhash64(F.substring("norm", 1, PREFIX_CHARS))
    digest = F.sha2("norm", 256)
    narrow = texts.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        length.alias("n"),
        prefix.alias("prefix"),
        (digest if hash_all else F.lit(None).cast("string")).alias("digest"),
    )
    rows = stage(
        narrow.groupBy("doc_id", "text_hash", "n", "prefix", "digest").agg(F.count(F.lit(1)).alias("copies"))
    )
    left = _shared(_shared(rows, ["n"]), ["n", "prefix"])
    if not hash_all:
        keys = left.select("n", "prefix").distinct()
        read = texts.withColumns({"n": length, "prefix": prefix}).join(keys, ["n", "prefix"], "left_semi")
        left = read.select("doc_id", F.xxhash64("text").alias("text_hash"), "n", "prefix", digest.alias("digest"))
        left = left.groupBy("doc_id", "text_hash", "n", "prefix", "digest").agg(F.count(F.lit(1)).alias("copies"))
    groups = (
        left.groupBy("n", "digest")
        .agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
        .where(F.col("group_size") > 1)
    )
    if hash_all:
        found = rows.join(groups, ["n", "digest"], "left")
    else:
        grouped = left.join(groups, ["n", "digest"]).select(
            F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
            F.col("digest").alias("_digest"), "keep_id", "group_size",
        )
        found = rows.join(grouped, same(rows, grouped, [("doc_id", "_id"), ("text_hash", "_hash")]), "left")
        found = found.withColumn("digest", F.col("_digest"))
    # two texts of one id may fold to the same: the larger text hash stays, then the first copy
    best = (
        found.where(F.col("group_size").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("n", "digest")
        .agg(F.max("text_hash").alias("_best"))
    )
    ties = found.join(best, ["n", "digest"], "left")
    alone = F.col("group_size").isNull()
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    return ties.select("*", copy).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (
            alone
            | (
                F.col("doc_id").eqNullSafe(F.col("keep_id"))
                & F.col("text_hash").eqNullSafe(F.col("_best"))
                & (F.col("_copy") == 1)
            )
        ).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "text_hash",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of equal texts, all columns as they were."""
    kept = exact_groups(docs, id_col, text_col).where("kept")
    return keep_rows(docs, kept.withColumn("one", F.col("group_size") > 1), id_col, text_col)
