"""From documents to token ids: quality, exact copies, near copies, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes to the
shared folder and reads again as the docs of the next. The first four return rows of
documents with all their columns, from the first on without the common lines of their
hosts; the last returns counts and digests of ids and of the bytes decoded from them. There
is no SQL for the whole: SQL cannot say the encoding.

Defined results: a row without text or with too few words goes in the first stage; texts of
any length pass whole; of repeated rows and copies one row stays; the mix may write it up to
three times; ties are broken as the operators say; columns of any name come through
unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import byte_bpe, exact_dedup, jaccard_join, mixing, quality_rules
from tallyloom.sources.stage import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.cleaned(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("weighted_mix", mixed),
    ("byte_bpe", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
