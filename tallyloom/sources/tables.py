"""Readers and writers of tables, feature blocks and scores."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.arrays import parse_list_text


def read_csv(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """CSV with declared column types; a headerless file takes its names from the schema."""
    return spark.read.schema(schema).option("header", header).option("enforceSchema", not header).csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def append_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("append").option("header", header).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_block(df: DataFrame, path: str) -> None:
    """Feature vectors (uid, features, population, split), one folder per population and split."""
    df.write.mode("overwrite").partitionBy("population", "split").parquet(path)


def read_block(spark: SparkSession, path: str, population: str, split: str, uid: str = "bigint") -> DataFrame:
    """One part of a feature block; the other folders are not read."""
    uid_type = T.LongType() if uid == "bigint" else T.IntegerType()
    schema = T.StructType(
        [
            T.StructField("uid", uid_type),
            T.StructField("features", VectorUDT()),
            T.StructField("population", T.StringType()),
            T.StructField("split", T.StringType()),
        ]
    )
    block = spark.read.schema(schema).parquet(path)
    return block.where((F.col("population") == population) & (F.col("split") == split)).select("uid", "features")


def read_list_text(df: DataFrame, column: str) -> DataFrame:
    """Turn list text such as ['a', 'b'] into an array column."""
    return df.withColumn(column, parse_list_text(F.col(column)))


def read_scores(spark: SparkSession, path: str, classes: int, uid: str = "bigint") -> DataFrame:
    """Class scores of one model, CSV with columns 0, 1, ... after a key column that may lack a name.

    Returns (uid, scores).
    """
    cells = ", ".join(f"`{k}` double" for k in range(classes))
    df = spark.read.schema(f"uid {uid}, {cells}").option("header", True).option("enforceSchema", True).csv(path)
    return df.select("uid", F.array(*[F.col(f"`{k}`") for k in range(classes)]).alias("scores"))


def write_scores(df: DataFrame, path: str, classes: int, key: str = "uid") -> None:
    """Scores as CSV with one column per class."""
    cells = [F.col("scores").getItem(k).alias(str(k)) for k in range(classes)]
    write_csv(df.select(F.col("uid").alias(key), *cells), path)


def write_fold_scores(accuracy: DataFrame, path: str) -> None:
    write_csv(accuracy, path)
