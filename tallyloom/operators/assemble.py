"""Wide tables and feature vectors, always joined on uid."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.stage import stage_path


def assemble(base: DataFrame, blocks: list[DataFrame], how: str = "left", fill: bool = True) -> DataFrame:
    """Join blocks with one row per user to the base; missing numbers become 0."""
    out = base
    for block in blocks:
        clash = (set(out.columns) & set(block.columns)) - {"uid"}
        if clash:
            raise ValueError(f"two blocks share the columns {sorted(clash)}")
        out = out.join(block, "uid", how)
    return out.na.fill(0) if fill else out


def to_vector(df: DataFrame, columns: list[str], name: str = "features", keep: tuple[str, ...] = ()) -> DataFrame:
    """Numeric and vector columns as one vector, stored sparse where that is smaller."""
    assembler = VectorAssembler(inputCols=columns, outputCol=name)
    return assembler.transform(df).select("uid", *keep, name)


def vector_size(df: DataFrame, column: str) -> int:
    """Length of the vectors of a column, from its metadata or else from its first vector."""
    known = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    if known is not None:
        return int(known)
    first = df.where(F.col(column).isNotNull()).select(column).first()
    return first[column].size if first else 0


def zeros(size: int) -> Column:
    """A vector of zeros."""
    return array_to_vector(F.array_repeat(F.lit(0.0), size))


def hstack(blocks: dict[str, DataFrame], name: str = "features", users: DataFrame | None = None) -> DataFrame:
    """Vectors of several blocks side by side: {vector column name: block with uid and that column}.

    Every user of `users` gets a row, or without it every user of any block. A block that
    lacks a user gives zeros. The schema says how long the vectors are and nothing of their
    slots: a description of each slot, with thousands of them, would lie on the driver in
    every plan over the table. Blocks are merged, never broadcast: their files say little of
    the room that their vectors take.
    """
    if users is None:
        users = reduce(DataFrame.union, [b.select("uid") for b in blocks.values()])
    joined, width = users.select("uid").distinct(), 0
    for column, block in blocks.items():
        size = vector_size(block, column)
        width += size
        joined = joined.join(block.select("uid", column).hint("merge"), "uid", "left")
        joined = joined.withColumn(column, F.coalesce(F.col(column), zeros(size)))
    stacked = to_vector(joined, list(blocks), name)
    return stacked.select("uid", F.col(name).alias(name, metadata={"ml_attr": {"num_attrs": width}}))


def _stored_sparse(df: DataFrame, size: int, slots: Column, values: Column, name: str) -> DataFrame:
    """(uid, vector) from ascending slots and their values.

    The vector is written in its storage form and read back as a vector, so no Python
    code sees the rows and no row is ever as long as the vector.
    """
    kind, length = F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size")
    stored = F.struct(kind, length, slots.alias("indices"), values.alias("values"))
    df = df.select("uid", stored.alias(name))
    path = stage_path(df.sparkSession, "block")
    df.write.parquet(path)
    known = {"ml_attr": {"num_attrs": size}}
    schema = T.StructType([df.schema["uid"], T.StructField(name, VectorUDT(), metadata=known)])
    return df.sparkSession.read.schema(schema).parquet(path)


def slot_vector(df: DataFrame, column: str, size: int, name: str) -> DataFrame:
    """(uid, vector) with a 1 in the 1-based slot that a column names; slot 0 gives zeros.

    The vectors are sparse: of thousands of slots one is taken.
    """
    taken = F.col(column).between(1, size)
    slots = F.when(taken, F.array(F.col(column).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    values = F.when(taken, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>"))
    return _stored_sparse(df, size, slots, values, name)


def sparse_block(rows: DataFrame, users: DataFrame, size: int, name: str = "features") -> DataFrame:
    """Rows (uid, slot, value) as one sparse vector of a given size per user.

    A user without rows gets a vector of zeros; a slot out of range is an error.
    """
    wrong = F.raise_error(F.concat(F.lit(f"not a slot below {size}: "), F.col("slot").cast("string"))).cast("int")
    slot = F.when((F.col("slot") >= 0) & (F.col("slot") < size), F.col("slot").cast("int")).otherwise(wrong)
    cell = F.struct(slot.alias("slot"), F.col("value").cast("double").alias("value"))
    lists = rows.groupBy("uid").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    empty = F.array().cast("array<struct<slot:int,value:double>>")
    cells = F.coalesce(F.col("cells"), empty)
    df = users.select("uid").join(lists, "uid", "left")
    return _stored_sparse(df, size, cells.getField("slot"), cells.getField("value"), name)


def vector_rows(df: DataFrame, name: str = "features") -> DataFrame:
    """Non-zero entries of a vector column as rows (uid, slot, value)."""
    values = df.select("uid", F.posexplode(vector_to_array(name)).alias("slot", "value"))
    return values.where(F.col("value") != 0).withColumn("slot", F.col("slot").cast("long"))


def slice_vector(df: DataFrame, indices: list[int], name: str = "features", out: str = "selected") -> DataFrame:
    return VectorSlicer(inputCol=name, outputCol=out, indices=indices).transform(df)


def score_cells(model: str, classes: int, scores: Column) -> list[Column]:
    return [scores.getItem(k).alias(f"{model}_{k}") for k in range(classes)]


def meta_features(scores: DataFrame, models: list[str], classes: int) -> DataFrame:
    """Scores (uid, model, scores) of several models as columns <model>_<class>, null where absent."""
    cells = []
    for m in models:
        here = F.max(F.when(F.col("model") == m, F.col("scores")))
        cells += score_cells(m, classes, here)
    return scores.where(F.col("model").isin(models)).groupBy("uid").agg(*cells)


def meta_for_all(users: DataFrame, meta: DataFrame) -> DataFrame:
    """Meta features of every user, 0 for models that did not score the user."""
    return assemble(users.select("uid"), [meta])


def meta_for_scored(users: DataFrame, meta: DataFrame) -> DataFrame:
    """Meta features of the users that every model has scored."""
    return users.select("uid").join(meta.na.drop("any"), "uid")
