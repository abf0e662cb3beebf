"""Sub-populations and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def present_in(users: DataFrame, log: DataFrame) -> DataFrame:
    """Users that occur in the log."""
    return users.join(log.select("uid").distinct(), "uid", "left_semi")


def absent_from(users: DataFrame, log: DataFrame) -> DataFrame:
    """Users that do not occur in the log."""
    return users.join(log.select("uid").distinct(), "uid", "left_anti")


def stratified_folds(rows: DataFrame, folds: int = 5, seed: int = 2019) -> DataFrame:
    """Assign folds so that every class is spread evenly: adds `fold`, 0 to folds-1.

    Within a class, rows are numbered in order of a hash of uid and seed. The first
    three hex digits of the hash cut every class into 4096 parts whose sizes give the
    start number of each part, so no task sorts a whole class.
    """
    mark = F.md5(F.concat_ws(":", F.col("uid").cast("string"), F.lit(str(seed))))
    rows = rows.withColumn("_mark", mark).withColumn("_part", F.substring("_mark", 1, 3))
    sizes = rows.groupBy("label", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("label").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("label", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("label", "_part").orderBy("_mark", "uid")
    # at most 4096 rows per class, so the broadcast has a fixed bound
    numbered = rows.withColumn("_row", F.row_number().over(inside)).join(F.broadcast(starts), ["label", "_part"])
    fold = F.pmod(F.col("_start") + F.col("_row") - 1, F.lit(folds)).cast("long")
    return numbered.withColumn("fold", fold).drop("_mark", "_part", "_row", "_start")
