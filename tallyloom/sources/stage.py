"""Tables written once to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallyloom.session import shared_folder


def stage_path(spark, name: str = "stage") -> str:
    """A path in the shared folder that no other table uses."""
    return f"{shared_folder(spark)}/tallyloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This fixes partition numbers and row contents for plans that use a table twice,
    cuts the lineage, and gives Catalyst the true size of the table.
    """
    path = stage_path(df.sparkSession)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_in_pieces(df: DataFrame, rows: int) -> DataFrame:
    """The same in files of at most that many rows.

    Tasks that read them hold a bounded part of the table, also if it came in one large
    row group, which Spark cannot split.
    """
    path = stage_path(df.sparkSession, "pieces")
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, key: str = "uid", buckets: int | None = None) -> DataFrame:
    """Write a table to the shared folder in buckets of a key, sorted by it.

    Joins of such tables on the key need no exchange, however many there are: each is
    shuffled once, when it is written. The table has a name of its own in the session
    catalogue; `drop_staged` takes it out again.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tallyloom_{uuid.uuid4().hex}"
    rows = df.repartition(n, key)
    rows.write.bucketBy(n, key).sortBy(key).option("path", stage_path(spark, "buckets")).saveAsTable(name)
    return spark.table(name)


def drop_staged(spark) -> None:
    """Take the names of bucketed tables out of the session catalogue; their files stay until the folder is removed."""
    for table in spark.catalog.listTables():
        if table.name.startswith("tallyloom_") and not table.isTemporary:
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
