"""The driver tables in the roles of the raw tables.

Labels are the market segments; accounts in debt stand for users without a label.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.hot import spread, tasks_for
from tallyloom.sources.stage import stage, stage_by_key

# The market segments; a label is the 1-based position.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CLASSES = [1, 2, 3, 4, 5]
# The order priorities and part types.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
COUNTERS = ["a_times", "b_times", "c_times", "d_times", "e_times", "f_times"]
ATTRIBUTES = [
    "model",
    "city",
    "colour",
    "font_size",
    "rom_capacity",
    "ram_capacity",
    "os",
    "boot_times",
    *COUNTERS,
    "f_sum",
]
CROSSES = {
    "model_colour_font": ["model", "colour", "font_size"],
    "memory_storage_system": ["ram_capacity", "rom_capacity", "os"],
    "all_six": ["model", "colour", "font_size", "ram_capacity", "rom_capacity", "os"],
}


class Roles:
    """Role tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._kept: dict[str, DataFrame] = {}

    def kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table that one query reads several times, staged on first use."""
        if name not in self._kept:
            self._kept[name] = stage(build())
        return self._kept[name]

    def kept_by_user(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The same in buckets of users, as many as the lines of the log need: work per user needs no exchange."""
        if name not in self._kept:
            buckets = tasks_for(self.spark, self.table("lineitem").count())
            self._kept[name] = stage_by_key(build(), "uid", buckets)
        return self._kept[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def users(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("uid"))

    def labelled(self) -> DataFrame:
        label = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment"))
        customers = self.table("customer").where(F.col("c_acctbal") >= 0)
        return customers.select(F.col("c_custkey").alias("uid"), label.cast("long").alias("label"))

    def unlabelled(self) -> DataFrame:
        return self.table("customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("uid"))

    def usage(self) -> DataFrame:
        """Usage log from orders and their lines: (uid, app, duration, times, use_date)."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("uid"),
            F.col("l_partkey").alias("app"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("duration"),
            F.col("l_quantity").cast("long").alias("times"),
            F.col("o_orderdate").cast("date").alias("use_date"),
        )

    def spread_usage(self, *keys: str) -> DataFrame:
        """The usage log dealt by some of its columns over as many tasks as its lines need."""
        return spread(self.usage(), list(keys), self.table("lineitem").count())

    def month_log(self) -> DataFrame:
        """30-day usage log from the events, one row per (uid, app, use_date)."""
        events = self.table("events").select(
            F.col("user_id").alias("uid"),
            F.get_json_object("props", "$.k").alias("app"),
            F.col("ts").cast("date").alias("use_date"),
            F.col("value").cast("decimal(12,2)").alias("value"),
        )
        return events.groupBy("uid", "app", "use_date").agg(
            F.sum("value").alias("duration"), F.count(F.lit(1)).alias("times")
        )

    def categories(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("app"), F.col("p_type").alias("category"))

    def name_categories(self) -> DataFrame:
        """Categories of part names; a name has several, and `place` tells which comes first."""
        return self.table("part").select(
            F.col("p_name").alias("app"), F.col("p_type").alias("category"), F.col("p_partkey").alias("place")
        )

    def installed(self) -> DataFrame:
        """Distinct (uid, app) pairs of customers and part names."""
        names = self.table("part").select(F.col("p_partkey").alias("part"), F.col("p_name").alias("name"))
        pairs = self.usage().select("uid", "app").distinct()
        return pairs.join(names, F.col("app") == F.col("part")).select("uid", F.col("name").alias("app")).distinct()

    def pairs(self) -> DataFrame:
        """Distinct (uid, app) pairs of the usage log, staged."""
        return self.kept("pairs", lambda: self.usage().select("uid", "app").distinct())

    def installed_pairs(self) -> DataFrame:
        """The installed apps, staged."""
        return self.kept("installed", self.installed)

    def raw_lists(self) -> DataFrame:
        """The raw lists of installed apps, staged."""
        return self.kept("lists", self.installed_lists)

    def installed_lists(self) -> DataFrame:
        """The raw form of the installed apps: one row per user, ids joined by #.

        A list has at most one entry per part name, of which there are 64 at every scale.
        """
        return self.lists_of(self.installed())

    @staticmethod
    def lists_of(pairs: DataFrame) -> DataFrame:
        """The lists of distinct pairs (uid, app)."""
        return pairs.groupBy("uid").agg(F.concat_ws("#", F.array_sort(F.collect_list("app"))).alias("apps"))

    def attributes(self) -> DataFrame:
        """Device attributes and behaviour counters of every user.

        A user without orders has counters of 0 and no device attributes but the city and gender.
        """
        orders = self.table("orders")
        per_user = orders.groupBy(F.col("o_custkey").alias("uid")).agg(
            F.max_by("o_orderpriority", "o_orderkey").alias("model"),
            F.min_by("o_orderstatus", "o_orderkey").alias("colour"),
            F.min_by("o_orderpriority", "o_orderkey").alias("network"),
            F.max_by("o_orderstatus", "o_orderkey").alias("carrier"),
            F.month(F.min("o_orderdate")).cast("long").alias("font_size"),
            F.month(F.max("o_orderdate")).cast("long").alias("ram_capacity"),
            F.year(F.max("o_orderdate")).cast("long").alias("rom_capacity"),
            F.year(F.min("o_orderdate")).cast("long").alias("os"),
            F.count(F.lit(1)).alias("boot_times"),
            *[F.count_if(F.col("o_orderpriority") == p).alias(c) for c, p in zip(COUNTERS, PRIORITIES)],
            F.count_if(F.col("o_orderstatus") == "F").alias("f_times"),
            (F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double") / 250000.0).alias("traffic"),
        )
        customers = self.table("customer").select(
            F.col("c_custkey").alias("uid"),
            F.col("c_nationkey").cast("string").alias("city"),
            F.when(F.col("c_acctbal") >= 5000, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("gender"),
        )
        joined = customers.join(per_user, "uid", "left").withColumn("f_sum", F.floor("traffic").cast("long"))
        return joined.na.fill(0, ["boot_times", *COUNTERS, "f_sum"]).drop("traffic")

    def labelled_attributes(self) -> DataFrame:
        return self.attributes().join(self.labelled(), "uid")

    def texts(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("doc"), "text")

    def vectors(self) -> DataFrame:
        """Feature vectors with 0-based labels."""
        return self.table("embeddings").select(
            F.col("vec_id").cast("long").alias("uid"),
            F.col("label").cast("double").alias("label"),
            array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        )
