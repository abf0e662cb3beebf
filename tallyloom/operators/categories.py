"""Installed apps and app categories per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.arrays import split_list
from tallyloom.operators.clean import fill_category
from tallyloom.operators.hot import lookup_join
from tallyloom.operators.ranking import unique_categories


def explode_installed(lists: DataFrame, mark: str = "#") -> DataFrame:
    """One row per user and installed app; empty entries are left out."""
    return lists.select("uid", F.explode(split_list(F.col("apps"), mark)).alias("app")).where(F.col("app") != "")


def install_ratio(pairs: DataFrame) -> DataFrame:
    """Distinct apps per user and their share of all distinct apps."""
    everything = pairs.agg(F.count_distinct("app")).scalar()
    out = pairs.groupBy("uid").agg(F.count_distinct("app").alias("apps"))
    return out.withColumn("ratio", F.col("apps") / everything)


def with_category(pairs: DataFrame, categories: DataFrame, order: str | None = None) -> DataFrame:
    """Attach the category of each app; apps without one are `unknown`."""
    return fill_category(lookup_join(pairs, unique_categories(categories, order), "app"))


def category_nunique(apps: DataFrame) -> DataFrame:
    return apps.groupBy("uid").agg(F.count_distinct("category").alias("categories"))


def category_counts(apps: DataFrame, values: list) -> DataFrame:
    """Number of apps per category as columns `n_<category>`, 0 where there are none."""
    cells = [F.count_if(F.col("category") == v).alias(f"n_{v}") for v in values]
    return apps.groupBy("uid").agg(*cells)


def category_shares(counts: DataFrame, values: list) -> DataFrame:
    """Share of each category among the listed ones; 0 where a user has none of them."""
    total = sum((F.col(f"n_{v}") for v in values[1:]), F.col(f"n_{values[0]}"))
    counts = counts.withColumn("n_listed", total)
    return counts.withColumns(
        {f"share_{v}": F.coalesce(F.try_divide(F.col(f"n_{v}"), F.col("n_listed")), F.lit(0.0)) for v in values}
    )


def category_usage(apps: DataFrame, values: list) -> DataFrame:
    """Apps, duration and times per category as columns, 0 where there are none."""
    cells = []
    for v in values:
        here = F.col("category") == v
        cells.append(F.count_if(here).alias(f"apps_{v}"))
        for m in ("duration", "times"):
            value = F.sum(F.when(here, F.col(m)))
            cells.append(F.coalesce(value, F.lit(0)).cast("double").alias(f"{m}_{v}"))
    return apps.groupBy("uid").agg(*cells)
