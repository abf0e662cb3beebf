"""Plans that stay balanced when one group or key holds a large share of the rows.

Grouped sums, counts, extremes and variances need nothing from here: Spark combines
them before the shuffle. Ordered work does (ranks, running totals, medians, fills),
and so do lookups on a popular key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import GROUP_ROWS, KEY_LIST, TASK_ROWS, limit
from tallyloom.sources.stage import stage


def tasks_for(spark: SparkSession, size: int, per_task: int | None = None) -> int:
    """As many tasks as a table of that size needs, and no fewer than a shuffle has anyway."""
    per_task = per_task or limit(spark, TASK_ROWS)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // per_task))


def spread(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """A table of at most `rows` rows dealt by its keys over as many tasks as it needs.

    A table that the usual number of tasks can take stays as it is, for Spark to deal.
    """
    n = tasks_for(df.sparkSession, rows)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys) if n > usual else df


def _counted_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the groups that hold more rows than one task should."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > limit(df.sparkSession, GROUP_ROWS)).select(*keys)


def _listed(keys: DataFrame) -> tuple[DataFrame | None, bool]:
    """A short list of keys as a literal table, else None, and whether the list is too long for that."""
    most = limit(keys.sparkSession, KEY_LIST)
    found = keys.limit(most + 1).collect()
    if len(found) > most:
        return None, True
    return (keys.sparkSession.createDataFrame(found, keys.schema) if found else None), False


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys of the groups that hold more rows than one task should, or None if there are none."""
    big = _counted_keys(df, keys)
    short, long = _listed(big)
    if long:
        return stage(big)
    return None if short is None else F.broadcast(short)


def split_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary groups and rows of hot groups; a null key is a group too."""
    return _on_group(df, hot, keys, "left_anti"), _on_group(df, hot, keys, "left_semi")


def _on_group(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join in which null equals null; columns of the other table keep their names but for the keys."""
    renamed = other.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    matched = F.lit(True)
    for k in keys:
        matched = matched & df[k].eqNullSafe(renamed[f"_key_{k}"])
    return df.join(renamed, matched, how).drop(*[f"_key_{k}" for k in keys])


def _sliced(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The rows range-partitioned by group and order, with a fixed slice number."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(c) for c in group], *order)
    return stage(ranged.withColumn("_slice", F.spark_partition_id()))


def running_total(df: DataFrame, group: list[str], order: list[Column], weight: Column, name: str) -> DataFrame:
    """Exact running sum of a weight in each group, with large groups cut into slices.

    The order must tell all rows of a group apart; a null group is a group of its own.
    Only the first group of a slice can continue an earlier slice, so the table of
    carried sums never has more rows than there are slices.
    """
    sliced = _sliced(df, group, order)
    totals = sliced.groupBy(*group, "_slice").agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        totals.withColumn("_carried", F.sum("_total").over(earlier))
        .where(F.col("_carried").isNotNull())
        .select(*group, "_slice", "_carried")
    )
    inside = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        _on_group(sliced, F.broadcast(carried), [*group, "_slice"], "left")
        .withColumn(name, F.sum(weight).over(inside) + F.coalesce(F.col("_carried"), F.lit(0)))
        .drop("_slice", "_carried")
    )


def rank_in_group(
    df: DataFrame, group: list[str], order: list[Column], name: str, sized_by: DataFrame | None = None
) -> DataFrame:
    """1-based row number in each group. `sized_by` is a cheaper table to find hot groups in."""
    hot = hot_keys(df if sized_by is None else sized_by, group)
    window = Window.partitionBy(*group).orderBy(*order)
    if hot is None:
        return df.withColumn(name, F.row_number().over(window).cast("long"))
    light, heavy = split_hot(df, group, hot)
    light = light.withColumn(name, F.row_number().over(window).cast("long"))
    heavy = running_total(heavy, group, order, F.lit(1).cast("long"), name)
    return light.unionByName(heavy.select(*light.columns))


def last_known(
    df: DataFrame, group: list[str], order: list[Column], column: str, name: str, sized_by: DataFrame | None = None
) -> DataFrame:
    """Fill nulls of a column with the last value before them in the group."""
    hot = hot_keys(df if sized_by is None else sized_by, group)
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.last(column, ignorenulls=True)
    if hot is None:
        return df.withColumn(name, filled.over(window))
    light, heavy = split_hot(df, group, hot)
    sliced = _sliced(heavy, group, order)
    inside = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = sliced.where(F.col(column).isNotNull()).groupBy(*group, "_slice").agg(
        F.max_by(column, F.struct(*order)).alias("_end")
    )
    slices = _on_group(sliced.select(*group, "_slice").distinct(), ends, [*group, "_slice"], "left")
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    heavy = (
        _on_group(sliced, F.broadcast(carried.where(F.col("_carried").isNotNull())), [*group, "_slice"], "left")
        .withColumn(name, F.coalesce(filled.over(inside), F.col("_carried")))
        .drop("_slice", "_carried")
    )
    light = light.withColumn(name, filled.over(window))
    return light.unionByName(heavy.select(*light.columns))


def _sliced_medians(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Exact medians of hot groups: a histogram, its running count, then the middle values."""
    named = F.array(*[F.struct(F.lit(c).alias("_stat"), F.col(c).cast("double").alias("_value")) for c in columns])
    long = df.select(*group, F.inline(named)).where(F.col("_value").isNotNull())
    key = [*group, "_stat"]
    histogram = long.groupBy(*key, "_value").agg(F.count(F.lit(1)).alias("_n"))
    counted = running_total(histogram, key, [F.col("_value")], F.col("_n"), "_upto")
    sizes = counted.groupBy(*key).agg(F.max("_upto").alias("_size"))
    lower, upper = F.floor((F.col("_size") + 1) / 2), F.floor((F.col("_size") + 2) / 2)

    def holds(position: Column) -> Column:
        return (position <= F.col("_upto")) & (position > F.col("_upto") - F.col("_n"))

    middle = (
        counted.join(sizes, key)
        .where(holds(lower) | holds(upper))
        .groupBy(*key)
        .agg(((F.min("_value") + F.max("_value")) / 2).alias("_median"))
    )
    return middle.groupBy(*group).agg(
        *[F.max(F.when(F.col("_stat") == c, F.col("_median"))).alias(f"_median_{c}") for c in columns]
    )


def grouped_with_medians(
    df: DataFrame,
    group: list[str],
    measures: list[Column],
    medians: dict[str, str],
    sized_by: DataFrame | None = None,
    bounded: bool = False,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """One grouped aggregate with exact medians: {column: output name}.

    `bounded` says that the group size has a natural bound (days of a calendar), so no
    search for hot groups is needed. `enrich` attaches columns to the rows. `dealt` says
    that the rows lie in buckets of the group and that `enrich` leaves them there.

    Half-built medians are larger than the rows they come from, so ordinary groups are
    shuffled as rows, and the aggregate then needs no exchange of its own. The columns are
    attached before: a join with a table too large for a broadcast moves the rows.
    """
    enrich = enrich or (lambda rows: rows)
    middles = [F.median(c).alias(name) for c, name in medians.items()]

    def grouped(rows: DataFrame) -> DataFrame:
        rows = enrich(rows) if dealt else enrich(rows).repartition(*group)
        return rows.groupBy(*group).agg(*measures, *middles)

    hot = None if bounded else hot_keys(df if sized_by is None else sized_by, group)
    if hot is None:
        return grouped(df)
    light, heavy = split_hot(df, group, hot)
    light = grouped(light)
    heavy = enrich(heavy)
    found = _sliced_medians(heavy, group, list(medians))
    heavy = heavy.groupBy(*group).agg(*measures).join(found, group, "left")
    for c, name in medians.items():
        heavy = heavy.withColumnRenamed(f"_median_{c}", name)
    return light.unionByName(heavy.select(*light.columns))


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: str | list[str], how: str = "left") -> DataFrame:
    """Join facts to a table with one row per key.

    Nothing is hinted: adaptive execution knows the true sizes, broadcasts a small lookup
    and splits the hot keys of the facts otherwise.
    """
    return facts.join(lookup, keys, how)


def lookup_parts(facts: DataFrame, joins: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Several lookups one after the other: {name: (key, lookup)}."""
    out = facts
    for key, lookup in joins.values():
        out = lookup_join(out, lookup, key)
    return out
