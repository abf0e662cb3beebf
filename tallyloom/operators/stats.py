"""Six-statistic profiles, global ranks and bins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import equal_width, floor_guarded, round_even
from tallyloom.operators.hot import grouped_with_medians, lookup_parts, running_total
from tallyloom.sources.stage import stage

STATS = ("mean", "min", "max", "median", "std", "var")


def mean_of(column: str) -> Column:
    """Mean as sum over count: exact for whole numbers and decimals."""
    return F.sum(column).cast("double") / F.count(column)


def six_stats(
    df: DataFrame,
    group: list[str],
    columns: dict[str, str],
    *,
    mean_squared: bool = False,
    sized_by: DataFrame | None = None,
    bounded: bool = False,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """mean, min, max, median, std and var of columns per group, as <prefix>_<statistic>.

    std and var are sample statistics and null for one row. `columns` maps a column to
    its prefix. All groups and columns are served by one aggregate. `enrich` attaches
    the columns to the rows of `df`, if it does not have them. `dealt` rows lie in
    buckets of the group.
    """
    measures = []
    for c, prefix in columns.items():
        measures += [
            mean_of(c).alias(f"{prefix}_mean"),
            F.min(c).cast("double").alias(f"{prefix}_min"),
            F.max(c).cast("double").alias(f"{prefix}_max"),
            F.stddev_samp(F.col(c).cast("double")).alias(f"{prefix}_std"),
            F.var_samp(F.col(c).cast("double")).alias(f"{prefix}_var"),
        ]
    medians = {c: f"{prefix}_median" for c, prefix in columns.items()}
    out = grouped_with_medians(df, group, measures, medians, sized_by, bounded, enrich, dealt)
    names = [f"{p}_{s}" for p in columns.values() for s in STATS]
    out = out.select(*group, *names)
    if mean_squared:
        squares = [(F.col(f"{p}_mean") * F.col(f"{p}_mean")).alias(f"{p}_mean_sq") for p in columns.values()]
        out = out.select("*", *squares)
    return out


def round_stats(df: DataFrame, prefix: str, digits: int, var_digits: int | None = None) -> DataFrame:
    """Round the statistics of one prefix."""
    var_digits = digits if var_digits is None else var_digits
    names = [c for c in df.columns if c in {f"{prefix}_{s}" for s in (*STATS, "mean_sq")}]
    return df.withColumns(
        {c: round_even(F.col(c), var_digits if c.endswith("_var") else digits) for c in names}
    )


def floor_stats(df: DataFrame, prefix: str) -> DataFrame:
    """Floor the statistics of one prefix."""
    names = [c for c in df.columns if c in {f"{prefix}_{s}" for s in STATS}]
    return df.withColumns({c: floor_guarded(F.col(c)) for c in names})


def equal_width_bins(df: DataFrame, bins: dict[str, tuple[str, int]]) -> DataFrame:
    """Add equal-width bins: {new column: (column, number of bins)}.

    The table is read twice, for the maxima and for the bins, so it is staged. All
    maxima come from one scalar subquery.
    """
    df = stage(df)
    columns = sorted({c for c, _ in bins.values()})
    largest = df.agg(F.struct(*[F.max(c).alias(c) for c in columns]).alias("m")).scalar()
    df = df.withColumn("_largest", largest)
    added = {
        name: equal_width(F.col(c), F.col("_largest").getField(c), count) for name, (c, count) in bins.items()
    }
    return df.withColumns(added).drop("_largest")


def dense_codes(values: DataFrame, group: list[str], column: str, name: str, start: int = 1) -> DataFrame:
    """Number the distinct non-null values of a column in sort order within a group.

    No task sorts more than one slice of the values.
    """
    distinct = values.select(*group, column).where(F.col(column).isNotNull()).distinct()
    coded = running_total(distinct, group, [F.col(column)], F.lit(1).cast("long"), name)
    return coded.withColumn(name, F.col(name) + F.lit(start - 1))


def with_codes(df: DataFrame, columns: dict[str, str], start: int) -> DataFrame:
    """Add the codes of the distinct values of several columns: {column: code column}.

    Columns of one type are numbered together in one pass.
    """
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = df
    for same in by_type.values():
        pairs = F.array(*[F.struct(F.lit(c).alias("attr"), F.col(c).alias("value")) for c in same])
        codes = stage(dense_codes(df.select(F.inline(pairs)), ["attr"], "value", "code", start), "attr")
        joins = {}
        for c in same:
            part = codes.where(F.col("attr") == c)
            joins[c] = (c, part.select(F.col("value").alias(c), F.col("code").alias(columns[c])))
        out = lookup_parts(out, joins)
    return out


def global_dense_rank(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add ascending 1-based dense ranks over the whole table: {column: rank column}."""
    return with_codes(stage(df), columns, start=1)
