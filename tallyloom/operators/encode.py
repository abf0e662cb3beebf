"""Codes, flags and scales."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.hot import lookup_join
from tallyloom.operators.stats import dense_codes, with_codes


def ordinal_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add <column>_code: the 0-based position of the value among the sorted distinct values."""
    return with_codes(df, {c: f"{c}_code" for c in columns}, start=0)


def one_hot(df: DataFrame, values: dict[str, list]) -> DataFrame:
    """Add <column>_<value> flags for the listed values; a null gives only zeros."""
    flags = {}
    for c, known in values.items():
        for v in known:
            flags[f"{c}_{v}"] = F.when(F.col(c) == v, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return df.withColumns(flags)


def one_hot_selected(df: DataFrame, column: str, selected: DataFrame) -> DataFrame:
    """Add <column>_slot: the 1-based slot of a selected value, 0 for all other values.

    A slot is a sparse one-hot row; `assemble.slot_vector` makes the vector of it.
    """
    slots = dense_codes(selected, [], column, f"{column}_slot")
    return lookup_join(df, slots, column).na.fill(0, [f"{column}_slot"])


def minmax_scale(df: DataFrame, columns: list[str], fit: DataFrame | None = None) -> DataFrame:
    """(x - min) / (max - min) with the range of `fit`; columns with one value become 0."""
    source = df if fit is None else fit
    ranges = source.agg(
        F.struct(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).alias("r")
    )
    df = df.withColumn("_range", ranges.scalar())
    scaled = {}
    for c in columns:
        lo, hi = F.col("_range").getField(f"lo_{c}"), F.col("_range").getField(f"hi_{c}")
        scaled[c] = F.when(hi == lo, F.lit(0.0)).otherwise(F.try_divide(F.col(c).cast("double") - lo, hi - lo))
    return df.withColumns(scaled).drop("_range")
