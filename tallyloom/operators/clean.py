"""Cleaning of attribute and counter tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.numeric import clamp_low, finite_or_zero
from tallyloom.operators.hot import last_known

# (type, lowest, highest) from narrow to wide
WHOLE_TYPES = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31))
FLOAT_LARGEST = 3.4028234663852886e38


def clamp_negative(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: clamp_low(F.col(c), 0).cast(df.schema[c].dataType) for c in columns})


def modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent non-null value of each column, the lowest one on ties.

    Values are counted as rows, so no task holds the domain of a column. One row per
    column reaches the driver.
    """
    found: dict[str, object] = {}
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for same in by_type.values():
        pairs = F.array(*[F.struct(F.lit(c).alias("attr"), F.col(c).alias("value")) for c in same])
        counts = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("attr", "value").count()
        best = counts.groupBy("attr").agg(F.min(F.struct((-F.col("count")).alias("n"), "value")).alias("best"))
        found.update({r["attr"]: r["value"] for r in best.select("attr", "best.value").collect()})
    return found


def mode_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    found = modes(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(found[c])) for c in columns if c in found})


def fill_category(df: DataFrame, column: str = "category", unknown="unknown") -> DataFrame:
    """Rows without a category get one of their own."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(unknown)))


def forward_fill_category(
    df: DataFrame, group: list[str], order: list[str], column: str, name: str, unknown="unknown"
) -> DataFrame:
    """Missing categories take the category of the row before them in the stated order."""
    filled = last_known(df, group, [F.col(c) for c in order], column, name)
    return fill_category(filled, name, unknown)


def sanitize_non_finite(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: finite_or_zero(F.col(c)) for c in columns})


def type_report(df: DataFrame) -> DataFrame:
    """Smallest fitting type of every numeric column: column, lowest, highest, type."""
    whole = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    real = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    ranges = df.agg(*[f(c).alias(f"{c}_{n}") for c in whole + real for n, f in (("lo", F.min), ("hi", F.max))])
    entries = []
    for c in whole + real:
        lo, hi = F.col(f"{c}_lo"), F.col(f"{c}_hi")
        if c in whole:
            fit = F.lit("bigint")
            for name, bound in reversed(WHOLE_TYPES):
                fit = F.when((lo >= -bound) & (hi < bound), F.lit(name)).otherwise(fit)
        else:
            inside = (lo >= -FLOAT_LARGEST) & (hi <= FLOAT_LARGEST)
            fit = F.when(inside, F.lit("float")).otherwise(F.lit("double"))
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                lo.cast("double").alias("lowest"),
                hi.cast("double").alias("highest"),
                fit.alias("type"),
            )
        )
    return ranges.select(F.inline(F.array(*entries)))


def narrow_schema(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the smallest type that holds its range."""
    fits = {r["column"]: r["type"] for r in type_report(df).collect()}
    return df.withColumns({c: F.col(c).cast(t) for c, t in fits.items()})
