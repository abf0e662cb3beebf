"""Derived columns of the attribute and behaviour tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def behaviour_arithmetic(
    df: DataFrame, boots: str, traffic: str, counters: list[str], days: int = 30
) -> DataFrame:
    """Scaled, averaged, squared and summed counters.

    `counters` names six columns; the second and third belong together, and so do the
    fourth and fifth.
    """
    df = df.withColumns({c: F.col(c) * 10 for c in counters})
    average = F.col(boots) / F.lit(float(days))
    total = sum((F.col(c) for c in counters[1:]), F.col(counters[0]))
    near = F.col(counters[1]) + F.col(counters[2])
    far = F.col(counters[3]) + F.col(counters[4])
    return df.withColumns(
        {
            f"average_{boots}": average,
            f"average_{traffic}": F.col(traffic) / F.lit(float(days)),
            f"square_{boots}": F.col(boots) * F.col(boots),
            f"square_average_{boots}": average * average,
            **{f"square_{c}": F.col(c) * F.col(c) for c in counters},
            "behaviour_sum": total,
            "first_pair_squared": near * near,
            "second_pair_squared": far * far,
        }
    )


def capacity_left_used(df: DataFrame, capacities: dict[str, tuple[str, str]]) -> DataFrame:
    """left = capacity * ratio and used = capacity - left: {prefix: (capacity, ratio)}."""
    added = {}
    for prefix, (capacity, ratio) in capacities.items():
        left = F.col(capacity) * F.col(ratio)
        added[f"{prefix}_left"] = left
        added[f"{prefix}_used"] = F.col(capacity) - left
    return df.withColumns(added)


def cross_feature(df: DataFrame, crosses: dict[str, list[str]]) -> DataFrame:
    """Joined text of several attributes: {name: columns}. A missing part leaves the cross missing."""
    added = {}
    for name, columns in crosses.items():
        parts = [F.col(c).cast("string") for c in columns]
        known = F.lit(True)
        for p in parts:
            known = known & p.isNotNull()
        added[name] = F.when(known, F.concat_ws("_", *parts))
    return df.withColumns(added)
