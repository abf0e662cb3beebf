"""Label priors: how often each value of an attribute goes with each class."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators.hot import lookup_join, lookup_parts
from tallyloom.operators.stats import floor_stats, six_stats
from tallyloom.sources.stage import stage

# Share of each class from which an app counts as typical of it.
TYPICAL_SHARES = (0.3, 0.6, 0.6, 0.6, 0.3, 0.3)
# Share of each class in the population, for the class weight index.
BASE_SHARES = (0.03, 0.2, 0.3, 0.25, 0.15, 0.075)
# How the crosses of attributes select their values, as the share per
# class, the support needed with it, and the support that is enough by itself.
CROSS_RULES = {
    "model_colour_font": ((0.1, 0.3, 0.4, 0.35, 0.2, 0.15), 10000, 26000),
    "memory_storage_system": ((0.4, 0.3, 0.32, 0.32, 0.3, 0.3), 10000, 35000),
    "all_six": ((0.4, 0.3, 0.32, 0.32, 0.2, 0.3), 10000, None),
}


def class_counts(rows: DataFrame, keys: list[str], classes: list[int]) -> DataFrame:
    """Rows per key and class as columns n_<class>, and their total. Null keys are left out."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    cells = [F.count_if(F.col("label") == k).alias(f"n_{k}") for k in classes]
    total = F.count_if(F.col("label").isin(classes)).alias("total")
    return rows.where(known).groupBy(*keys).agg(*cells, total)


def with_shares(counts: DataFrame, classes: list[int], digits: int) -> DataFrame:
    """Add the rounded share of each class."""
    return counts.withColumns(
        {f"share_{k}": round_even(F.try_divide(F.col(f"n_{k}"), F.col("total")), digits) for k in classes}
    )


def label_prior(
    rows: DataFrame, keys: list[str], classes: list[int], digits: int = 3, support: int = 0
) -> DataFrame:
    """Counts and shares of the classes per key, for keys with enough rows."""
    counts = class_counts(rows, keys, classes).where(F.col("total") >= max(support, 1))
    return with_shares(counts, classes, digits)


def long_attributes(rows: DataFrame, attributes: list[str], keep: list[str]) -> DataFrame:
    """One row per attribute of each row: (*keep, attr, value), values as text."""
    named = [F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("value")) for a in attributes]
    return rows.select(*keep, F.inline(F.array(*named)))


def attribute_priors(
    rows: DataFrame, attributes: list[str], classes: list[int], digits: int = 3
) -> DataFrame:
    """Priors of many attributes in one pass: (attr, value, counts, total, shares)."""
    return label_prior(long_attributes(rows, attributes, ["label"]), ["attr", "value"], classes, digits)


def prior_backjoin(users: DataFrame, priors: DataFrame, attributes: list[str], classes: list[int]) -> DataFrame:
    """Attach the prior of each attribute to every user, 0 for unseen values.

    The priors are written once; each attribute then reads its own part of them. A prior
    stays one column until all are attached, so no join copies the columns of the others.
    """
    priors = stage(priors, "attr")
    cells = [f"{c}_{k}" for k in classes for c in ("n", "share")]
    joins = {}
    for a in attributes:
        found = F.struct(*cells).alias(f"_prior_{a}")
        joins[a] = (f"_{a}", priors.where(F.col("attr") == a).select(F.col("value").alias(f"_{a}"), found))
    names = users.columns
    users = lookup_parts(users.withColumns({f"_{a}": F.col(a).cast("string") for a in attributes}), joins)
    return users.select(
        *names, *[F.coalesce(F.col(f"_prior_{a}").getField(c), F.lit(0)).alias(f"{a}_{c}") for a in attributes for c in cells]
    )


def out_of_fold_priors(rows: DataFrame, key: str, classes: list[int], digits: int = 4) -> DataFrame:
    """Prior of each (key, fold) from the rows of all other folds, so no row sees its own label."""
    own = class_counts(rows, [key, "fold"], classes)
    cells = [f"n_{k}" for k in classes] + ["total"]
    whole = own.groupBy(key).agg(*[F.sum(c).alias(f"_all_{c}") for c in cells])
    rest = own.join(whole, key).select(key, "fold", *[(F.col(f"_all_{c}") - F.col(c)).alias(c) for c in cells])
    return with_shares(rest, classes, digits)


def select_values(
    priors: DataFrame, classes: list[int], shares: tuple, support: int, enough: int | None
) -> DataFrame:
    """Values that lean to some class and have support, or have support enough by itself."""
    leaning = reduce(lambda a, b: a | b, [F.col(f"share_{k}") >= t for k, t in zip(classes, shares)])
    keep = leaning & (F.col("total") > support)
    if enough is not None:
        keep = keep | (F.col("total") > enough)
    return priors.where(keep)


def typical_flags(priors: DataFrame, classes: list[int], shares: tuple = TYPICAL_SHARES) -> DataFrame:
    """1 in typical_<class> where the share of the class reaches its bound."""
    flags = [
        F.when(F.col(f"share_{k}") >= t, F.lit(1)).otherwise(F.lit(0)).cast("long").alias(f"typical_{k}")
        for k, t in zip(classes, shares)
    ]
    return priors.select("app", *flags)


def typical_app_counts(
    pairs: DataFrame, priors: DataFrame, classes: list[int], shares: tuple = TYPICAL_SHARES
) -> DataFrame:
    """Number of apps typical of each class per user."""
    joined = lookup_join(pairs, typical_flags(priors, classes, shares), "app")
    sums = [F.coalesce(F.sum(f"typical_{k}"), F.lit(0)).alias(f"typical_{k}") for k in classes]
    return joined.groupBy("uid").agg(*sums)


def class_weight_index(
    pairs: DataFrame, priors: DataFrame, classes: list[int], base: tuple = BASE_SHARES
) -> DataFrame:
    """Six statistics and squared mean, per user, of sum(10 * class * share / base share) over the apps.

    Weights are kept as decimals, so that a mean does not depend on the order of the rows.
    """
    weight = reduce(
        lambda a, b: a + b,
        [F.lit(10.0 * k) * F.col(f"share_{k}") / F.lit(b) for k, b in zip(classes, base)],
    )
    weights = priors.select("app", round_even(weight, 6).cast("decimal(18,6)").alias("weight"))
    return six_stats(
        pairs.select("uid", "app"),
        ["uid"],
        {"weight": "weight"},
        mean_squared=True,
        enrich=lambda rows: lookup_join(rows, weights, "app"),
    )


def prior_rollup(pairs: DataFrame, priors: DataFrame, classes: list[int], digits: int = 4) -> DataFrame:
    """Six statistics of the shares and counts of the apps of each user, for every class.

    Shares also get the squared mean; count statistics are floored. One aggregate
    serves all classes.
    """
    exact = f"decimal(10,{digits})"
    table = priors.select(
        "app",
        *[F.col(f"share_{k}").cast(exact).alias(f"share_{k}") for k in classes],
        *[f"n_{k}" for k in classes],
    )
    columns = {f"share_{k}": f"share_{k}" for k in classes} | {f"n_{k}": f"n_{k}" for k in classes}
    out = six_stats(
        pairs.select("uid", "app"),
        ["uid"],
        columns,
        mean_squared=True,
        enrich=lambda rows: lookup_join(rows, table, "app"),
    )
    out = out.drop(*[f"n_{k}_mean_sq" for k in classes])
    for k in classes:
        out = floor_stats(out, f"n_{k}")
    return out
