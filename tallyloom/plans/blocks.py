"""Feature blocks of the users, one row per user."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import attributes, categories, clean, encode, priors, ranking, stats, text, usage
from tallyloom.operators.assemble import assemble, slot_vector, sparse_block, to_vector
from tallyloom.operators.hot import hot_keys, lookup_join, tasks_for
from tallyloom.operators.stats import dense_codes
from tallyloom.sources.stage import stage, stage_by_key

# Users whose wide rows one task builds.
TASK_USERS = 50_000


def usage_block(
    log: DataFrame,
    app_categories: DataFrame,
    labelled: DataFrame,
    classes: list[int],
    values: list,
    days: int = 30,
    top: int = 0,
    support: int = 50,
    weekend: Column | None = None,
) -> DataFrame:
    """Everything the usage log says about a user, 0 where it says nothing.

    The log and what it is reduced to, app totals, day totals and categories, are staged in
    buckets of uid because many parts follow from each: neither the parts nor the joins
    between them shuffle the rows again. With a user too large for one task they are staged
    as they come. The top apps stay one map per user until all parts are joined.
    """
    weekend = usage.is_weekend() if weekend is None else weekend
    log = stage(log)
    dealt = hot_keys(log, ["uid"]) is None
    buckets = tasks_for(log.sparkSession, log.count())

    def keep(rows: DataFrame) -> DataFrame:
        return stage_by_key(rows, "uid", buckets) if dealt else stage(rows)

    log = keep(log)
    daily = keep(usage.daily_totals(log))
    apps = keep(usage.app_totals_of(daily, weekend))
    by_day = keep(usage.day_totals_of(daily))
    app_categories = stage(ranking.unique_categories(app_categories))
    categorised = categories.with_category(apps.select("uid", "app", "duration", "times"), app_categories)
    categorised = keep(categorised.drop("app"))
    profile = usage.profile(apps, days, *usage.calendar(by_day, weekend))
    profile = usage.weekend_weekday_ratios(usage.with_profile_bins(profile))
    spread = usage.daily_variance(by_day).join(usage.category_variance(categorised), "uid", "left")
    ranks = {c: f"{c}_rank" for c in spread.columns if c.endswith("_var")}
    pairs = apps.select("uid", "app")
    app_priors = priors.label_prior(pairs.join(labelled, "uid"), ["app"], classes, 4, support)
    days_used = by_day.groupBy("uid").agg(F.count(F.lit(1)).alias("use_days"))
    session = ranking.longest_session_app(apps, app_categories).select(
        "uid", "session", F.col("category").alias("session_category")
    )
    blocks = [
        days_used,
        stats.global_dense_rank(spread, ranks),
        categories.category_usage(categorised, values),
        categories.category_nunique(categorised),
        ranking.leading_apps(apps, "duration", app_categories),
        ranking.leading_apps(apps, "times", app_categories),
        session,
        usage.frequent_app_count(apps),
        priors.prior_rollup(pairs, app_priors, classes),
        usage.row_stats(log, dealt),
        usage.daily_app_stats(by_day, dealt),
        _renamed(usage.daily_sum_stats(by_day.where(weekend), dealt), "weekend_"),
        _renamed(usage.daily_sum_stats(by_day.where(~weekend), dealt), "weekday_"),
    ]
    if top:
        blocks.append(ranking.top_app_lists(ranking.top_app_usage(log, top)))
    out = assemble(profile, [_without(b, profile) for b in blocks])
    if top:
        out = ranking.top_app_columns(out, top)
    shares = {"duration_per_app_all": "app_share", "duration_1": "max_app_share", "duration_2": "second_app_share"}
    return usage.day_shares(out, shares, days)


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[c if c == "uid" else prefix + c for c in df.columns])


def _without(block: DataFrame, base: DataFrame) -> DataFrame:
    """The block without columns the base has already."""
    return block.drop(*[c for c in block.columns if c != "uid" and c in base.columns])


def installed_block(
    pairs: DataFrame,
    app_categories: DataFrame,
    labelled: DataFrame,
    classes: list[int],
    values: list,
    support: int = 20,
    shares: tuple = priors.TYPICAL_SHARES,
    base: tuple = priors.BASE_SHARES,
    order: str | None = None,
) -> DataFrame:
    """Everything the installed apps say about a user. `pairs` are distinct (uid, app)."""
    pairs = stage(pairs)
    owned = pairs.join(labelled, "uid")
    coarse = priors.label_prior(owned, ["app"], classes, 2)
    fine = priors.label_prior(owned, ["app"], classes, 4, support)
    categorised = categories.with_category(pairs, app_categories, order)
    counts = categories.category_counts(categorised, values)
    return assemble(
        categories.install_ratio(pairs),
        [
            priors.typical_app_counts(pairs, coarse, classes, shares),
            categories.category_shares(counts, values),
            categories.category_nunique(categorised),
            priors.class_weight_index(pairs, coarse, classes, base),
            _renamed(priors.prior_rollup(pairs, fine, classes), "app_"),
        ],
    )


def base_block(
    users: DataFrame,
    labelled: DataFrame,
    classes: list[int],
    prior_attributes: list[str],
    counters: list[str],
    crosses: dict[str, list[str]],
    flags: dict[str, list],
    boots: str = "boot_times",
    traffic: str = "f_sum",
    capacities: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Codes, crosses, arithmetic, capacities, flags and label priors of the attribute table.

    Missing attributes take their mode first. `capacities` names {prefix: (capacity, share left)};
    what is left and used of them is coded too. The attributes are staged, as modes, codes and
    priors each read them; they are dealt over tasks by their number, since a few bytes of
    them become a wide row.
    """
    users = stage(clean.clamp_negative(users, counters))
    tasks = tasks_for(users.sparkSession, users.count(), TASK_USERS)
    users = clean.mode_impute(users, [*prior_attributes, *flags])
    users = attributes.cross_feature(attributes.capacity_left_used(users, capacities or {}), crosses)
    known = users.join(labelled, "uid")
    found = priors.attribute_priors(known, prior_attributes, classes)
    room = [f"{prefix}_{part}" for prefix in capacities or {} for part in ("left", "used")]
    if crosses:
        found = found.unionByName(priors.attribute_priors(known, list(crosses), classes, digits=2))
    coded = encode.ordinal_encode(users.repartition(tasks, "uid"), [*prior_attributes, *crosses, *room])
    hot = encode.one_hot(coded, flags)
    with_priors = priors.prior_backjoin(hot, found, [*prior_attributes, *crosses], classes)
    out = attributes.behaviour_arithmetic(with_priors, boots, traffic, counters)
    texts = [c for c, t in out.dtypes if t == "string"]
    return out.drop(*texts).na.fill(0)


def fit_flags(
    users: DataFrame, labelled: DataFrame, classes: list[int], crosses: dict[str, list[str]], rules: dict[str, tuple]
) -> DataFrame:
    """The values of crosses that lean to a class among labelled users, with 1-based slots: (attr, value, slot).

    `rules` are the bounds of `priors.select_values` per cross. This table is the encoder:
    written and read again, it applies to any users.
    """
    known = attributes.cross_feature(users, crosses).join(labelled, "uid")
    parts = []
    for cross in crosses:
        found = priors.select_values(priors.label_prior(known, [cross], classes, digits=2), classes, *rules[cross])
        parts.append(found.select(F.lit(cross).alias("attr"), F.col(cross).alias("value")))
    return dense_codes(reduce(DataFrame.unionByName, parts), ["attr"], "value", "slot")


def apply_flags(users: DataFrame, crosses: dict[str, list[str]], encoder: DataFrame) -> dict[str, DataFrame]:
    """One-hot vectors of the values that the encoder knows: {name: (uid, vector)}.

    Users with other values get zeros; a cross without selected values gives no block.
    """
    users = attributes.cross_feature(users, crosses)
    sizes = {r["attr"]: r["n"] for r in encoder.groupBy("attr").agg(F.max("slot").alias("n")).collect()}  # a row per cross
    out = {}
    for cross, size in sizes.items():
        slots = encoder.where(F.col("attr") == cross).select(F.col("value").alias(cross), "slot")
        found = lookup_join(users.select("uid", cross), slots, cross).na.fill(0, ["slot"])
        out[f"{cross}_flags"] = slot_vector(found, "slot", size, f"{cross}_flags")
    return out


def selected_flags(
    users: DataFrame, labelled: DataFrame, classes: list[int], crosses: dict[str, list[str]], rules: dict[str, tuple]
) -> dict[str, DataFrame]:
    """The encoder of fit_flags, fitted and applied to the same users."""
    return apply_flags(users, crosses, stage(fit_flags(users, labelled, classes, crosses, rules)))


def token_block(pairs: DataFrame, users: DataFrame, min_df: float | int = 1, name: str = "tokens") -> DataFrame:
    """TF-IDF weights of the apps of each user as one sparse vector: (uid, vector)."""
    values = stage(text.tfidf_rows(pairs.select(F.col("uid").alias("doc"), F.col("app").cast("string").alias("token")), min_df))
    slots = text.token_slots(values)
    rows = text.with_slots(values, slots).select(F.col("doc").alias("uid"), "slot", F.col("weight").alias("value"))
    return sparse_block(rows, users, slots.count(), name)


def number_block(block: DataFrame, name: str) -> DataFrame:
    """The numbers of a wide block as one vector: (uid, vector). Texts, such as app ids, are left out."""
    numbers = [c for c, t in block.dtypes if c != "uid" and t != "string"]
    return to_vector(block.na.fill(0.0, numbers), numbers, name)
