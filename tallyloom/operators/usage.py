"""Profiles of the usage log (uid, app, duration, times, use_date).

The log is reduced twice, to (uid, app) and to (uid, use_date), each with a combine
before its shuffle. Everything per user follows from these two tables with sums,
counts and extremes, so a very active user never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import guarded_ratio, round_even, scaled_ratio, truncate
from tallyloom.operators.stats import equal_width_bins, six_stats
from tallyloom.sources.stage import stage

# The eight weekend dates of the observed month.
WEEKEND_DATES = (
    "2019-03-02",
    "2019-03-03",
    "2019-03-09",
    "2019-03-10",
    "2019-03-16",
    "2019-03-17",
    "2019-03-23",
    "2019-03-24",
)


def is_weekend(day: str = "use_date", dates: tuple[str, ...] | None = None) -> Column:
    """Saturday or Sunday, or membership in a list of dates."""
    if dates is not None:
        return F.col(day).isin([F.lit(d).cast("date") for d in dates])
    return F.dayofweek(day).isin(1, 7)


def app_totals(log: DataFrame, weekend: Column | None = None) -> DataFrame:
    """One row per (uid, app): days, duration, times and their weekend parts."""
    weekend = is_weekend() if weekend is None else weekend
    return log.groupBy("uid", "app").agg(
        F.count("use_date").alias("days"),
        F.sum("duration").alias("duration"),
        F.sum("times").alias("times"),
        F.count_if(weekend).alias("weekend_days"),
        F.coalesce(F.sum(F.when(weekend, F.col("duration"))), F.lit(0)).alias("weekend_duration"),
        F.coalesce(F.sum(F.when(weekend, F.col("times"))), F.lit(0)).alias("weekend_times"),
    )


def day_totals(log: DataFrame) -> DataFrame:
    """One row per (uid, use_date): app rows, duration and times."""
    return log.groupBy("uid", "use_date").agg(
        F.count("app").alias("apps"),
        F.sum("duration").alias("duration"),
        F.sum("times").alias("times"),
    )


def daily_totals(log: DataFrame) -> DataFrame:
    """One row per (uid, app, use_date), from which app totals and day totals both follow."""
    return log.groupBy("uid", "app", "use_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("duration").alias("duration"), F.sum("times").alias("times")
    )


def app_totals_of(daily: DataFrame, weekend: Column | None = None) -> DataFrame:
    """`app_totals` from daily totals."""
    weekend = is_weekend() if weekend is None else weekend
    rows = F.when(F.col("use_date").isNotNull(), F.col("rows")).otherwise(F.lit(0))

    def inside(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(weekend, value)), F.lit(0))

    return daily.groupBy("uid", "app").agg(
        F.sum(rows).alias("days"),
        F.sum("duration").alias("duration"),
        F.sum("times").alias("times"),
        inside(F.col("rows")).alias("weekend_days"),
        inside(F.col("duration")).alias("weekend_duration"),
        inside(F.col("times")).alias("weekend_times"),
    )


def day_totals_of(daily: DataFrame) -> DataFrame:
    """`day_totals` from daily totals."""
    rows = F.when(F.col("app").isNotNull(), F.col("rows")).otherwise(F.lit(0))
    return daily.groupBy("uid", "use_date").agg(
        F.sum(rows).alias("apps"), F.sum("duration").alias("duration"), F.sum("times").alias("times")
    )


def user_app_nunique(log: DataFrame) -> DataFrame:
    return log.groupBy("uid").agg(F.count_distinct("app").alias("apps"))


def user_usage_totals(by_day: DataFrame, days: int = 30) -> DataFrame:
    """Active days, their share of the period, duration and times per user, from day totals."""
    return (
        by_day.groupBy("uid")
        .agg(
            F.count(F.lit(1)).alias("use_days"),
            F.sum("duration").cast("double").alias("duration"),
            F.sum("times").cast("double").alias("times"),
        )
        .withColumn("use_days_ratio", round_even(F.col("use_days") / F.lit(days), 5))
    )


def profile(apps: DataFrame, days: int, weekend_days: Column | int, weekday_days: Column | int) -> DataFrame:
    """Totals and whole-number averages per user for all days, weekends and weekdays, from app totals.

    All three profiles come from one pass; the parts are sums under a condition.
    """
    out = apps.groupBy("uid").agg(
        F.count(F.lit(1)).alias("apps_all"),
        F.sum("duration").cast("double").alias("duration_all"),
        F.sum("times").cast("double").alias("times_all"),
        F.count_if(F.col("weekend_days") > 0).alias("apps_weekend"),
        F.sum("weekend_duration").cast("double").alias("duration_weekend"),
        F.sum("weekend_times").cast("double").alias("times_weekend"),
        F.count_if(F.col("days") > F.col("weekend_days")).alias("apps_weekday"),
        F.sum(F.col("duration") - F.col("weekend_duration")).cast("double").alias("duration_weekday"),
        F.sum(F.col("times") - F.col("weekend_times")).cast("double").alias("times_weekday"),
        F.max("duration").cast("double").alias("duration_max"),
        F.max("times").cast("double").alias("times_max"),
    )
    added = {}
    for part, n in (("all", days), ("weekend", weekend_days), ("weekday", weekday_days)):
        n = F.lit(n) if isinstance(n, int) else n
        for m in ("duration", "times"):
            value = F.col(f"{m}_{part}")
            added[f"{m}_per_day_{part}"] = truncate(F.coalesce(F.try_divide(value, n), F.lit(0.0)))
            added[f"{m}_per_app_{part}"] = truncate(
                F.coalesce(F.try_divide(value, F.col(f"apps_{part}")), F.lit(0.0))
            )
    return out.withColumns(added)


def calendar(log: DataFrame, weekend: Column | None = None) -> tuple[Column, Column]:
    """Number of weekend dates and of other dates in the log, as scalar subqueries."""
    weekend = is_weekend() if weekend is None else weekend
    dates = log.select("use_date").distinct()
    counts = dates.agg(F.struct(F.count_if(weekend).alias("weekend"), F.count_if(~weekend).alias("weekday")).alias("n"))
    found = counts.scalar()
    return found.getField("weekend"), found.getField("weekday")


def usage_profile(log: DataFrame, days: int = 30, weekend: Column | None = None) -> DataFrame:
    """The three profiles of `profile` over a log.

    The log is read once, into daily totals, which are staged.
    """
    daily = stage(daily_totals(log))
    return profile(app_totals_of(daily, weekend), days, *calendar(daily, weekend))


def with_profile_bins(users: DataFrame) -> DataFrame:
    """Equal-width bins of the profile columns."""
    # The number of bins of each measure.
    bins = {}
    for part in ("all", "weekend", "weekday"):
        bins[f"duration_{part}_bin"] = (f"duration_{part}", 10000)
        bins[f"times_{part}_bin"] = (f"times_{part}", 1000)
        bins[f"duration_per_day_{part}_bin"] = (f"duration_per_day_{part}", 1000)
        bins[f"duration_per_app_{part}_bin"] = (f"duration_per_app_{part}", 10000)
    bins["duration_max_bin"] = ("duration_max", 20000)
    bins["times_max_bin"] = ("times_max", 2000)
    return equal_width_bins(users, bins)


def weekend_weekday_ratios(users: DataFrame) -> DataFrame:
    """The ten ratios between weekend, weekday and whole-period measures."""
    pairs = {}
    for m in ("duration", "times"):
        pairs[f"{m}_ratio"] = (f"{m}_weekend", f"{m}_weekday")
        pairs[f"{m}_per_day_ratio"] = (f"{m}_per_day_weekend", f"{m}_per_day_weekday")
        pairs[f"{m}_per_app_ratio"] = (f"{m}_per_app_weekend", f"{m}_per_app_weekday")
    for part in ("weekend", "weekday"):
        pairs[f"{part}_duration_share"] = (f"duration_{part}", "duration_all")
        pairs[f"{part}_apps_share"] = (f"apps_{part}", "apps_all")
    return users.withColumns({name: guarded_ratio(F.col(a), F.col(b)) for name, (a, b) in pairs.items()})


def day_shares(users: DataFrame, columns: dict[str, str], days: int = 30) -> DataFrame:
    """Durations as a share of the minutes of the period: {column: new name}."""
    return users.withColumns({name: scaled_ratio(F.col(c), days) for c, name in columns.items()})


def max_app_totals(apps: DataFrame) -> DataFrame:
    """Largest duration and times any one app has per user, with bins."""
    out = apps.groupBy("uid").agg(
        F.max("duration").cast("double").alias("duration_max"), F.max("times").cast("double").alias("times_max")
    )
    # The number of bins of each measure.
    return equal_width_bins(
        out, {"duration_max_bin": ("duration_max", 20000), "times_max_bin": ("times_max", 2000)}
    )


def row_stats(log: DataFrame, dealt: bool = False) -> DataFrame:
    """Six statistics of duration and times over the log rows of each user."""
    return six_stats(log, ["uid"], {"duration": "duration", "times": "times"}, sized_by=log.select("uid"), dealt=dealt)


def daily_app_stats(by_day: DataFrame, dealt: bool = False) -> DataFrame:
    """Six statistics of the app rows per day. Day totals have one row per user and date."""
    return six_stats(by_day, ["uid"], {"apps": "daily_apps"}, bounded=True, dealt=dealt)


def daily_sum_stats(by_day: DataFrame, dealt: bool = False) -> DataFrame:
    """Six statistics of the duration and times per day. Day totals have one row per user and date."""
    return six_stats(by_day, ["uid"], {"duration": "daily_duration", "times": "daily_times"}, bounded=True, dealt=dealt)


def _spread(sums: DataFrame, prefix: str) -> DataFrame:
    return sums.groupBy("uid").agg(
        truncate(F.var_pop(F.col("duration").cast("double"))).alias(f"{prefix}duration_var"),
        truncate(F.var_pop(F.col("times").cast("double"))).alias(f"{prefix}times_var"),
    )


def daily_variance(by_day: DataFrame) -> DataFrame:
    """Whole part of the population variance of the daily sums, from day totals."""
    return _spread(by_day, "daily_")


def category_variance(apps: DataFrame) -> DataFrame:
    """Whole part of the population variance of the sums per category.

    `apps` has a category column; rows without one are left out.
    """
    sums = (
        apps.where(F.col("category").isNotNull())
        .groupBy("uid", "category")
        .agg(F.sum("duration").alias("duration"), F.sum("times").alias("times"))
    )
    return _spread(sums, "category_")


def frequent_app_count(apps: DataFrame, days: int = 20) -> DataFrame:
    """Number of apps used on at least `days` days; users with none are absent."""
    return (
        apps.groupBy("uid")
        .agg(F.count_if(F.col("days") >= days).alias("frequent_apps"))
        .where(F.col("frequent_apps") > 0)
    )
