"""Queries of the usage profile."""

from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import stats, usage
from tallyloom.operators.categories import with_category
from tallyloom.suite.registry import (
    WEEKEND,
    binned,
    query,
    real,
    rounded,
    truncated,
    whole,
    with_parts,
)
from tallyloom.suite.registry import stats as stats_sql

PARTS = ("all", "weekend", "weekday")

_profile = f"""SELECT *, {", ".join(
    f"coalesce({truncated(f'{m}_{p} / nullif({n}, 0)')}, 0) AS {m}_per_day_{p}, "
    f"coalesce({truncated(f'{m}_{p} / nullif(apps_{p}, 0)')}, 0) AS {m}_per_app_{p}"
    for p, n in (("all", "30"), ("weekend", "weekend_n"), ("weekday", "weekday_n"))
    for m in ("duration", "times")
)} FROM (SELECT uid, count(*) AS apps_all, {real("sum(duration)")} AS duration_all, {real("sum(times)")} AS times_all,
  {whole("count(*) FILTER (weekend_days > 0)")} AS apps_weekend,
  {real("sum(weekend_duration)")} AS duration_weekend, {real("sum(weekend_times)")} AS times_weekend,
  {whole("count(*) FILTER (days > weekend_days)")} AS apps_weekday,
  {real("sum(duration - weekend_duration)")} AS duration_weekday,
  {real("sum(times - weekend_times)")} AS times_weekday,
  {real("max(duration)")} AS duration_max, {real("max(times)")} AS times_max
  FROM app_totals GROUP BY uid),
  (SELECT count(DISTINCT use_date) FILTER ({WEEKEND}) AS weekend_n,
    count(DISTINCT use_date) FILTER (NOT {WEEKEND}) AS weekday_n FROM usage)"""


def _profile_sql(select: str) -> str:
    return with_parts(f"SELECT uid, {select} FROM profile", "usage", "app_totals", profile=_profile)


def _columns(part: str) -> list[str]:
    return [f"apps_{part}"] + [f"{m}{k}_{part}" for m in ("duration", "times") for k in ("", "_per_day", "_per_app")]


@query(
    "user_usage_totals",
    with_parts(
        f"""SELECT uid, count(*) AS use_days, {real("sum(duration)")} AS duration, {real("sum(times)")} AS times,
        {rounded("count(*) / 30", 5)} AS use_days_ratio FROM day_totals GROUP BY uid""",
        "day_totals",
    ),
)
def user_usage_totals(r):
    return usage.user_usage_totals(usage.day_totals(r.usage()))


@query(
    "user_usage_totals_month",
    with_parts(
        f"""SELECT uid, count(DISTINCT use_date) AS use_days, {real("sum(duration)")} AS duration,
        {real("sum(times)")} AS times, {rounded("count(DISTINCT use_date) / 30", 5)} AS use_days_ratio
        FROM month_log GROUP BY uid""",
        "month_log",
    ),
)
def user_usage_totals_month(r):
    return usage.user_usage_totals(usage.day_totals(r.month_log()))


ALL_COLUMNS = _columns("all")


@query("user_usage_averages", _profile_sql(", ".join(ALL_COLUMNS)))
def user_usage_averages(r):
    return usage.usage_profile(r.usage()).select("uid", *ALL_COLUMNS)


@query(
    "user_app_nunique",
    with_parts("SELECT uid, count(DISTINCT app) AS apps FROM usage GROUP BY uid", "usage"),
)
def user_app_nunique(r):
    return usage.user_app_nunique(r.usage())


@query(
    "six_stats_rows",
    with_parts(
        f"""SELECT uid, {stats_sql("duration", "duration", 4, 0)}, {stats_sql("times", "times", 6)}
        FROM usage GROUP BY uid""",
        "usage",
    ),
)
def six_stats_rows(r):
    out = usage.row_stats(r.usage())
    return stats.round_stats(stats.round_stats(out, "duration", 4, 0), "times", 6)


@query(
    "daily_app_count_stats",
    with_parts(f"SELECT uid, {stats_sql('apps', 'daily_apps', 6)} FROM day_totals GROUP BY uid", "day_totals"),
)
def daily_app_count_stats(r):
    return stats.round_stats(usage.daily_app_stats(usage.day_totals(r.usage())), "daily_apps", 6)


def _daily_sum_sql(condition: str) -> str:
    return with_parts(
        f"""SELECT uid, {stats_sql("duration", "daily_duration", 4, 0)}, {stats_sql("times", "daily_times", 6)}
        FROM day_totals WHERE {condition} GROUP BY uid""",
        "day_totals",
    )


def _daily_sum(log):
    out = usage.daily_sum_stats(usage.day_totals(log))
    return stats.round_stats(stats.round_stats(out, "daily_duration", 4, 0), "daily_times", 6)


@query("daily_sum_stats_weekend", _daily_sum_sql(WEEKEND))
def daily_sum_stats_weekend(r):
    return _daily_sum(r.usage().where(usage.is_weekend()))


@query("daily_sum_stats_weekday", _daily_sum_sql(f"NOT {WEEKEND}"))
def daily_sum_stats_weekday(r):
    return _daily_sum(r.usage().where(~usage.is_weekend()))


def _variance_sql(prefix: str, source: str) -> str:
    return f"""SELECT uid, {truncated(f"var_pop({real('duration')})")} AS {prefix}_duration_var,
    {truncated(f"var_pop({real('times')})")} AS {prefix}_times_var FROM {source} GROUP BY uid"""


_category_sums = """SELECT uid, category, sum(duration) AS duration, sum(times) AS times FROM categorised
    GROUP BY uid, category"""


@query("daily_var_pop", with_parts(_variance_sql("daily", "day_totals"), "day_totals"))
def daily_var_pop(r):
    return usage.daily_variance(usage.day_totals(r.usage()))


@query("category_var_pop", with_parts(_variance_sql("category", "sums"), "categorised", sums=_category_sums))
def category_var_pop(r):
    return usage.category_variance(with_category(usage.app_totals(r.usage()), r.categories()))


@query(
    "max_app_totals",
    with_parts(
        f"""SELECT uid, duration_max, times_max,
        {binned("duration_max", "(SELECT max(duration_max) FROM m)", 20000)} AS duration_max_bin,
        {binned("times_max", "(SELECT max(times_max) FROM m)", 2000)} AS times_max_bin FROM m""",
        "app_totals",
        m=f"""SELECT uid, {real("max(duration)")} AS duration_max, {real("max(times)")} AS times_max
        FROM app_totals GROUP BY uid""",
    ),
)
def max_app_totals(r):
    return usage.max_app_totals(usage.app_totals(r.usage()))


def _binned_columns(part: str) -> str:
    sizes = {"duration": 10000, "times": 1000, "duration_per_day": 1000, "duration_per_app": 10000}
    return ", ".join(
        f"{binned(f'{m}_{part}', f'(SELECT max({m}_{part}) FROM profile)', n)} AS {m}_{part}_bin"
        for m, n in sizes.items()
    )


def _part(r, part):
    out = usage.with_profile_bins(usage.usage_profile(r.usage()))
    keep = [c for c in out.columns if c.endswith(f"_{part}") or c.endswith(f"_{part}_bin")]
    return out.select("uid", *keep)


@query("usage_profile_bins", _profile_sql(", ".join(_columns("all")) + ", " + _binned_columns("all")))
def usage_profile_bins(r):
    return _part(r, "all")


@query("weekend_profile", _profile_sql(", ".join(_columns("weekend")) + ", " + _binned_columns("weekend")))
def weekend_profile(r):
    return _part(r, "weekend")


@query("weekday_profile", _profile_sql(", ".join(_columns("weekday")) + ", " + _binned_columns("weekday")))
def weekday_profile(r):
    return _part(r, "weekday")


_ratios = {}
for _m in ("duration", "times"):
    for _k in ("", "_per_day", "_per_app"):
        _ratios[f"{_m}{_k}_ratio"] = (f"{_m}{_k}_weekend", f"{_m}{_k}_weekday")
for _p in ("weekend", "weekday"):
    _ratios[f"{_p}_duration_share"] = (f"duration_{_p}", "duration_all")
    _ratios[f"{_p}_apps_share"] = (f"apps_{_p}", "apps_all")


def _ratio(a, b):
    return rounded(f"CASE WHEN {b} = 0 THEN {real(a)} ELSE {real(a)} / {b} END", 6)


@query("weekend_weekday_ratio", _profile_sql(", ".join(f"{_ratio(a, b)} AS {n}" for n, (a, b) in _ratios.items())))
def weekend_weekday_ratio(r):
    out = usage.weekend_weekday_ratios(usage.usage_profile(r.usage()))
    return out.select("uid", *[round_even(F.col(c), 6).alias(c) for c in _ratios])


@query(
    "scaled_usage_share",
    _profile_sql(
        f"{rounded('duration_per_app_all / 43200.0', 8)} AS app_share, {rounded('duration_max / 43200.0', 8)} AS max_share"
    ),
)
def scaled_usage_share(r):
    out = usage.day_shares(
        usage.usage_profile(r.usage()), {"duration_per_app_all": "app_share", "duration_max": "max_share"}
    )
    return out.select("uid", *[round_even(F.col(c), 8).alias(c) for c in ("app_share", "max_share")])


@query(
    "frequent_app_count",
    with_parts(
        """SELECT uid, count(*) AS frequent_apps FROM (SELECT uid, app, count(use_date) AS days FROM month_log
        GROUP BY uid, app) WHERE days >= 3 GROUP BY uid""",
        "month_log",
    ),
)
def frequent_app_count(r):
    return usage.frequent_app_count(usage.app_totals(r.month_log()), days=3)
