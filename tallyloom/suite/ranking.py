"""Queries of ranks, leading apps and categories."""

from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import categories, ranking, stats, usage
from tallyloom.sources.roles import PART_TYPES
from tallyloom.suite.registry import query, real, rounded, truncated, with_parts


@query(
    "rank_apps_in_user",
    with_parts(
        f"""SELECT uid, app, {real("duration")} AS duration,
        row_number() OVER (PARTITION BY uid ORDER BY duration DESC, app) AS rank FROM app_totals""",
        "app_totals",
    ),
)
def rank_apps_in_user(r):
    log = r.usage()
    ranked = ranking.rank_apps(usage.app_totals(log), "duration", log)
    return ranked.select("uid", "app", F.col("duration").cast("double").alias("duration"), "rank")


def _leading_sql(m):
    cells = ", ".join(
        f"max(app) FILTER (place = {p}) AS {m}_app_{p}, {real(f'max({m}) FILTER (place = {p})')} AS {m}_{p}, "
        f"max(category) FILTER (place = {p}) AS {m}_category_{p}"
        for p in (1, 2)
    )
    return with_parts(
        f"""SELECT uid, {cells} FROM (SELECT uid, app, {m}, category,
        row_number() OVER (PARTITION BY uid ORDER BY {m} DESC, app) AS place FROM categorised) GROUP BY uid""",
        "categorised",
    )


@query("top2_by_duration", _leading_sql("duration"))
def top2_by_duration(r):
    return ranking.leading_apps(usage.app_totals(r.usage()), "duration", r.categories())


@query("top2_by_times", _leading_sql("times"))
def top2_by_times(r):
    return ranking.leading_apps(usage.app_totals(r.usage()), "times", r.categories())


_session = truncated(f"{real('duration')} / times")


@query(
    "argmax_avg_session",
    with_parts(
        f"""SELECT uid, app, session, category FROM (SELECT uid, app, category, {_session} AS session,
        row_number() OVER (PARTITION BY uid ORDER BY {_session} DESC, app) AS place FROM categorised
        WHERE times <> 0) WHERE place = 1""",
        "categorised",
    ),
)
def argmax_avg_session(r):
    return ranking.longest_session_app(usage.app_totals(r.usage()), r.categories())


@query(
    "top_app_category",
    """SELECT uid, app, n, category FROM (SELECT o_custkey AS uid, p_name AS app, count(*) AS n,
      row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, p_name) AS place
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
    JOIN (SELECT p_name AS app, arg_min(p_type, p_partkey) AS category FROM part GROUP BY p_name) USING (app)
    WHERE place = 1""",
)
def top_app_category(r):
    names = r.table("part").select(F.col("p_partkey").alias("app"), F.col("p_name").alias("name"))
    uses = r.usage().groupBy("uid", "app").agg(F.count(F.lit(1)).alias("n")).join(names, "app")
    per_name = uses.groupBy("uid", "name").agg(F.sum("n").alias("n"))
    best = per_name.groupBy("uid").agg(F.min(F.struct((-F.col("n")).alias("m"), "name")).alias("best"))
    best = best.select("uid", F.col("best.name").alias("app"), (-F.col("best.m")).alias("n"))
    return categories.with_category(best, r.name_categories(), order="place")


@query(
    "global_dense_rank",
    with_parts(
        """SELECT uid, daily_duration_var, daily_times_var,
        dense_rank() OVER (ORDER BY daily_duration_var) AS duration_var_rank,
        dense_rank() OVER (ORDER BY daily_times_var) AS times_var_rank FROM v""",
        "day_totals",
        v=f"""SELECT uid, {truncated(f"var_pop({real('duration')})")} AS daily_duration_var,
        {truncated(f"var_pop({real('times')})")} AS daily_times_var FROM day_totals GROUP BY uid""",
    ),
)
def global_dense_rank(r):
    return stats.global_dense_rank(
        usage.daily_variance(usage.day_totals(r.usage())),
        {"daily_duration_var": "duration_var_rank", "daily_times_var": "times_var_rank"},
    )


_top = """SELECT app, count(DISTINCT uid) AS users,
    row_number() OVER (ORDER BY count(DISTINCT uid) DESC, app) AS slot FROM usage GROUP BY app
    ORDER BY users DESC, app LIMIT 200"""
_top_usage = f"""SELECT uid, slot, count(use_date) AS days, {real("sum(duration)")} AS duration,
    {real("sum(times)")} AS times FROM usage JOIN top USING (app) GROUP BY uid, slot"""


@query("topk_apps", with_parts("SELECT app, users, slot FROM top", "usage", top=_top))
def topk_apps(r):
    return ranking.top_apps_by_users(r.usage())


@query("topk_app_pivot", with_parts(_top_usage, "usage", top=_top))
def topk_app_pivot(r):
    return ranking.top_app_usage(r.usage())


@query(
    "topk_app_wide",
    with_parts(
        "SELECT uid, "
        + ", ".join(
            f"{real(f'coalesce(sum({m}) FILTER (slot = {s}), 0)')} AS app{s}_{m}"
            for s in range(1, 201)
            for m in ("days", "duration", "times")
        )
        + " FROM cells GROUP BY uid",
        "usage",
        top=_top,
        cells=_top_usage,
    ),
)
def topk_app_wide(r):
    return ranking.top_app_wide(ranking.top_app_usage(r.usage()), 200)


@query("app_frequency", with_parts("SELECT app, count(use_date) AS uses FROM usage GROUP BY app", "usage"))
def app_frequency(r):
    return ranking.app_frequency(r.usage())


@query(
    "vocab_topn",
    with_parts(
        "SELECT app, count(use_date) AS uses FROM usage GROUP BY app ORDER BY uses DESC, app LIMIT 1000", "usage"
    ),
)
def vocab_topn(r):
    return ranking.most_used_apps(r.usage(), 1000)


def _categorised(r):
    return categories.with_category(usage.app_totals(r.usage()), r.categories())


def _cells(text):
    return ", ".join(text.format(v=v) for v in PART_TYPES)


@query(
    "category_counts",
    with_parts(
        "SELECT uid, " + _cells("count(*) FILTER (category = '{v}') AS \"n_{v}\"") + " FROM categorised GROUP BY uid",
        "categorised",
    ),
)
def category_counts(r):
    return categories.category_counts(_categorised(r), PART_TYPES)


@query(
    "category_share",
    with_parts(
        "SELECT uid, "
        + ", ".join(
            rounded(f"count(*) FILTER (category = '{v}') / count(*)", 6) + f' AS "share_{v}"' for v in PART_TYPES
        )
        + " FROM categorised GROUP BY uid",
        "categorised",
    ),
)
def category_share(r):
    counts = categories.category_counts(_categorised(r), PART_TYPES)
    out = categories.category_shares(counts, PART_TYPES)
    return out.select("uid", *[round_even(F.col(f"share_{v}"), 6).alias(f"share_{v}") for v in PART_TYPES])


@query(
    "category_duration_times",
    with_parts(
        "SELECT uid, "
        + _cells(
            "count(*) FILTER (category = '{v}') AS \"apps_{v}\", "
            "CAST(coalesce(sum(duration) FILTER (category = '{v}'), 0) AS DOUBLE) AS \"duration_{v}\", "
            "CAST(coalesce(sum(times) FILTER (category = '{v}'), 0) AS DOUBLE) AS \"times_{v}\""
        )
        + " FROM categorised GROUP BY uid",
        "categorised",
    ),
)
def category_duration_times(r):
    return categories.category_usage(_categorised(r), PART_TYPES)
