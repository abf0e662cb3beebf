"""Registry of queries and the shared pieces of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.roles import COUNTERS, PRIORITIES, SEGMENTS, Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of Roles as a query, with its SQL if it has one."""

    def register(build: Callable[[Roles], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Roles(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def whole(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def real(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def rounded(x: str, digits: int) -> str:
    return f"round_even({real(x)}, {digits})"


def truncated(x: str) -> str:
    return f"CAST(trunc({rounded(x, 4)}) AS BIGINT)"


def binned(x: str, largest: str, bins: int) -> str:
    top = f"CAST(trunc({real(largest)}) AS BIGINT)"
    step = f"greatest(1, CAST(trunc({real(largest)} / {bins}) AS BIGINT))"
    last = f"((({top}) - 1) // ({step})) * ({step})"
    return f"CASE WHEN {x} > 0 AND {x} <= {last} THEN CAST(ceil({real(x)} / ({step})) AS BIGINT) - 1 END"


def stats(column: str, prefix: str, digits: int, var_digits: int | None = None) -> str:
    """The six statistics of a column, rounded."""
    var_digits = digits if var_digits is None else var_digits
    c = real(column)
    return ", ".join(
        [
            f"{rounded(f'{real(f"sum({column})")} / count({column})', digits)} AS {prefix}_mean",
            f"{rounded(f'min({column})', digits)} AS {prefix}_min",
            f"{rounded(f'max({column})', digits)} AS {prefix}_max",
            f"{rounded(f'median({c})', digits)} AS {prefix}_median",
            f"{rounded(f'stddev_samp({c})', digits)} AS {prefix}_std",
            f"{rounded(f'var_samp({c})', var_digits)} AS {prefix}_var",
        ]
    )


def cross(columns: list[str]) -> str:
    """Joined text of columns, null if one of them is."""
    return " || '_' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)


_counters = ", ".join(
    f"{whole(f"count(*) FILTER (o_orderpriority = '{p}')")} AS {c}" for c, p in zip(COUNTERS, PRIORITIES)
)
_segments = "[" + ", ".join(f"'{s}'" for s in SEGMENTS) + "]"
WEEKEND = "dayofweek(use_date) IN (0, 6)"

PARTS = {
    "labelled": f"""SELECT c_custkey AS uid, {whole(f"list_position({_segments}, c_mktsegment)")} AS label
        FROM customer WHERE c_acctbal >= 0""",
    "unlabelled": "SELECT c_custkey AS uid FROM customer WHERE c_acctbal < 0",
    "usage": """SELECT o_custkey AS uid, l_partkey AS app, CAST(l_extendedprice AS DECIMAL(12,2)) AS duration,
        CAST(l_quantity AS BIGINT) AS times, CAST(o_orderdate AS DATE) AS use_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "month_log": """SELECT user_id AS uid, json_extract_string(props, '$.k') AS app, CAST(ts AS DATE) AS use_date,
        sum(CAST(value AS DECIMAL(12,2))) AS duration, count(*) AS times FROM events GROUP BY ALL""",
    "pairs": "SELECT DISTINCT uid, app FROM usage",
    "app_totals": f"""SELECT uid, app, count(use_date) AS days, sum(duration) AS duration,
        {whole("sum(times)")} AS times, {whole(f"count(*) FILTER ({WEEKEND})")} AS weekend_days,
        coalesce(sum(duration) FILTER ({WEEKEND}), 0) AS weekend_duration,
        {whole(f"coalesce(sum(times) FILTER ({WEEKEND}), 0)")} AS weekend_times FROM usage GROUP BY uid, app""",
    "day_totals": f"""SELECT uid, use_date, count(app) AS apps, sum(duration) AS duration,
        {whole("sum(times)")} AS times FROM usage GROUP BY uid, use_date""",
    "categories": "SELECT p_partkey AS app, p_type AS category FROM part",
    "app_category": "SELECT app, min(category) AS category FROM categories GROUP BY app",
    "categorised": """SELECT t.*, coalesce(category, 'unknown') AS category
        FROM app_totals t LEFT JOIN app_category USING (app)""",
    "installed": "SELECT DISTINCT uid, p_name AS app FROM usage JOIN part ON app = p_partkey",
    "attributes": f"""SELECT c_custkey AS uid, CAST(c_nationkey AS VARCHAR) AS city,
        {whole("CASE WHEN c_acctbal >= 5000 THEN 1 ELSE 0 END")} AS gender,
        o.* EXCLUDE (uid, traffic, boot_times, {", ".join(COUNTERS)}),
        {", ".join(f"coalesce({c}, 0) AS {c}" for c in ["boot_times", *COUNTERS])},
        coalesce(CAST(floor(traffic) AS BIGINT), 0) AS f_sum
        FROM (SELECT o_custkey AS uid, arg_max(o_orderpriority, o_orderkey) AS model,
          arg_min(o_orderstatus, o_orderkey) AS colour, arg_min(o_orderpriority, o_orderkey) AS network,
          arg_max(o_orderstatus, o_orderkey) AS carrier, month(min(o_orderdate)) AS font_size,
          month(max(o_orderdate)) AS ram_capacity, year(max(o_orderdate)) AS rom_capacity,
          year(min(o_orderdate)) AS os, count(*) AS boot_times, {_counters},
          {whole("count(*) FILTER (o_orderstatus = 'F')")} AS f_times,
          {real("sum(CAST(o_totalprice AS DECIMAL(12,2)))")} / 250000.0 AS traffic
          FROM orders GROUP BY o_custkey) o RIGHT JOIN customer ON c_custkey = o.uid""",
    "labelled_attributes": "SELECT * FROM attributes JOIN labelled USING (uid)",
}
NEEDS = {
    "pairs": ["usage"],
    "app_totals": ["usage"],
    "day_totals": ["usage"],
    "app_category": ["categories"],
    "categorised": ["app_totals", "app_category"],
    "installed": ["usage"],
    "labelled_attributes": ["attributes", "labelled"],
}


def with_parts(body: str, *names: str, **extra: str) -> str:
    """SQL with the named shared parts, and extra ones, in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({PARTS[n]})" for n in order] + [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
