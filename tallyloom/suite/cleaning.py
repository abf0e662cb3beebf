"""Queries of the cleaning and attribute operators."""

from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import attributes, clean, stats, usage
from tallyloom.operators.sequence import copies_by_duration
from tallyloom.sources import tables
from tallyloom.sources.roles import COUNTERS, CROSSES
from tallyloom.sources.stage import stage_path
from tallyloom.suite.registry import cross, binned, query, real, rounded, whole, with_parts

SPEND_CUTS = [27000, 53000, 80000]  # near the quartiles of the spend per customer and part


@query(
    "clamp_negative",
    "SELECT c_custkey AS uid, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance FROM customer",
)
def clamp_negative(r):
    rows = r.table("customer").select(F.col("c_custkey").alias("uid"), F.col("c_acctbal").alias("balance"))
    return clean.clamp_negative(rows, ["balance"])


_holes = """SELECT p_partkey, nullif(p_size, 7) AS size, nullif(p_type, 'SMALL') AS type,
    nullif(p_brand, 'Brand#3') AS brand FROM part"""


def _mode(c):
    return f"(SELECT {c} FROM holes WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "mode_impute",
    with_parts(
        "SELECT p_partkey, " + ", ".join(f"coalesce({c}, {_mode(c)}) AS {c}" for c in ("size", "type", "brand"))
        + " FROM holes",
        holes=_holes,
    ),
)
def mode_impute(r):
    holes = r.table("part").select(
        "p_partkey",
        F.nullif("p_size", F.lit(7)).alias("size"),
        F.nullif("p_type", F.lit("SMALL")).alias("type"),
        F.nullif("p_brand", F.lit("Brand#3")).alias("brand"),
    )
    return clean.mode_impute(holes, ["size", "type", "brand"])


@query(
    "forward_fill_category",
    with_parts(
        """SELECT uid, app, coalesce(category, 'unknown') AS category,
        coalesce(last_value(category IGNORE NULLS) OVER
          (PARTITION BY uid ORDER BY app ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'unknown') AS filled
        FROM pairs LEFT JOIN (SELECT app, category FROM categories WHERE category <> 'SMALL') USING (app)""",
        "pairs",
        "categories",
    ),
)
def forward_fill_category(r):
    known = r.categories().where(F.col("category") != "SMALL")
    rows = r.usage().select("uid", "app").distinct().join(known, "app", "left")
    rows = clean.forward_fill_category(rows, ["uid"], ["app"], "category", "filled")
    return clean.fill_category(rows).select("uid", "app", "category", "filled")


@query(
    "sanitize_non_finite",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_tax = 0 THEN 0.0
    ELSE {rounded("l_discount / l_tax", 6)} END AS ratio FROM lineitem""",
)
def sanitize_non_finite(r):
    ratio = F.when(
        F.col("l_tax") == 0, F.when(F.col("l_discount") > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    ).otherwise(F.try_divide("l_discount", "l_tax"))
    rows = r.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", round_even(ratio, 6).alias("ratio")
    )
    return clean.sanitize_non_finite(rows, ["ratio"])


def _fit(c, kind):
    lo, hi = f"min({c})", f"max({c})"
    if kind == "real":
        return "'float'"
    return (
        f"CASE WHEN {lo} >= -128 AND {hi} < 128 THEN 'tinyint' WHEN {lo} >= -32768 AND {hi} < 32768 THEN 'smallint' "
        f"WHEN {lo} >= -2147483648 AND {hi} < 2147483648 THEN 'int' ELSE 'bigint' END"
    )


_line_columns = {
    "l_orderkey": "whole",
    "l_partkey": "whole",
    "l_suppkey": "whole",
    "l_linenumber": "whole",
    "l_quantity": "real",
    "l_extendedprice": "real",
    "l_discount": "real",
    "l_tax": "real",
}


@query(
    "narrow_schema",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {real(f"min({c})")} AS lowest, {real(f"max({c})")} AS highest,
        {_fit(c, kind)} AS type FROM lineitem"""
        for c, kind in _line_columns.items()
    ),
)
def narrow_schema(r):
    return clean.type_report(r.table("lineitem"))


_types = " || ', ' || ".join(f"(SELECT min('{c} ' || t) FROM (SELECT {_fit(c, kind)} AS t FROM lineitem))" for c, kind in _line_columns.items())


@query(
    "narrow_frame",
    "SELECT "
    + ", ".join(c if kind == "whole" else real(f"CAST({c} AS FLOAT)") + f" AS {c}" for c, kind in _line_columns.items())
    + f", {_types} AS types FROM lineitem",
)
def narrow_frame(r):
    """The narrowed table, written and read back by its own schema, with the types it has."""
    path = stage_path(r.spark, "narrow")
    tables.write_table(clean.narrow_schema(r.table("lineitem").select(*_line_columns)), path)
    read = tables.read_table(r.spark, path)
    types = ", ".join(f"{c} {t}" for c, t in read.dtypes)
    wide = [F.col(c).cast("long" if _line_columns[c] == "whole" else "double").alias(c) for c in read.columns]
    return read.select(*wide, F.lit(types).alias("types"))


@query(
    "duration_bucket",
    with_parts(
        """SELECT uid, app, CAST(CASE WHEN duration < 27000 THEN 1 WHEN duration < 53000 THEN 2
        WHEN duration < 80000 THEN 3 ELSE 4 END AS BIGINT) AS copies FROM app_totals""",
        "app_totals",
    ),
)
def duration_bucket(r):
    return copies_by_duration(usage.app_totals(r.usage()), SPEND_CUTS)


@query(
    "equal_width_bin",
    with_parts(
        f"""SELECT uid, duration, times, {binned("duration", "(SELECT max(duration) FROM t)", 10000)} AS duration_bin,
        {binned("times", "(SELECT max(times) FROM t)", 1000)} AS times_bin FROM t""",
        "usage",
        t=f"""SELECT uid, {real("sum(duration)")} AS duration, {real("sum(times)")} AS times
        FROM usage GROUP BY uid""",
    ),
)
def equal_width_bin(r):
    totals = r.usage().groupBy("uid").agg(
        F.sum("duration").cast("double").alias("duration"), F.sum("times").cast("double").alias("times")
    )
    return stats.equal_width_bins(totals, {"duration_bin": ("duration", 10000), "times_bin": ("times", 1000)})


@query(
    "cross_feature",
    with_parts(
        "SELECT uid, " + ", ".join(f"{cross(c)} AS {n}" for n, c in CROSSES.items())
        + " FROM attributes",
        "attributes",
    ),
)
def cross_feature(r):
    return attributes.cross_feature(r.attributes(), CROSSES).select("uid", *CROSSES)


_a, _b, _c, _d, _e, _f = COUNTERS


@query(
    "behaviour_arithmetic",
    with_parts(
        f"""SELECT uid, boot_times, f_sum, {", ".join(f"{c} * 10 AS {c}" for c in COUNTERS)},
        {rounded("boot_times / 30.0", 6)} AS average_boot_times, {rounded("f_sum / 30.0", 6)} AS average_f_sum,
        boot_times * boot_times AS square_boot_times,
        {rounded(f"({real('boot_times')} / 30.0) * ({real('boot_times')} / 30.0)", 6)} AS square_average_boot_times,
        {", ".join(f"{c} * {c} * 100 AS square_{c}" for c in COUNTERS)},
        10 * ({" + ".join(COUNTERS)}) AS behaviour_sum,
        100 * ({_b} + {_c}) * ({_b} + {_c}) AS first_pair_squared,
        100 * ({_d} + {_e}) * ({_d} + {_e}) AS second_pair_squared FROM attributes""",
        "attributes",
    ),
)
def behaviour_arithmetic(r):
    rows = r.attributes().select("uid", "boot_times", "f_sum", *COUNTERS)
    out = attributes.behaviour_arithmetic(rows, "boot_times", "f_sum", COUNTERS)
    averages = [c for c in out.columns if "average" in c]
    return out.withColumns({c: round_even(F.col(c), 6) for c in averages})


@query(
    "capacity_left_used",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {rounded("l_quantity * l_discount", 4)} AS ram_left,
    {rounded("l_quantity - l_quantity * l_discount", 4)} AS ram_used,
    {rounded("l_extendedprice * l_tax", 3)} AS rom_left,
    {rounded("l_extendedprice - l_extendedprice * l_tax", 3)} AS rom_used FROM lineitem""",
)
def capacity_left_used(r):
    rows = attributes.capacity_left_used(
        r.table("lineitem"), {"ram": ("l_quantity", "l_discount"), "rom": ("l_extendedprice", "l_tax")}
    )
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        *[round_even(F.col(c), 4).alias(c) for c in ("ram_left", "ram_used")],
        *[round_even(F.col(c), 3).alias(c) for c in ("rom_left", "rom_used")],
    )
