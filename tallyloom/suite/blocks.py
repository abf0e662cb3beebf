"""The attribute block in three variants, and the flags of selected crosses, each with its SQL."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import assemble, stats
from tallyloom.plans import blocks
from tallyloom.sources import tables
from tallyloom.sources.roles import ATTRIBUTES, CLASSES, COUNTERS, CROSSES, PART_TYPES, PRIORITIES
from tallyloom.sources.stage import stage_path
from tallyloom.suite.learning import _RULES, _SUPPORT
from tallyloom.suite.priors import BASE, SHARES, _crossed, _owned, _prior, _rollup_cells, _weight, _weight_mean
from tallyloom.suite.registry import cross, query, real, rounded, whole, with_parts
from tallyloom.suite.registry import stats as stats_sql

# Columns of the attribute table that users without orders lack.
_HOLES = ["model", "colour", "network", "carrier", "font_size", "rom_capacity", "ram_capacity", "os", "city"]
_NUMBERS = ["font_size", "ram_capacity", "rom_capacity", "os", "gender", "boot_times", "f_sum"]
_FLAGS = {"network": PRIORITIES, "carrier": ["F", "O", "P"]}
# The share left of a capacity comes from two counters.
_ROOM = {"ram": ("ram_capacity", "ram_left_ratio"), "rom": ("rom_capacity", "rom_left_ratio")}
_RATIOS = {"ram_left_ratio": "a_times", "rom_left_ratio": "b_times"}
_cells = [f"{c}_{k}" for k in CLASSES for c in ("n", "share")]


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM attributes WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _block_sql(known: list[str], crosses: dict, flags: dict, room: dict) -> str:
    """The block over the priors of the attributes `known`, crosses, flags and capacities."""
    holes = [c for c in _HOLES if c in known or c in flags]
    filled = ", ".join(f"coalesce({c}, {_mode(c)}) AS {c}" for c in holes)
    ratios = "".join(f", CAST({c} AS DOUBLE) / greatest(boot_times, 1) AS {n}" for n, c in _RATIOS.items())
    left = "".join(f", {c} * {q} AS {n}_left" for n, (c, q) in room.items())
    used = "".join(f", {c} - {n}_left AS {n}_used" for n, (c, _) in room.items())
    crossed = "".join(f", {cross(c)} AS {n}" for n, c in crosses.items())
    long = lambda names: " UNION ALL ".join(f"SELECT label, '{a}' AS attr, CAST({a} AS VARCHAR) AS value FROM seen" for a in names)
    rooms = [f"{n}_{part}" for n in room for part in ("left", "used")]
    shares = [f"coalesce({a}_p.{c}, 0) AS {a}_{c}" for a in [*known, *crosses] for c in _cells]
    joins = [
        f"LEFT JOIN {table} {a}_p ON {a}_p.attr = '{a}' AND {a}_p.value = CAST(t.{a} AS VARCHAR)"
        for table, names in (("p", known), ("px", crosses))
        for a in names
    ]
    b, c, d, e = COUNTERS[1:5]
    parts = [
        "t.uid", *[f"coalesce({n}, 0) AS {n}" for n in _NUMBERS], *[f"{n} * 10 AS {n}" for n in COUNTERS],
        *[f"{rounded(n, 6)} AS {n}" for n in [*_RATIOS, *rooms]],
        *[f"dense_rank() OVER (ORDER BY t.{n}) - 1 AS {n}_code" for n in [*known, *crosses, *rooms]],
        *[whole(f"CASE WHEN {n} = '{v}' THEN 1 ELSE 0 END") + f' AS "{n}_{v}"' for n, values in flags.items() for v in values],
        *shares,
        f"{rounded('boot_times / 30.0::DOUBLE', 6)} AS average_boot_times", f"{rounded('f_sum / 30.0::DOUBLE', 6)} AS average_f_sum",
        "boot_times * boot_times AS square_boot_times",
        f"{rounded(f'({real('boot_times')} / 30.0) * ({real('boot_times')} / 30.0)', 6)} AS square_average_boot_times",
        *[f"{n} * {n} * 100 AS square_{n}" for n in COUNTERS], f"10 * ({' + '.join(COUNTERS)}) AS behaviour_sum",
        f"100 * ({b} + {c}) * ({b} + {c}) AS first_pair_squared", f"100 * ({d} + {e}) * ({d} + {e}) AS second_pair_squared",
    ]
    extra = {
        "i": f"SELECT * REPLACE ({filled}){ratios} FROM attributes" if holes else f"SELECT *{ratios} FROM attributes",
        "l": f"SELECT *{left} FROM i", "u": f"SELECT *{used} FROM l", "t": f"SELECT *{crossed} FROM u",
        "seen": "SELECT * FROM t JOIN labelled USING (uid)", "a": long(known), "p": _prior("attr, value", "a", 3),
    }
    if crosses:
        extra |= {"x": long(crosses), "px": _prior("attr, value", "x", 2)}
    return with_parts(f"SELECT {', '.join(parts)} FROM t {' '.join(joins)}", "attributes", "labelled", **extra)


def _block(r, known: list[str], crosses: dict, flags: dict, room: dict) -> DataFrame:
    users = r.attributes()
    once = F.greatest(F.col("boot_times"), F.lit(1))
    users = users.withColumns({n: F.col(c).cast("double") / once for n, c in _RATIOS.items()})
    block = blocks.base_block(users, r.labelled(), CLASSES, known, COUNTERS, crosses, flags, capacities=room)
    return block.withColumns({c: round_even(F.col(c), 6) for c, t in block.dtypes if t == "double"})


_DEVICE = ["model", "colour", "font_size", "rom_capacity", "ram_capacity", "os"]
_VARIANTS = {
    "base_block": (ATTRIBUTES, CROSSES, _FLAGS, _ROOM),
    "base_block_device": (_DEVICE, {n: CROSSES[n] for n in ("model_colour_font", "memory_storage_system")}, {}, _ROOM),
    "base_block_behaviour": (["city", "boot_times", *COUNTERS, "f_sum"], {}, _FLAGS, {}),
}


def _register(name: str) -> None:
    @query(name, _block_sql(*_VARIANTS[name]))
    def build(r):
        return _block(r, *_VARIANTS[name])


for _name in _VARIANTS:
    _register(_name)


def _flags_sql() -> str:
    parts = {"crossed": _crossed, "c": "SELECT uid, " + ", ".join(f"{cross(c)} AS {n}" for n, c in CROSSES.items()) + " FROM attributes"}
    rows = []
    for n, (shares, support, enough) in _RULES.items():
        leaning = " OR ".join(f"share_{k} >= {t}" for k, t in zip(CLASSES, shares))
        more = "" if enough is None else f" OR total > {enough}"
        parts[f"p_{n}"] = _prior(n, "crossed", 2)
        parts[f"s_{n}"] = f"SELECT {n}, row_number() OVER (ORDER BY {n}) - 1 AS slot FROM p_{n} WHERE {n} IS NOT NULL AND ((({leaning}) AND total > {support}){more})"
        rows.append(f"SELECT '{n}' AS name, uid, slot, 1.0::DOUBLE AS value FROM c JOIN s_{n} USING ({n})")
    return with_parts(" UNION ALL ".join(rows), "labelled_attributes", **parts)


@query("selected_flags", _flags_sql())
def selected_flags(r):
    """The flags of all three crosses: an encoder fitted on the labelled users, saved, read and applied to all."""
    path = stage_path(r.spark, "encoder")
    tables.write_table(blocks.fit_flags(r.attributes(), r.labelled(), CLASSES, CROSSES, _RULES), path)
    found = blocks.apply_flags(r.attributes(), CROSSES, tables.read_table(r.spark, path))
    parts = [
        assemble.vector_rows(block, name).select(F.lit(name.removesuffix("_flags")).alias("name"), "uid", "slot", "value")
        for name, block in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _installed_sql() -> str:
    exact = ", ".join(f"CAST(share_{k} AS DECIMAL(10,4)) AS share_{k}, n_{k}" for k in CLASSES)
    listed = " + ".join(f'"n_{v}"' for v in PART_TYPES)
    rolled = [f"{c}_{k}_{s}" for k in CLASSES for c, more in (("share", ("mean_sq",)), ("n", ())) for s in (*stats.STATS, *more)]
    weights = [f"weight_{s}" for s in (*stats.STATS, "mean_sq")]
    cells = [
        "uid", "apps", "ratio", *[f"typical_{k}" for k in CLASSES], *[f'"n_{v}"' for v in PART_TYPES], "n_listed",
        *[f'"share_{v}"' for v in PART_TYPES], "categories",
        *[f"coalesce({w}, 0) AS {w}" for w in weights], *[f"coalesce({c}, 0) AS app_{c}" for c in rolled],
    ]
    return with_parts(
        f"SELECT {', '.join(cells)} FROM i JOIN ty USING (uid) JOIN sh USING (uid) JOIN w USING (uid) JOIN ro USING (uid)",
        "installed", "labelled",
        owned=_owned, coarse=_prior("app", "owned", 2), fine=_prior("app", "owned", 4, f"count(label) >= {_SUPPORT}"),
        i=f"SELECT uid, count(*) AS apps, {rounded('count(*) / (SELECT count(DISTINCT app) FROM installed)', 6)} AS ratio FROM installed GROUP BY uid",
        ty="SELECT uid, " + ", ".join(f"{whole(f'count(*) FILTER (share_{k} >= {t})')} AS typical_{k}" for k, t in zip(CLASSES, SHARES))
        + " FROM installed LEFT JOIN coarse USING (app) GROUP BY uid",
        # the first category of a name by place
        first="SELECT p_name AS app, arg_min(p_type, p_partkey) AS category FROM part GROUP BY p_name",
        ca="SELECT uid, coalesce(category, 'unknown') AS category FROM installed LEFT JOIN first USING (app)",
        co="SELECT uid, count(DISTINCT category) AS categories, " + ", ".join(f"count(*) FILTER (category = '{v}') AS \"n_{v}\"" for v in PART_TYPES)
        + " FROM ca GROUP BY uid",
        sh=f"SELECT *, {listed} AS n_listed, " + ", ".join(f'coalesce({rounded(f"{chr(34)}n_{v}{chr(34)} / nullif({listed}, 0)", 6)}, 0) AS "share_{v}"' for v in PART_TYPES) + " FROM co",
        w=f"""SELECT uid, {stats_sql("weight", "weight", 4)}, {rounded(f"{_weight_mean} * {_weight_mean}", 3)} AS weight_mean_sq
            FROM installed LEFT JOIN (SELECT app, CAST({rounded(_weight, 6)} AS DECIMAL(18,6)) AS weight FROM coarse) USING (app) GROUP BY uid""",
        ro=f"SELECT uid, {_rollup_cells()} FROM installed LEFT JOIN (SELECT app, {exact} FROM fine) USING (app) GROUP BY uid",
    )


@query("installed_block", _installed_sql())
def installed_block(r):
    """All features of the installed apps, rounded as the queries of its parts are."""
    pairs, names = r.installed_pairs(), r.name_categories()
    out = blocks.installed_block(pairs, names, r.labelled(), CLASSES, PART_TYPES, support=_SUPPORT, shares=SHARES, base=BASE, order="place")
    out = out.withColumns({c: round_even(F.col(c), 6) for c in ["ratio", *[f"share_{v}" for v in PART_TYPES]]})
    out = out.withColumn("weight_mean_sq", round_even(F.col("weight_mean_sq"), 3))
    squares = out.select("uid", "weight_mean_sq")
    out = stats.round_stats(out.drop("weight_mean_sq"), "weight", 4).join(squares, "uid")
    for k in CLASSES:
        out = stats.round_stats(out, f"app_share_{k}", 6, 4)
    return out
