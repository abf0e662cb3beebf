"""Boosted trees over the user attributes; SQL restates one whole round."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import boosting
from tallyloom.sources.roles import CLASSES
from tallyloom.suite.bayes import FEATURES, FOLDS, _cells, _rows, _training, _unlabelled, _whole_label, _wide, _wide_sql
from tallyloom.suite.registry import query, rounded, whole, with_parts

K, BINS, LEAST = len(CLASSES), 16, 20
ONE_ROUND = boosting.Settings(classes=K, folds=FOLDS, rounds=1, depth=2, bins=BINS, min_leaf=LEAST)
SEVERAL = boosting.Settings(classes=K, folds=FOLDS, rounds=6, depth=3, bins=BINS, min_leaf=LEAST, rate=0.3, patience=2)

_lists = {f: f"[{', '.join(f'{f}(CAST({c} AS DOUBLE))' for c in FEATURES)}]" for f in ("min", "max")}
_values = f"[{', '.join(f'CAST({c} AS DOUBLE)' for c in FEATURES)}]"
_ends = f"SELECT {_lists['min']} AS low, {_lists['max']} AS high FROM r"
_bins = f"""SELECT uid, CAST(label AS BIGINT) AS label, fold, unnest(range({len(FEATURES)})) AS feature, unnest(list_transform(v, lambda x, i: CASE
    WHEN low[i] = high[i] THEN 0 ELSE greatest(0, least({BINS - 1}, CAST(floor((x - low[i]) / (high[i] - low[i]) * {float(BINS)}) AS BIGINT))) END)) AS bin
    FROM (SELECT *, {_values} AS v FROM r), e"""
_share = f"(CAST(1 AS DOUBLE) / {K})"
# gradients at the start, where every class has the same share
_cells0 = f"""SELECT uid, fold, m, k, CAST(round(({_share} - CASE WHEN label = k THEN 1 ELSE 0 END) * 16777216) AS BIGINT) AS g,
    CAST(round({_share} * (1 - {_share}) * 16777216) AS BIGINT) AS h
    FROM (SELECT uid, fold, CAST(label AS BIGINT) AS label FROM r), (SELECT unnest(range({FOLDS})) AS m), (SELECT unnest(range({K})) AS k)"""


def _splits(rows: str) -> str:
    """The best split of each (m, k, node) of rows (m, k, node, feature, bin, g, h)."""
    quality = lambda g, h: f"(({g}) / 16777216.0::DOUBLE) * (({g}) / 16777216.0::DOUBLE) / (({h}) / 16777216.0::DOUBLE + 1.0::DOUBLE)"
    gain = f"{quality('lg', 'lh')} + {quality('tg - lg', 'th - lh')} - {quality('tg', 'th')}"
    return f"""SELECT m, k, node, any_value(tg) AS g, any_value(th) AS h, any_value(tn) AS n,
        min({{'less': -gain, 'feature': feature, 'bin': bin, 'gain': gain, 'lg': lg, 'lh': lh, 'ln': ln}}) FILTER (gain > 0 AND ln >= {LEAST} AND tn - ln >= {LEAST}) AS s
        FROM (SELECT *, {gain} AS gain FROM (SELECT m, k, node, feature, bin,
            CAST(sum(g) OVER f AS DOUBLE) AS tg, CAST(sum(h) OVER f AS DOUBLE) AS th, CAST(sum(n) OVER f AS BIGINT) AS tn,
            CAST(sum(g) OVER u AS DOUBLE) AS lg, CAST(sum(h) OVER u AS DOUBLE) AS lh, CAST(sum(n) OVER u AS BIGINT) AS ln
            FROM (SELECT m, k, node, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {rows} GROUP BY ALL)
            WINDOW f AS (PARTITION BY m, k, node, feature), u AS (PARTITION BY m, k, node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING)))
        GROUP BY m, k, node"""


_below = "SELECT m, k, 2 * node + {side} AS node, {g} AS g, {h} AS h, {n} AS n, NULL AS s FROM s1 WHERE s IS NOT NULL"
_left = _below.format(side=1, g="s.lg", h="s.lh", n="s.ln")
_right = _below.format(side=2, g="g - s.lg", h="h - s.lh", n="n - s.ln")
_parts = {
    "r": _rows, "e": _ends, "b": _bins, "c": _cells0,
    "t0": "SELECT c.m, c.k, 0 AS node, b.feature, b.bin, c.g, c.h FROM c JOIN b USING (uid) WHERE c.fold <> c.m",
    "s0": _splits("t0"),
    # where every row stands after one level, training or not
    "p1": "SELECT c.uid, c.fold, c.m, c.k, c.g, c.h, CASE WHEN s IS NULL THEN 0 WHEN b.bin > s.bin THEN 2 ELSE 1 END AS node FROM c JOIN s0 USING (m, k) LEFT JOIN b ON b.uid = c.uid AND b.feature = s.feature",
    "t1": "SELECT p1.m, p1.k, p1.node, b.feature, b.bin, p1.g, p1.h FROM p1 JOIN b USING (uid) WHERE p1.fold <> p1.m AND p1.node > 0",
    "s1": _splits("t1"),
    "nodes": f"""SELECT m AS fold, CAST(0 AS BIGINT) AS round, k AS class, CAST(node AS BIGINT) AS node, CAST(s.feature AS BIGINT) AS feature, CAST(s.bin AS BIGINT) AS bin, s.gain AS gain, n,
        CASE WHEN s IS NULL THEN -{ONE_ROUND.rate}::DOUBLE * (g / 16777216.0::DOUBLE) / (h / 16777216.0::DOUBLE + 1.0::DOUBLE) END AS value
        FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL {_left} UNION ALL {_right})""",
}


def _sql(body: str, **extra: str) -> str:
    return with_parts(body, "attributes", "labelled", **_parts, **extra)


def _fitted(r, settings: boosting.Settings) -> tuple[DataFrame, boosting.Boosted]:
    return boosting.boosted_folds(_training(r), settings)


@query(
    "boosted_nodes",
    _sql(f"SELECT fold, round, class, node, feature, bin, {rounded('gain', 6)} AS gain, n, {rounded('value', 6)} AS value FROM nodes"),
)
def boosted_nodes(r):
    """The trees of the first round: all folds and classes."""
    nodes = _fitted(r, ONE_ROUND)[1].table(r.spark)
    return nodes.withColumns({c: round_even(F.col(c), 6) for c in ("gain", "value")})


@query(
    "boosted_importance",
    _sql(f"""SELECT feature, splits, {rounded('gain', 6)} AS gain, row_number() OVER (ORDER BY splits DESC, feature) AS place
        FROM (SELECT f.feature, count(n.feature) AS splits, coalesce(sum(gain), 0) AS gain
        FROM (SELECT unnest(range({len(FEATURES)})) AS feature) f LEFT JOIN nodes n USING (feature) GROUP BY f.feature)"""),
)
def boosted_importance(r):
    """Splits and gain of each feature in the trees of the first round."""
    found = boosting.importance(_fitted(r, ONE_ROUND)[1].table(r.spark), len(FEATURES))
    return found.withColumn("gain", round_even(F.col("gain"), 6))


@query(
    "boosted_round_scores",
    _sql(
        f"SELECT uid, {whole('label')} AS label, fold, {_cells} FROM w JOIN (SELECT uid, label, fold FROM r) USING (uid)",
        p2="""SELECT p1.uid, p1.k, CASE WHEN s IS NULL THEN p1.node WHEN b.bin > s.bin THEN 2 * p1.node + 2 ELSE 2 * p1.node + 1 END AS node, p1.m
            FROM p1 LEFT JOIN s1 USING (m, k, node) LEFT JOIN b ON b.uid = p1.uid AND b.feature = s.feature WHERE p1.fold = p1.m""",
        x="SELECT p2.uid, p2.k AS label, exp(n.value) AS e FROM p2 JOIN nodes n ON n.fold = p2.m AND n.class = p2.k AND n.node = p2.node",
        s="SELECT uid, label, e / sum(e) OVER (PARTITION BY uid) AS p FROM x",
        w=_wide_sql("s"),
    ),
)
def boosted_round_scores(r):
    """Out-of-fold scores after the first round."""
    return _wide(_whole_label(_fitted(r, ONE_ROUND)[0]), "label", "fold")


@query("oof_boosted")
def oof_boosted(r):
    """Out-of-fold scores of several rounds; a plain-Python version is in the tests."""
    return _wide(_whole_label(_fitted(r, SEVERAL)[0]), "label", "fold")


@query("boosted_mean_scores")
def boosted_mean_scores(r):
    """Users without a label, by the mean of the fold models."""
    return _wide(_fitted(r, SEVERAL)[1].mean_scores(_unlabelled(r)))
