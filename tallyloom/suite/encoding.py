"""Queries of codes, flags and scales."""

from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import attributes, encode
from tallyloom.sources.roles import ATTRIBUTES, COUNTERS, CROSSES, PRIORITIES
from tallyloom.suite import priors as prior_queries
from tallyloom.suite.registry import cross, query, rounded, whole, with_parts

_CODED = [*ATTRIBUTES, *CROSSES]


@query(
    "ordinal_encode",
    with_parts(
        "SELECT uid, " + ", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}_code" for c in _CODED) + " FROM crossed",
        "attributes",
        crossed="SELECT *, "
        + ", ".join(f"{cross(c)} AS {n}" for n, c in CROSSES.items())
        + " FROM attributes",
    ),
)
def ordinal_encode(r):
    rows = attributes.cross_feature(r.attributes(), CROSSES)
    return encode.ordinal_encode(rows, _CODED).select("uid", *[f"{c}_code" for c in _CODED])


_FLAGS = {"gender": [0, 1], "network": PRIORITIES, "carrier": ["F", "O", "P"]}


@query(
    "one_hot",
    with_parts(
        "SELECT uid, "
        + ", ".join(
            whole(f"CASE WHEN {c} = {v!r} THEN 1 ELSE 0 END") + f' AS "{c}_{v}"' for c, vs in _FLAGS.items() for v in vs
        )
        + " FROM attributes",
        "attributes",
    ),
)
def one_hot(r):
    out = encode.one_hot(r.attributes(), _FLAGS)
    return out.select("uid", *[f"{c}_{v}" for c, vs in _FLAGS.items() for v in vs])


@query(
    "one_hot_selected",
    with_parts(
        """SELECT uid, model_colour_font, coalesce(slot, 0) AS model_colour_font_slot FROM
        (SELECT uid, model || '_' || colour || '_' || CAST(font_size AS VARCHAR) AS model_colour_font FROM attributes)
        LEFT JOIN (SELECT model_colour_font, row_number() OVER (ORDER BY model_colour_font) AS slot FROM s)
        USING (model_colour_font)""",
        "labelled_attributes",
        crossed=prior_queries._crossed,
        p=prior_queries._cross_prior,
        s=prior_queries._selected,
    ),
)
def one_hot_selected(r):
    selected = prior_queries.select_dominant_values(r)
    rows = attributes.cross_feature(r.attributes(), CROSSES).select("uid", "model_colour_font")
    return encode.one_hot_selected(rows, "model_colour_font", selected)


_SCALED = ["boot_times", *COUNTERS, "f_sum"]


@query(
    "minmax_scale",
    with_parts(
        "SELECT uid, 0.0::DOUBLE AS fixed, "
        + ", ".join(
            rounded(f"({c} - (SELECT min({c}) FROM attributes)) / (SELECT max({c}) - min({c}) FROM attributes)", 6)
            + f" AS {c}"
            for c in _SCALED
        )
        + " FROM attributes",
        "attributes",
    ),
)
def minmax_scale(r):
    rows = r.attributes().select("uid", *_SCALED).withColumn("fixed", F.lit(5.0))
    out = encode.minmax_scale(rows, [*_SCALED, "fixed"])
    return out.withColumns({c: round_even(F.col(c), 6) for c in _SCALED})
