"""Queries of wide tables, vectors and meta features."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import assemble, categories, priors, ranking, usage
from tallyloom.operators.text import token_slots, with_slots
from tallyloom.sources.roles import CLASSES, COUNTERS, PART_TYPES
from tallyloom.suite import priors as prior_queries
from tallyloom.suite import texts as text_queries
from tallyloom.suite import usage as usage_queries
from tallyloom.suite.registry import SQL, query, real, with_parts



@query(
    "feature_assembly",
    with_parts(
        "SELECT p.uid, p.* EXCLUDE (uid), v.* EXCLUDE (uid), c.* EXCLUDE (uid), n.categories, t.* EXCLUDE (uid), "
        "coalesce(f.frequent_apps, 0) AS frequent_apps FROM p "
        "LEFT JOIN v USING (uid) LEFT JOIN c USING (uid) LEFT JOIN n USING (uid) LEFT JOIN t USING (uid) "
        "LEFT JOIN f USING (uid)",
        p=SQL["user_usage_averages"],
        v=SQL["daily_var_pop"],
        c=SQL["category_duration_times"],
        n=SQL["user_category_nunique"],
        t=SQL["top2_by_duration"],
        f=with_parts(
            "SELECT uid, count(*) AS frequent_apps FROM app_totals WHERE days >= 2 GROUP BY uid", "app_totals"
        ),
    ),
)
def feature_assembly(r):
    daily = r.kept("daily", lambda: usage.daily_totals(r.usage()))
    apps, by_day = r.kept("apps", lambda: usage.app_totals_of(daily)), usage.day_totals_of(daily)
    categorised = categories.with_category(apps, r.categories())
    profile = usage.profile(apps, 30, *usage.calendar(daily))
    return assemble.assemble(
        profile.select("uid", *usage_queries.ALL_COLUMNS),
        [
            usage.daily_variance(by_day),
            categories.category_usage(categorised, PART_TYPES),
            categories.category_nunique(categorised),
            ranking.leading_apps(apps, "duration", r.categories()),
            usage.frequent_app_count(apps, 2),
        ],
    )


_scores = {
    "city": ("city", 3),
    "model": ("model", 3),
    "boot": ("boot_times", 3),
}


def _score_rows(r) -> DataFrame:
    """Three models whose scores are the class shares of an attribute."""
    users = r.labelled_attributes()
    parts = []
    for name, (attribute, digits) in _scores.items():
        prior = priors.label_prior(users, [attribute], CLASSES, digits, support=40)
        scores = F.array(*[F.col(f"share_{k}") for k in CLASSES]).alias("scores")
        table = prior.select(attribute, scores)
        parts.append(r.attributes().join(table, attribute).select("uid", F.lit(name).alias("model"), "scores"))
    return reduce(DataFrame.unionByName, parts)


_score_parts = {
    f"{n}_s": f"""SELECT uid, {", ".join(f"share_{k} AS {n}_{k - 1}" for k in CLASSES)} FROM attributes
    JOIN ({prior_queries._prior(a, "labelled_attributes", d, "count(label) >= 40")}) USING ({a})"""
    for n, (a, d) in _scores.items()
}
_score_cells = [f"{n}_{k - 1}" for n in _scores for k in CLASSES]


@query(
    "stack_meta_features",
    with_parts(
        f"SELECT uid, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _score_cells)} FROM attributes "
        + " ".join(f"LEFT JOIN {n}_s USING (uid)" for n in _scores),
        "labelled_attributes",
        **_score_parts,
    ),
)
def stack_meta_features(r):
    meta = assemble.meta_features(_score_rows(r), list(_scores), len(CLASSES))
    return assemble.meta_for_all(r.attributes(), meta)


@query(
    "stack_meta_features_inner",
    with_parts(
        f"SELECT uid, {', '.join(_score_cells)} FROM attributes "
        + " ".join(f"JOIN {n}_s USING (uid)" for n in _scores),
        "labelled_attributes",
        **_score_parts,
    ),
)
def stack_meta_features_inner(r):
    meta = assemble.meta_features(_score_rows(r), list(_scores), len(CLASSES))
    return assemble.meta_for_scored(r.attributes(), meta)


_stacked = ["boot_times", *COUNTERS, "f_sum"]


@query(
    "vector_hstack",
    with_parts(
        " UNION ALL ".join(
            f"SELECT uid, CAST({i} AS BIGINT) AS slot, {real(c)} AS value FROM attributes WHERE {c} <> 0"
            for i, c in enumerate(_stacked)
        )
        + " UNION ALL "
        + " UNION ALL ".join(
            f"""SELECT uid, CAST({i + len(_stacked)} AS BIGINT) AS slot, {real(f'"n_{v}"')} AS value
            FROM c JOIN attributes USING (uid) WHERE "n_{v}" <> 0"""
            for i, v in enumerate(PART_TYPES)
        ),
        "attributes",
        c=SQL["category_counts"],
    ),
)
def vector_hstack(r):
    base = assemble.to_vector(r.attributes(), _stacked, "base")
    categorised = categories.with_category(usage.app_totals(r.usage()), r.categories())
    counts = categories.category_counts(categorised, PART_TYPES)
    block = assemble.to_vector(counts, [f"n_{v}" for v in PART_TYPES], "counts")
    return assemble.vector_rows(assemble.hstack({"base": base, "counts": block}))


@query(
    "sparse_block",
    with_parts(
        """SELECT doc AS uid, dense_rank() OVER (ORDER BY token) - 1 AS slot, weight AS value FROM t WHERE weight <> 0""",
        t=SQL["tfidf_category"],
    ),
)
def sparse_block(r):
    """TF-IDF rows written as sparse vectors and read back."""
    weights = text_queries.tfidf_category(r)
    slots = token_slots(weights)
    rows = with_slots(weights, slots).select(F.col("doc").alias("uid"), "slot", F.col("weight").alias("value"))
    return assemble.vector_rows(assemble.sparse_block(rows, r.users(), slots.count()))
