"""Queries of the final labels, on scores that SQL can make as well."""

from pyspark.sql import functions as F

from tallyloom.operators import population, priors, route
from tallyloom.sources.roles import CLASSES
from tallyloom.suite import priors as prior_queries
from tallyloom.suite.registry import query, whole, with_parts


def _prior_scores(r, attribute):
    """Class shares of the city or model of a user as scores."""
    found = priors.label_prior(r.labelled_attributes(), [attribute], CLASSES)
    scores = F.array(*[F.col(f"share_{k}") for k in CLASSES]).alias("scores")
    return r.attributes().join(found.select(attribute, scores), attribute).select("uid", "scores")


def _label_sql(attribute):
    shares = "[" + ", ".join(f"share_{k}" for k in CLASSES) + "]"
    return f"""SELECT uid AS id, {whole(f"list_position({shares}, list_max({shares}))")} AS label
    FROM attributes JOIN ({prior_queries._prior(attribute, "labelled_attributes", 3)}) USING ({attribute})"""


@query("argmax_label", with_parts(_label_sql("city"), "labelled_attributes"))
def argmax_label(r):
    return route.labels_of(_prior_scores(r, "city"))


@query(
    "route_predictions",
    with_parts(
        """SELECT id, label FROM by_boots WHERE id IN (SELECT uid FROM unlabelled)
        AND id IN (SELECT user_id FROM events)
        UNION ALL SELECT id, label FROM by_city WHERE id IN (SELECT uid FROM unlabelled)
        AND id NOT IN (SELECT user_id FROM events) ORDER BY id""",
        "labelled_attributes",
        "unlabelled",
        by_city=_label_sql("city"),
        by_boots=_label_sql("boot_times"),
    ),
)
def route_predictions(r):
    unlabelled = r.unlabelled()
    ids = unlabelled.select(F.col("uid").alias("id"))
    full = route.labels_of(_prior_scores(r, "city")).join(ids, "id", "left_semi")
    usage = route.labels_of(_prior_scores(r, "boot_times")).join(ids, "id", "left_semi")
    absent = population.absent_from(unlabelled, r.month_log())
    return route.submission(route.route(usage, full, absent))
