"""Queries of populations and installed apps."""

from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import categories, population
from tallyloom.operators.usage import app_totals
from tallyloom.suite.registry import query, rounded, whole, with_parts


@query(
    "population_semi",
    with_parts("SELECT uid, label FROM labelled WHERE uid IN (SELECT user_id FROM events)", "labelled"),
)
def population_semi(r):
    return population.present_in(r.labelled(), r.month_log())


@query(
    "population_anti",
    with_parts("SELECT uid FROM unlabelled WHERE uid NOT IN (SELECT user_id FROM events)", "unlabelled"),
)
def population_anti(r):
    return population.absent_from(r.unlabelled(), r.month_log())


@query("explode_installed", with_parts("SELECT uid, app FROM installed", "installed"))
def explode_installed(r):
    return categories.explode_installed(r.installed_lists())


@query(
    "install_ratio",
    with_parts(
        f"""SELECT uid, count(*) AS apps, {rounded("count(*) / (SELECT count(DISTINCT app) FROM installed)", 6)} AS ratio
        FROM installed GROUP BY uid""",
        "installed",
    ),
)
def install_ratio(r):
    out = categories.install_ratio(r.installed_pairs())
    return out.withColumn("ratio", round_even(F.col("ratio"), 6))


@query(
    "user_category_nunique",
    with_parts("SELECT uid, count(DISTINCT category) AS categories FROM categorised GROUP BY uid", "categorised"),
)
def user_category_nunique(r):
    return categories.category_nunique(categories.with_category(app_totals(r.usage()), r.categories()))


@query(
    "stratified_folds",
    with_parts(
        f"""SELECT uid, label, {whole("(row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', uid, '2019')), uid) - 1) % 5")}
        AS fold FROM labelled""",
        "labelled",
    ),
)
def stratified_folds(r):
    return population.stratified_folds(r.labelled())
