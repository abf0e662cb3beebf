"""The fold harness over naive Bayes, whose fits SQL can restate in closed form."""

from functools import reduce

from pyspark.ml.classification import NaiveBayesModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import assemble, learn, population, route
from tallyloom.plans import stacking
from tallyloom.sources import tables
from tallyloom.sources.roles import CLASSES, COUNTERS
from tallyloom.sources.stage import stage_path
from tallyloom.suite.registry import query, rounded, whole, with_parts

FEATURES = ["boot_times", *COUNTERS, "f_sum"]
FEWER = FEATURES[:4]
PICKED = [6, 0, 3]
FOLDS = 5
_labels = [k - 1 for k in CLASSES]

_fold = whole("(row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', uid, '2019')), uid) - 1) % 5")
_rows = f"SELECT a.*, label - 1 AS label, fold FROM attributes a JOIN (SELECT uid, label, {_fold} AS fold FROM labelled) USING (uid)"


def _fit_sql(train: str, columns: list[str]) -> str:
    """Log prior and log likelihoods per fold model and label: (f, label, prior, theta_<i>)."""
    sums = ", ".join(f"sum(CAST({c} AS DOUBLE)) AS t{i}" for i, c in enumerate(columns))
    whole_sum = " + ".join(f"t{i}" for i in range(len(columns)))
    theta = ", ".join(f"ln(t{i} + 1.0) - ln({whole_sum} + {float(len(columns))}) AS theta_{i}" for i in range(len(columns)))
    return f"""SELECT f, label, ln(n + 1.0) - ln(sum(n) OVER (PARTITION BY f) + count(*) OVER (PARTITION BY f)) AS prior, {theta}
        FROM (SELECT f, label, count(*) AS n, {sums} FROM {train}, (SELECT unnest(range({FOLDS})) AS f)
        WHERE fold <> f GROUP BY f, label)"""


def _score_sql(rows: str, fit: str, columns: list[str], own: bool) -> str:
    """Class scores: (uid, f, label, p); with `own`, by the model of the fold that holds the row."""
    raw = " + ".join(["prior", *[f"CAST({c} AS DOUBLE) * theta_{i}" for i, c in enumerate(columns)]])
    match = f"{rows}.fold = m.f" if own else "true"
    return f"""SELECT uid, f, label, e / sum(e) OVER (PARTITION BY uid, f) AS p FROM (
        SELECT uid, f, label, exp(raw - max(raw) OVER (PARTITION BY uid, f)) AS e FROM (
        SELECT uid, f, m.label, {raw} AS raw FROM {rows} JOIN {fit} m ON {match}))"""


def _wide_sql(scores: str, value: str = "p", keep: str = "uid") -> str:
    cells = ", ".join(f"coalesce(max({value}) FILTER (label = {k}), 0.0) AS p_{k}" for k in _labels)
    return f"SELECT {keep}, {cells} FROM {scores} GROUP BY {keep}"


def _out(body: str, columns: list[str] = FEATURES, **extra: str) -> str:
    parts = {"r": _rows, "m": _fit_sql("r", columns), "s": _score_sql("r", "m", columns, True), "w": _wide_sql("s")}
    return with_parts(body, "attributes", "labelled", **parts, **extra)


_cells = ", ".join(f"{rounded(f'p_{k}', 6)} AS p_{k}" for k in _labels)


def _vectors(r, columns: list[str]) -> DataFrame:
    return assemble.to_vector(r.attributes().select("uid", *columns), columns)


def _training(r, columns: list[str] = FEATURES) -> DataFrame:
    rows = _vectors(r, columns).join(r.labelled(), "uid")
    # folds go by the labels as they are, models need them from 0
    keys = population.stratified_folds(rows.select("uid", "label"), FOLDS)
    return learn.stage_folds(
        rows.drop("label").join(keys, "uid").withColumn("label", (F.col("label") - 1).cast("double"))
    )


def _wide(scored: DataFrame, *keep: str) -> DataFrame:
    return scored.select("uid", *keep, *[round_even(F.col("scores").getItem(k), 6).alias(f"p_{k}") for k in _labels])


def _whole_label(scored: DataFrame) -> DataFrame:
    return scored.withColumn("label", F.col("label").cast("long"))


@query("oof_bayes", _out(f"SELECT uid, {whole('label')} AS label, fold, {_cells} FROM w JOIN (SELECT uid, label, fold FROM r) USING (uid)"))
def oof_bayes(r):
    rows = _training(r)
    return _wide(_whole_label(learn.out_of_fold(rows, learn.fit_folds(rows, learn.bayes, len(CLASSES)))), "label", "fold")


@query(
    "oof_bayes_fewer",
    _out(f"SELECT uid, {whole('label')} AS label, fold, {_cells} FROM w JOIN (SELECT uid, label, fold FROM r) USING (uid)", FEWER),
)
def oof_bayes_fewer(r):
    """The variant with fewer blocks."""
    rows = _training(r, FEWER)
    return _wide(_whole_label(learn.out_of_fold(rows, learn.fit_folds(rows, learn.bayes, len(CLASSES)))), "label", "fold")


_best = "list_position([" + ", ".join(f"p_{k}" for k in _labels) + "], greatest(" + ", ".join(f"p_{k}" for k in _labels) + "))"


_accuracy_sql = _out(f"""SELECT fold, count(*) AS n, {rounded(f"avg(CASE WHEN {_best} - 1 = label THEN 1.0 ELSE 0.0 END)", 6)} AS accuracy
    FROM w JOIN (SELECT uid, label, fold FROM r) USING (uid) GROUP BY fold""")


@query("bayes_accuracy", _accuracy_sql)
def bayes_accuracy(r):
    rows = _training(r)
    found = learn.fold_accuracy(learn.out_of_fold(rows, learn.fit_folds(rows, learn.bayes, len(CLASSES))))
    return found.withColumn("accuracy", round_even(F.col("accuracy"), 6))


@query("fold_score_table", _accuracy_sql)
def fold_score_table(r):
    """The accuracy of the fold models written as a table and read back."""
    path = stage_path(r.spark, "fold-scores")
    tables.write_fold_scores(bayes_accuracy(r), path)
    return tables.read_csv(r.spark, path, "fold bigint, n bigint, accuracy double")


_others = "SELECT attributes.* FROM attributes JOIN unlabelled USING (uid)"
_mean_parts = {
    "r": _rows, "m": _fit_sql("r", FEATURES), "o": _others, "s": _score_sql("o", "m", FEATURES, False),
    "a": f"SELECT uid, label, sum(p) / {FOLDS}.0 AS p FROM s GROUP BY uid, label", "w": _wide_sql("a"),
}
_mean_sql = with_parts(f"SELECT uid, {_cells} FROM w", "attributes", "labelled", "unlabelled", **_mean_parts)


def _unlabelled(r) -> DataFrame:
    return _vectors(r, FEATURES).join(r.unlabelled(), "uid", "left_semi")


@query("bayes_mean_scores", _mean_sql)
def bayes_mean_scores(r):
    rows = _training(r)
    return _wide(learn.mean_scores(_unlabelled(r), learn.fit_folds(rows, learn.bayes, len(CLASSES))))


@query("bayes_saved", _mean_sql)
def bayes_saved(r):
    """Fold models saved, loaded again and applied; their scores written and read as a table."""
    folder = stage_path(r.spark, "models")
    paths = learn.save_models(learn.fit_folds(_training(r), learn.bayes, len(CLASSES)), folder, r.spark)
    scores = learn.mean_scores(_unlabelled(r), learn.load_models(paths, NaiveBayesModel, r.spark))
    tables.write_scores(scores, f"{folder}/scores", len(CLASSES))
    return _wide(tables.read_scores(r.spark, f"{folder}/scores", len(CLASSES)))


@query(
    "bayes_labels",
    with_parts(f"SELECT uid AS id, {whole(_best)} AS label FROM w ORDER BY id", "attributes", "labelled", "unlabelled", **_mean_parts),
)
def bayes_labels(r):
    """Labels of the users without one, by the mean of the fold models."""
    rows = _training(r)
    return route.labels_of(learn.mean_scores(_unlabelled(r), learn.fit_folds(rows, learn.bayes, len(CLASSES)))).orderBy("id")


_meta_names = [f"{b}_{k}" for b in ("all", "few") for k in _labels]
_stacked = [*FEATURES, *_meta_names]


@query(
    "bayes_stacked",
    with_parts(
        f"SELECT uid, {whole('label')} AS label, fold, {_cells} FROM w2 JOIN (SELECT uid, label, fold FROM r) USING (uid)",
        "attributes", "labelled",
        r=_rows, m=_fit_sql("r", FEATURES), s=_score_sql("r", "m", FEATURES, True), w=_wide_sql("s"),
        mf=_fit_sql("r", FEWER), sf=_score_sql("r", "mf", FEWER, True), wf=_wide_sql("sf"),
        r2="SELECT r.*, " + ", ".join(f"CAST(CAST({t}.p_{k} AS FLOAT) AS DOUBLE) AS {b}_{k}" for b, t in (("all", "w"), ("few", "wf")) for k in _labels)
        + " FROM r JOIN w USING (uid) JOIN wf USING (uid)",
        m2=_fit_sql("r2", _stacked), s2=_score_sql("r2", "m2", _stacked, True), w2=_wide_sql("s2"),
    ),
)
def bayes_stacked(r):
    """Scores of two base models beside the features, fitted again over the same folds."""
    rows = _training(r)
    few = _training(r, FEWER)
    parts = [
        learn.out_of_fold(t, learn.fit_folds(t, learn.bayes, len(CLASSES))).select("uid", F.lit(name).alias("model"), "scores")
        for name, t in (("all", rows), ("few", few))
    ]
    meta = stacking.stacked_rows(rows, reduce(DataFrame.unionByName, parts), ["all", "few"], len(CLASSES))
    meta = learn.stage_folds(meta.join(rows.select("uid", "label", "fold"), "uid"))
    return _wide(_whole_label(learn.out_of_fold(meta, learn.fit_folds(meta, learn.bayes, len(CLASSES)))), "label", "fold")


@query(
    "sliced_features",
    with_parts(
        " UNION ALL ".join(
            f"SELECT uid, CAST({i} AS BIGINT) AS slot, CAST({FEATURES[k]} AS DOUBLE) AS value FROM attributes WHERE {FEATURES[k]} <> 0"
            for i, k in enumerate(PICKED)
        ),
        "attributes",
    ),
)
def sliced_features(r):
    """The rows with only the features of an index list, in its order."""
    sliced = assemble.slice_vector(_vectors(r, FEATURES), PICKED)
    return assemble.vector_rows(sliced.select("uid", F.col("selected").alias("features")))


@query(
    "bayes_two_populations",
    with_parts(
        f"""SELECT 'full' AS population, uid, {_cells} FROM w UNION ALL
        SELECT 'usage' AS population, uid, {_cells} FROM wu""",
        "attributes", "labelled",
        r=_rows, m=_fit_sql("r", FEATURES), s=_score_sql("r", "m", FEATURES, True), w=_wide_sql("s"),
        active="SELECT DISTINCT user_id AS uid FROM events",
        lu="SELECT labelled.* FROM labelled JOIN active USING (uid)",
        ru=f"SELECT a.*, label - 1 AS label, fold FROM attributes a JOIN (SELECT uid, label, {_fold} AS fold FROM lu) USING (uid)",
        mu=_fit_sql("ru", FEATURES), su=_score_sql("ru", "mu", FEATURES, True), wu=_wide_sql("su"),
    ),
)
def bayes_two_populations(r):
    """The same pipeline over all labelled users and over those in the log."""
    parts = []
    for name, labelled in (("full", r.labelled()), ("usage", population.present_in(r.labelled(), r.month_log()))):
        rows = _vectors(r, FEATURES).join(labelled, "uid")
        keys = population.stratified_folds(rows.select("uid", "label"), FOLDS)
        rows = learn.stage_folds(rows.drop("label").join(keys, "uid").withColumn("label", (F.col("label") - 1).cast("double")))
        scored = learn.out_of_fold(rows, learn.fit_folds(rows, learn.bayes, len(CLASSES)))
        parts.append(_wide(scored).select(F.lit(name).alias("population"), "uid", *[f"p_{k}" for k in _labels]))
    return reduce(DataFrame.unionByName, parts)
