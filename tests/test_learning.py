"""What must hold for fitted models, whatever they learn."""

import pytest
from conftest import SMALL
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyloom.operators import learn
from tallyloom.plans import stacking
from tallyloom.sources.roles import Roles
from tallyloom.suite.learning import CLASSES, WIDTH, _forest, _perceptron


@pytest.fixture(scope="module")
def rows(spark):
    return stacking.folded_vectors(Roles(spark, SMALL).vectors(), folds=2)


def check_scores(scored, rows):
    total = F.aggregate("scores", F.lit(0.0), lambda a, b: a + b)
    assert scored.where((F.size("scores") != CLASSES) | (F.abs(total - 1) > 1e-6)).count() == 0
    ids = [r["uid"] for r in scored.select("uid").collect()]
    assert len(ids) == len(set(ids)) == rows.count()


def test_forest_scores_every_row_once(rows):
    models = learn.fit_folds(rows, _forest, CLASSES, 2)
    scored = learn.out_of_fold(rows, models)
    check_scores(scored, rows)
    accuracy = learn.fold_accuracy(scored).collect()
    assert {r["fold"] for r in accuracy} == {0, 1} and sum(r["n"] for r in accuracy) == rows.count()
    means = learn.mean_scores(rows, models)
    check_scores(means, rows)
    first = rows.orderBy("uid").limit(1)
    parts = [learn.score(m, first).first()["scores"] for m in models]
    mean = means.join(first.select("uid"), "uid").first()["scores"]
    assert mean == pytest.approx([(a + b) / 2 for a, b in zip(*parts)])


def test_perceptron_scores_every_row_once(rows):
    check_scores(learn.out_of_fold(rows, learn.fit_folds(rows, _perceptron, CLASSES, 2)), rows)


def test_boosted_scores_sum_to_one(rows):
    small = rows.withColumn("label", F.when(F.col("label") < 5, 0.0).otherwise(1.0))
    model = learn.fit_classes(small, lambda: learn.boosted(rounds=2, depth=2, min_leaf=5), 2)
    scored = learn.score(model, small)
    total = F.aggregate("scores", F.lit(0.0), lambda a, b: a + b)
    assert scored.where((F.size("scores") != 2) | (F.abs(total - 1) > 1e-9)).count() == 0


def test_split_counts_cover_all_features(spark, rows):
    counts = learn.split_counts(_forest().fit(rows), spark, WIDTH)
    assert counts.count() == WIDTH
    kept = learn.selected_features(counts, 2)
    assert kept == sorted(kept) and 0 < len(kept) <= WIDTH
    assert counts.where(F.col("splits") > 2).count() == len(kept)


def test_whole_run_labels_every_user_once(spark):
    from tallyloom.suite.learning import stacked_labels

    r = Roles(spark, SMALL)
    got = stacked_labels(r).collect()
    assert sorted(x["id"] for x in got) == sorted(x["uid"] for x in r.unlabelled().collect())
    assert all(1 <= x["label"] <= 5 for x in got)


MAKERS = {
    "bayes": learn.bayes,
    "forest": lambda: learn.forest(trees=5, depth=3, min_leaf=1),
    "perceptron": lambda: learn.perceptron(3, 5, hidden=(4,), rounds=5),
}


def class_rows(spark, labels):
    """Rows whose label is plain in the features, dealt round over two folds."""
    rows = [(k, float(label), k % 2, [float(label == j) + (k % 7) / 40 for j in range(3)]) for k, label in enumerate(labels)]
    table = spark.createDataFrame(rows, "uid long, label double, fold long, v array<double>")
    return table.select("uid", "label", "fold", array_to_vector("v").alias("features"))


@pytest.mark.parametrize("name", MAKERS)
def test_a_class_absent_everywhere_has_zeros_in_its_place(spark, name):
    rows = class_rows(spark, [1, 1, 2, 2, 4, 4] * 5)  # neither 0 nor 3
    models = learn.fit_folds(rows, MAKERS[name], 5, 2)
    for scored in (learn.out_of_fold(rows, models), learn.mean_scores(rows, models)):
        for r in scored.collect():
            assert len(r.scores) == 5 and r.scores[0] == r.scores[3] == 0 and sum(r.scores) == pytest.approx(1)
    assert sum(r.accuracy * r.n for r in learn.fold_accuracy(learn.out_of_fold(rows, models)).collect()) > 10


@pytest.mark.parametrize("name", MAKERS)
def test_a_class_absent_in_a_fold(spark, name):
    # label 4 only in fold 0, so the model of fold 0 has not seen it; label 0 is rare
    rows = class_rows(spark, [4, 1, 4, 2, 2, 1, 1, 2] * 4 + [0, 0])
    models = learn.fit_folds(rows, MAKERS[name], 5, 2)
    assert [m.seen for m in models] == [[0, 1, 2], [0, 1, 2, 4]]
    first = learn.score(models[0], rows).collect()
    assert all(r.scores[4] == r.scores[3] == 0 and sum(r.scores) == pytest.approx(1) for r in first)
    assert any(r.scores[4] > 0 for r in learn.score(models[1], rows).collect())
    means = learn.mean_scores(rows, models).collect()
    assert all(None not in r.scores and sum(r.scores) == pytest.approx(1) for r in means)


def test_one_class_or_none(spark, tmp_path):
    rows = class_rows(spark, [2, 2, 2])
    only = learn.fit_classes(rows, learn.bayes, 4)
    none = learn.fit_classes(rows.where("uid < 0"), learn.bayes, 4)
    paths = learn.save_models([only, none], str(tmp_path), spark)
    from pyspark.ml.classification import NaiveBayesModel

    only, none = learn.load_models(paths, NaiveBayesModel, spark)
    assert all(r.scores == [0, 0, 1, 0] for r in learn.score(only, rows).collect())
    assert all(r.scores == [0, 0, 0, 0] for r in learn.score(none, rows).collect())


def test_a_label_outside_the_list_is_an_error(spark):
    with pytest.raises(Exception, match="no class of the list"):
        learn.fit_classes(class_rows(spark, [0, 5, 1]), learn.bayes, 5)
