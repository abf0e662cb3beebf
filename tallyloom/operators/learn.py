"""Fold models, out-of-fold scores and feature selection on Spark ML."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.arrays import best_class
from tallyloom.operators.assemble import vector_size
from tallyloom.session import DENSE_BYTES, limit
from tallyloom.sources.stage import stage, stage_path


def forest(
    trees: int = 100, depth: int = 7, min_leaf: int = 500, features: float = 0.7, rows: float = 0.8, seed: int = 2019
) -> RandomForestClassifier:
    """Multi-class forest with the feature and row sampling of the boosted trees it stands for."""
    return RandomForestClassifier(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy=str(features),
        subsamplingRate=rows,
        seed=seed,
    )


def boosted(
    rounds: int = 100, depth: int = 7, min_leaf: int = 500, rate: float = 0.1, rows: float = 0.8, seed: int = 2019
) -> OneVsRest:
    """Boosted trees, one set per class, learning rate 0.1."""
    single = GBTClassifier(
        maxIter=rounds, maxDepth=depth, minInstancesPerNode=min_leaf, stepSize=rate, subsamplingRate=rows, seed=seed
    )
    return OneVsRest(classifier=single)


def bayes(smoothing: float = 1.0) -> NaiveBayes:
    """Multinomial naive Bayes on counts and other features that are not negative; one pass per fit."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial")


def perceptron(width: int, classes: int, hidden: tuple[int, ...] = (32,), rounds: int = 50, seed: int = 2019):
    """Dense network with softmax output."""
    return MultilayerPerceptronClassifier(layers=[width, *hidden, classes], maxIter=rounds, seed=seed)


@dataclass
class ClassModel:
    """A fitted model with the places of its outputs in a fixed list of classes.

    Labels are places in that list, 0 to classes - 1. A model knows only the classes of the
    rows that it was fitted on; the others get a score of 0 in their place. Without a model
    the one class there was gets everything, and with no class at all every score is 0.
    """

    model: Model | None
    seen: list[int]
    classes: int

    def scores(self, outputs: Column | None) -> Column:
        """Scores in order of the class list from the outputs of the model."""
        if outputs is None:
            return F.array(*[F.lit(1.0 if k in self.seen else 0.0) for k in range(self.classes)])
        # a network may have more outputs than it saw classes
        total = F.aggregate(F.slice(outputs, 1, len(self.seen)), F.lit(0.0), lambda a, b: a + b)
        scale = F.when(F.size(outputs) > len(self.seen), total).otherwise(F.lit(1.0))
        place = {k: i for i, k in enumerate(self.seen)}
        return F.array(*[F.try_divide(outputs[place[k]], scale) if k in place else F.lit(0.0) for k in range(self.classes)])


def class_scores(model: Model) -> Column:
    """Class probabilities of a scored row as an array, in the order of the model's outputs.

    One-against-rest models give margins only; their logistic values are scaled to sum 1.
    """
    if model.hasParam("probabilityCol"):
        return vector_to_array("probability")
    odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
    return F.transform(odds, lambda o: o / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))


def score(model: ClassModel, rows: DataFrame, name: str = "scores", keep: tuple[str, ...] = ()) -> DataFrame:
    """Class scores of the rows. The name of the score column must differ from the kept columns."""
    if model.model is None:
        return rows.select("uid", *keep, model.scores(None).alias(name))
    outputs = model.model.transform(rows).select("uid", *keep, class_scores(model.model).alias(f"_{name}"))
    return outputs.select("uid", *keep, model.scores(F.col(f"_{name}")).alias(name))


def seen_classes(rows: DataFrame, classes: int) -> list[int]:
    """The labels that occur, in order; a label outside the class list is an error."""
    label = F.col("label").cast("double")
    inside = label.isNotNull() & (label >= 0) & (label < classes) & (label == F.floor(label))
    wrong = F.raise_error(F.concat(F.lit("no class of the list: "), F.coalesce(label.cast("string"), F.lit("null"))))
    places = rows.select(F.when(inside, label.cast("int")).otherwise(wrong.cast("int")).alias("k")).distinct()
    return sorted(r["k"] for r in places.collect())  # as many rows as there are classes


def fit_classes(rows: DataFrame, make: Callable[[], Estimator], classes: int) -> ClassModel:
    """A model of (label, features) that knows its place in the list of classes."""
    seen = seen_classes(rows, classes)
    if len(seen) < 2:
        return ClassModel(None, seen, classes)
    place = F.array_position(F.array(*[F.lit(k) for k in seen]), F.col("label").cast("int")) - 1
    return ClassModel(make().fit(rows.withColumn("label", place.cast("double"))), seen, classes)


def fit_folds(
    rows: DataFrame, make: Callable[[], Estimator], classes: int, folds: int = 5, parallel: int = 5
) -> list[ClassModel]:
    """One model per fold, fitted on the rows of all other folds (uid, label, fold, features).

    The fits are independent jobs; `parallel` of them share the cluster at a time, or fewer
    where their rows are wide: forests and networks keep the rows they learn from with every
    feature written out.
    """
    spark = rows.sparkSession
    held = max(1, rows.count() * vector_size(rows, "features") * 8 * (folds - 1) // max(1, folds))
    parallel = max(1, min(parallel, folds, limit(spark, DENSE_BYTES) // held))

    @inheritable_thread_target(spark)
    def fit(fold: int) -> ClassModel:
        return fit_classes(rows.where(F.col("fold") != fold), make, classes)

    with ThreadPool(parallel) as pool:
        return pool.map(fit, range(folds))


def stage_folds(rows: DataFrame) -> DataFrame:
    """Write the training rows once, one folder per fold, for the many passes of the fits."""
    return stage(rows.select("uid", "label", "features", "fold"), "fold")


def out_of_fold(rows: DataFrame, models: list[ClassModel]) -> DataFrame:
    """Scores of every row by the model that has not seen it: (uid, label, fold, scores)."""
    parts = [score(m, rows.where(F.col("fold") == f), keep=("label", "fold")) for f, m in enumerate(models)]
    return reduce(DataFrame.unionByName, parts)


def mean_scores(rows: DataFrame, models: list[ClassModel]) -> DataFrame:
    """Mean of the scores of all fold models, in one pass and without a shuffle: (uid, scores)."""
    out = rows.select("uid", "features")
    names = [f"_scores_{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        out = score(model, out, name, keep=("features", *[c for c in out.columns if c in names]))
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [F.col(n) for n in names])
    n = float(len(models))
    return out.select("uid", F.transform(total, lambda s: s / F.lit(n)).alias("scores"))


def fold_accuracy(scored: DataFrame) -> DataFrame:
    """Rows and share of right classes per fold. Labels are 0-based."""
    right = (best_class(F.col("scores")) - 1 == F.col("label")).cast("double")
    return scored.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"))


def save_models(models: list[ClassModel], folder: str, spark: SparkSession) -> list[str]:
    """One folder per fold, with the model and the classes it knows."""
    paths = [f"{folder}/fold-{i}" for i in range(len(models))]
    for m, path in zip(models, paths):
        if m.model is not None:
            m.model.write().overwrite().save(f"{path}/model")
        known = spark.createDataFrame([(m.seen, m.classes, m.model is not None)], "seen array<int>, classes int, fitted boolean")
        known.write.mode("overwrite").parquet(f"{path}/classes")
    return paths


def load_models(paths: list[str], kind: type[Model], spark: SparkSession) -> list[ClassModel]:
    """Models as save_models wrote them."""
    known = [spark.read.parquet(f"{path}/classes").first() for path in paths]
    return [
        ClassModel(kind.load(f"{path}/model") if k["fitted"] else None, list(k["seen"]), k["classes"])
        for path, k in zip(paths, known)
    ]


def split_counts(model: Model, spark, width: int) -> DataFrame:
    """How often the trees of a forest split on each feature: (feature, splits), 0 included.

    The counts come from the node table of the saved model.
    """
    path = stage_path(spark, "model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*").where(F.col("leftChild") >= 0)
    used = nodes.groupBy(F.col("split.featureIndex").cast("long").alias("feature")).agg(
        F.count(F.lit(1)).alias("splits")
    )
    return spark.range(width).withColumnRenamed("id", "feature").join(used, "feature", "left").na.fill(0, ["splits"])


def selected_features(counts: DataFrame, more_than: int = 2) -> list[int]:
    """Features with enough splits. The list has at most one entry per feature."""
    rows = counts.where(F.col("splits") > more_than).orderBy("feature").collect()
    return [r["feature"] for r in rows]
