"""Queries of fold models and stacking over the vectors of the driver tables.

Fits have no SQL; tests check what must hold for them.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import assemble, learn, population, priors, sequence, sparse_net, text, usage
from tallyloom.plans import blocks, pipeline, stacking
from tallyloom.sources.roles import CLASSES as USER_CLASSES
from tallyloom.sources.roles import ATTRIBUTES, COUNTERS, CROSSES, PART_TYPES, PRIORITIES
from tallyloom.sources.stage import stage, stage_by_key
from tallyloom.suite.registry import query

CLASSES = 10
WIDTH = 64


def _forest():
    return learn.forest(trees=10, depth=5, min_leaf=2)


def _perceptron():
    return learn.perceptron(WIDTH, CLASSES, hidden=(16,), rounds=20)


def _wide(scored: DataFrame, *keep: str) -> DataFrame:
    cells = [round_even(c, 6).alias(f"p_{k}") for k, c in enumerate(F.col("scores").getItem(i) for i in range(CLASSES))]
    return scored.select("uid", *keep, *cells)


def _oof(r, make) -> DataFrame:
    rows = stacking.folded_vectors(r.vectors())
    return learn.out_of_fold(rows, learn.fit_folds(rows, make, CLASSES))


@query("oof_forest")
def oof_forest(r):
    return _wide(_oof(r, _forest), "label", "fold")


@query("oof_mlp")
def oof_mlp(r):
    return _wide(_oof(r, _perceptron), "label", "fold")


@query("fold_accuracy")
def fold_accuracy(r):
    return learn.fold_accuracy(_oof(r, _forest))


NET = sparse_net.Settings(classes=len(USER_CLASSES))


def _oof_net(r, entries: DataFrame) -> DataFrame:
    """Out-of-fold scores of a network on rows (doc, token, value) of the labelled users."""
    keys = population.stratified_folds(r.labelled())
    users = stage(keys.select("uid", (F.col("label") - 1).cast("int").alias("label"), "fold"))
    entries = stage(entries.toDF("uid", "slot", "value").join(users.select("uid"), "uid", "left_semi"))
    settings = sparse_net.sized(entries, NET)
    parts = sparse_net.batches(users, entries, settings)
    net = sparse_net.train_batches(parts, sparse_net.Network.new(entries, settings))
    scored = reduce(DataFrame.unionByName, [sparse_net.out_of_fold(*part, net) for part in parts])
    cells = [round_even(F.col("scores").getItem(i), 6).alias(f"p_{i}") for i in range(NET.classes)]
    return scored.select("uid", F.col("label").cast("long").alias("label"), "fold", *cells)


@query("oof_dense_counts")
def oof_dense_counts(r):
    """A dense network on counts of the installed apps, as wide as their vocabulary."""
    pairs = r.installed_pairs().select(F.col("uid").alias("doc"), F.col("app").cast("string").alias("token"))
    return _oof_net(r, text.count_rows(pairs).select("doc", "token", F.col("tf").cast("double").alias("value")))


@query("oof_dense_tfidf")
def oof_dense_tfidf(r):
    """The same on the TF-IDF weights of the used apps."""
    used = sequence.replicate(usage.app_totals(r.usage()))
    rows = used.select(F.col("uid").alias("doc"), F.col("app").cast("string").alias("token"))
    return _oof_net(r, text.tfidf_rows(rows).select("doc", "token", F.col("weight").alias("value")))


@query("fold_mean_scores")
def fold_mean_scores(r):
    """Rows with a quality label of the same id count as unseen here."""
    seen = r.table("labels").select(F.col("doc_id").alias("uid")).distinct()
    vectors = r.vectors()
    rows = stacking.folded_vectors(vectors.join(seen, "uid", "left_anti"))
    others = vectors.join(seen, "uid", "left_semi").drop("label")
    return _wide(learn.mean_scores(others, learn.fit_folds(rows, _forest, CLASSES)))


@query("feature_select")
def feature_select(r):
    model = _forest().fit(r.vectors())
    return learn.split_counts(model, r.spark, WIDTH).withColumn("kept", F.col("splits") > 2)


@query("stacked_scores")
def stacked_scores(r):
    rows = stacking.folded_vectors(r.vectors())
    empty = rows.where(F.lit(False)).select("uid", "features")
    parts = [stacking.base_scores(rows, empty, make, name, CLASSES)[0] for name, make in (("forest", _forest), ("mlp", _perceptron))]
    meta = stacking.stacked_rows(rows, reduce(DataFrame.unionByName, parts), ["forest", "mlp"], CLASSES)
    meta = meta.join(rows.select("uid", "label", "fold"), "uid")
    chosen = stacking.chosen_features(meta, _forest, WIDTH + 2 * CLASSES)
    slim = assemble.slice_vector(meta, chosen).select("uid", "label", "fold", F.col("selected").alias("features"))
    slim = learn.stage_folds(slim)
    return _wide(learn.out_of_fold(slim, learn.fit_folds(slim, _forest, CLASSES)), "label", "fold")


def _user_classifier(width: int):
    return learn.perceptron(width, len(USER_CLASSES), hidden=(16,), rounds=20)


# Bounds of selected crosses that suit the size of the driver tables; the shares are fixed values.
_RULES = {n: (shares[: len(USER_CLASSES)], 3, 12) for n, (shares, _, _) in priors.CROSS_RULES.items()}
_SUPPORT = 5


def user_blocks(r) -> tuple[dict[str, DataFrame], DataFrame]:
    """The blocks that every user has, and the one of the usage log."""
    users, labelled = r.attributes(), r.labelled()
    flags = {"network": PRIORITIES, "carrier": ["F", "O", "P"]}
    base = blocks.base_block(users, labelled, USER_CLASSES, ATTRIBUTES, COUNTERS, CROSSES, flags)
    installed = blocks.installed_block(
        r.installed_pairs(), r.name_categories(), labelled, USER_CLASSES, PART_TYPES, support=_SUPPORT, order="place"
    )
    everyone = {
        "base": blocks.number_block(base, "base"),
        "installed": blocks.number_block(installed, "installed"),
        "tokens": blocks.token_block(r.installed_pairs(), users),
        **blocks.selected_flags(users, labelled, USER_CLASSES, CROSSES, _RULES),
    }
    log = blocks.usage_block(
        r.usage(), r.categories(), labelled, USER_CLASSES, PART_TYPES, support=_SUPPORT, top=200
    )
    return everyone, blocks.number_block(log, "usage")


@query("stacked_labels")
def stacked_labels(r):
    """The whole run on the users: all blocks, two populations, two base models, stacked scores, routed labels."""
    labelled, unlabelled, log = r.labelled(), r.unlabelled(), r.month_log()
    everyone, log_block = user_blocks(r)
    scores = []
    for parts, train, rest in (
        (everyone, labelled, unlabelled),
        ({**everyone, "usage": log_block}, population.present_in(labelled, log), population.present_in(unlabelled, log)),
    ):
        # in buckets of the same keys, so that the blocks of a population join without an exchange
        parts = {name: stage_by_key(block) for name, block in parts.items()}
        width = sum(assemble.vector_size(block, name) for name, block in parts.items())
        bases = {"forest": _forest, "dense": lambda width=width: _user_classifier(width)}
        scores.append(pipeline.population_scores(parts, train, rest, bases, _forest, len(USER_CLASSES))[1])
    return pipeline.final_labels(scores[0], scores[1], unlabelled, log)


@query("usage_block")
def usage_block(r):
    return _rounded(
        blocks.usage_block(r.usage(), r.categories(), r.labelled(), USER_CLASSES, PART_TYPES, support=_SUPPORT, top=200)
    )


def _rounded(block: DataFrame) -> DataFrame:
    return block.withColumns({c: round_even(F.col(c), 6) for c, t in block.dtypes if t == "double"})
