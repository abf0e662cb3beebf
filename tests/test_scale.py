"""Plans that keep each task and the shuffled rows small as the tables grow."""

import re
from collections import Counter

import pytest
from conftest import SMALL
from oracle import compare
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry

from tallyloom.functions.arrays import with_bigrams, words
from tallyloom.operators import assemble, ranking, stats, text
from tallyloom.plans import blocks
from tallyloom.sources.roles import Roles
from tallyloom.sources.stage import stage, stage_by_key
from tallyloom.suite import sequences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _cells(df) -> Counter:
    return Counter((r["doc"], r["token"], round(r[2], 9)) for r in df.collect())


def _texts(spark):
    rows = [(k, f"one w{k} two w{k % 3} one") for k in range(30)] + [(3, "one more"), (None, "one"), (40, None)]
    return spark.createDataFrame(rows, "doc long, text string")


def test_bigram_weights_move_no_counts(spark):
    """the counts of a document stay where they were made."""
    weights = text.tfidf(_texts(spark), with_bigrams(words(F.col("text"))), 1)
    plan = _plan(weights)
    assert "SortMergeJoin" not in plan and not re.search(r"Exchange hashpartitioning\(doc", plan)


def test_weights_are_the_same_without_broadcast(spark, monkeypatch):
    found = []
    for most in (1_000_000, 0):
        monkeypatch.setattr(text, "BROADCAST_TOKENS", most)
        found.append(_cells(text.tfidf(_texts(spark), words(F.col("text")), 2)))
    assert found[0] == found[1] and sum(found[0].values()) > 0


def test_texts_are_split_by_as_many_tasks_as_they_need(spark, monkeypatch):
    """a task splits a bounded amount of text, however many partitions a shuffle has."""
    monkeypatch.setattr(text, "TASK_BYTES", 10)
    counts = text._text_counts(_texts(spark), words(F.col("text")))
    assert len(counts.inputFiles()) > 10
    assert Counter((r["doc"], r["token"], r["tf"]) for r in counts.collect())[(3, "one", 3)] == 1


def test_texts_of_one_row_group_are_dealt_from_small_files(spark, monkeypatch):
    """a task that deals texts reads a bounded part of them, however they are stored."""
    seen, deal = [], type(spark.range(0)).repartition

    def watched(df, *args):
        seen.append(len(df.inputFiles()))
        return deal(df, *args)

    docs = stage(_texts(spark).coalesce(1))
    monkeypatch.setattr(text, "TASK_BYTES", 10)
    monkeypatch.setattr(text, "PIECE_BYTES", 100, raising=False)
    monkeypatch.setattr(type(docs), "repartition", watched)
    counts = text._text_counts(docs, words(F.col("text")))
    assert len(docs.inputFiles()) == 1 and seen[0] >= 5
    assert Counter((r["doc"], r["token"], r["tf"]) for r in counts.collect())[(3, "one", 3)] == 1


@pytest.fixture
def small_tasks(spark):
    spark.conf.set("tallyloom.taskRows", "100")
    yield spark
    spark.conf.unset("tallyloom.taskRows")


def test_train_counts_use_as_many_tasks_as_the_log_needs(small_tasks, con, monkeypatch):
    """the pairs are dealt over tasks by the rows of the log."""
    seen, build = [], text.count_rows

    def watched(rows, *more):
        seen.append(rows.rdd.getNumPartitions())
        return build(rows, *more)

    monkeypatch.setattr(text, "count_rows", watched)
    assert compare(small_tasks, con, "count_vector_train", SMALL, QUERIES, SQL)[0] == ""
    assert seen[0] > 20


def test_usage_weights_use_as_many_tasks_as_the_log_needs(small_tasks, con):
    """so are the totals per user and app."""
    assert Roles(small_tasks, SMALL).spread_usage("uid", "app").rdd.getNumPartitions() > 20
    assert compare(small_tasks, con, "tfidf_usage", SMALL, QUERIES, SQL)[0] == ""


def test_padding_reads_the_log_once(spark):
    """both lists follow from one join of the log."""
    reads, build = [], Roles.usage

    class Watched(Roles):
        def usage(self):
            reads.append(1)
            return build(self)

    r = Watched(spark, SMALL)
    assert sequences.encode_sequence(r).count() > 0
    assert len(reads) == 1


def test_stacked_vectors_do_not_describe_their_slots(spark):
    """the schema of a wide vector stays small, and still tells its length."""
    wide = spark.createDataFrame([(1, Vectors.sparse(5000, [3], [1.0]))], ["uid", "a"])
    out = assemble.hstack({"a": wide, "b": wide.withColumnRenamed("a", "b")})
    assert len(out.schema.json()) < 2000
    assert assemble.vector_size(out, "features") == 10000 and out.first()["features"].size == 10000


def test_usage_block_moves_the_log_once(spark):
    """parts of the block follow from tables in buckets of users, and top apps stay one column until the end."""
    plan = _plan(QUERIES["usage_block"](spark, SMALL)).lower()
    assert "l_partkey" not in plan and "pivotfirst" not in plan
    exchanged = re.findall(r"exchange hashpartitioning\(uid#\d+l?, \d+\), (\w+)", plan)
    assert exchanged.count("repartition_by_col") <= 1  # the priors of the apps


def test_statistics_are_the_same_in_buckets(spark):
    """and where a lookup moves the rows before they are grouped."""
    rows = spark.createDataFrame([(k % 7, k % 3, float(k)) for k in range(70)] + [(None, 1, 2.0)], "uid long, app long, x double")
    more = spark.createDataFrame([(0, 5.0), (1, 7.0)], "app long, y double")
    plain = stats.six_stats(rows, ["uid"], {"x": "x", "y": "y"}, enrich=lambda df: df.join(more, "app", "left"))
    kept = stats.six_stats(stage_by_key(rows), ["uid"], {"x": "x"}, dealt=True)
    assert not re.search(r"Exchange hashpartitioning\(uid", _plan(kept))
    assert sorted(kept.collect(), key=str) == sorted(plain.select(*kept.columns).collect(), key=str)


def test_top_apps_become_columns_with_zeros(spark):
    usage = spark.createDataFrame([(1, 2, 3, 4.0, None), (None, 1, 1, 1.0, 1.0)], "uid long, slot long, days long, duration double, times double")
    wide = {r["uid"]: tuple(r)[1:] for r in ranking.top_app_wide(usage, 2).collect()}
    assert wide == {1: (0, 0, 0, 3, 4, 0), 0: (1, 1, 1, 0, 0, 0)}


def test_base_block_reads_the_orders_once(spark, monkeypatch):
    """codes and priors follow from staged attributes, and the wide rows are built by tasks of bounded size."""
    monkeypatch.setattr(blocks, "TASK_USERS", 10)
    plan = _plan(QUERIES["base_block"](spark, SMALL))
    assert "o_custkey" not in plan and "c_nationkey" not in plan
    assert re.search(r"Exchange hashpartitioning\(uid#\d+L, 15\), REPARTITION_BY_NUM", plan)


def test_flags_are_sparse_and_blocks_are_merged(spark):
    """a user has one entry however many slots there are, and files that look small are not broadcast as vectors."""
    from pyspark.ml.linalg import SparseVector

    from tallyloom.operators import assemble

    slots = spark.createDataFrame([(1, 6000), (2, 0), (2, 3), (3, None), (4, 6001), (None, 1)], "uid long, s int")
    flags = assemble.slot_vector(slots, "s", 6000, "f")
    found = sorted(((r.uid or 0, r.f) for r in flags.collect()), key=str)
    assert all(isinstance(f, SparseVector) and f.size == 6000 and set(f.values) <= {1.0} for _, f in found)
    assert [(u, list(f.indices)) for u, f in found] == [(0, [0]), (1, [5999]), (2, [2]), (2, []), (3, []), (4, [])]
    out = assemble.hstack({"f": flags.where("uid < 2 or uid > 2"), "g": flags.withColumnRenamed("f", "g").where("uid = 1")})
    assert {r.uid: list(r.features.indices) for r in out.collect()} == {1: [5999, 11999], 3: [], 4: []}
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_are_fitted_by_fewer_at_a_time(spark):
    """fits keep dense rows, so those of the same time share a bound; the models are the same."""
    import threading

    from pyspark.ml.functions import array_to_vector

    from tallyloom.operators import learn
    from tallyloom.session import DENSE_BYTES

    rows = spark.range(60).select(
        F.col("id").alias("uid"), (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("fold"),
        array_to_vector(F.array(F.col("id") % 5 + 0.0, F.col("id") % 2 + 0.0)).alias("features"),
    )
    running, most, lock = [0], [0], threading.Lock()

    class Maker:
        def fit(self, part):
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            try:
                return learn.bayes().fit(part)
            finally:
                with lock:
                    running[0] -= 1

    want = [m.model.theta for m in learn.fit_folds(rows, learn.bayes, 2, 3)]
    spark.conf.set(DENSE_BYTES[0], "700")  # a fit holds 60 * 2 * 8 * 2 / 3 bytes
    try:
        got = learn.fit_folds(rows, Maker, 2, 3)
    finally:
        spark.conf.unset(DENSE_BYTES[0])
    assert most == [1] and [m.model.theta for m in got] == want
