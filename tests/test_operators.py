"""Hand-made cases of the operators, and hot plans against the plain ones."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import (
    assemble,
    clean,
    encode,
    hot as hot_plans,
    population,
    priors,
    route,
    sequence,
    stats,
    text,
    usage,
)
from tallyloom.session import shared_folder


def rows_of(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_six_stats(spark):
    df = spark.createDataFrame([("a", 5), ("a", 7), ("a", 7), ("b", 1)], "uid string, x int")
    a, b = stats.six_stats(df, ["uid"], {"x": "x"}).orderBy("uid").collect()
    assert a["x_mean"] == pytest.approx(19 / 3) and a["x_median"] == 7 and (a["x_min"], a["x_max"]) == (5, 7)
    assert a["x_std"] == pytest.approx(1.1547, abs=1e-4) and a["x_var"] == pytest.approx(4 / 3)
    assert b["x_std"] is None and b["x_var"] is None and b["x_median"] == 1


def test_population_variance_is_truncated(spark):
    df = spark.createDataFrame([(1, 5.0, 1), (1, 7.0, 1), (1, 10.0, 1)], "uid int, duration double, times int")
    assert rows_of(usage._spread(df, "d_")) == [(1, 4, 0)]


def test_mode_impute(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (3, None), (1, "b"), (None, "a")], "x int, s string")
    assert clean.modes(df, ["x", "s"]) == {"x": 1, "s": "a"}
    assert clean.mode_impute(df, ["x", "s"]).where("x is null or s is null").count() == 0


def test_narrow_schema(spark):
    df = spark.createDataFrame([(1, 300, 70000, 2**40, 1.5)], "a long, b long, c long, d long, e double")
    assert [t for _, t in clean.narrow_schema(df).dtypes] == ["tinyint", "smallint", "int", "bigint", "float"]


def test_rank_ties_go_to_the_lower_app(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (1, "c", 7)], "uid int, app string, v int")
    ranked = hot_plans.rank_in_group(df, ["uid"], [F.col("v").desc(), F.col("app")], "rank")
    assert rows_of(ranked, "app", "rank") == [("a", 3), ("b", 1), ("c", 2)]


def test_replicate(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 185.0), (1, "c", 1000.0), (1, "d", 5839.0)], "uid int, app string, duration double")
    counts = sequence.replicate(df).groupBy("app").count()
    assert rows_of(counts) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


def test_idf(spark):
    docs = spark.createDataFrame([(1, ["x", "y"]), (2, ["x"]), (3, ["x"])], "doc int, t array<string>")
    got = {(r["doc"], r["token"]): r["weight"] for r in text.tfidf(docs, F.col("t"), 1).collect()}
    rare = math.log(4 / 2) + 1
    assert got[(2, "x")] == pytest.approx(1)
    assert got[(1, "y")] == pytest.approx(rare / math.hypot(1, rare))
    assert {d for d, t in got if t == "y"} == {1}
    kept = text.tfidf(docs, F.col("t"), 0.5).select("token").distinct()
    assert rows_of(kept) == [("x",)]


def test_count_vectors_fit_on_other_rows(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "doc int, token string")
    assert rows_of(text.count_rows(rows, 1, rows.where("doc = 1"))) == [("x", 1, 2)]


def test_minmax_of_a_constant(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "uid int, c double, v double")
    assert rows_of(encode.minmax_scale(df, ["c", "v"])) == [(1, 0.0, 0.0), (2, 0.0, 1.0)]


def test_population_parts(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "uid int")
    log = spark.createDataFrame([(2,), (2,)], "uid int")
    assert rows_of(population.absent_from(users, log)) == [(1,), (3,)]
    assert rows_of(population.present_in(users, log)) == [(2,)]


def test_selection_precedence(spark):
    df = spark.createDataFrame([("v", 30000, 0.0), ("w", 20000, 0.0), ("x", 20000, 0.5)], "value string, total int, share_1 double")
    kept = priors.select_values(df, [1], (0.3,), 10000, 26000)
    assert rows_of(kept, "value") == [("v",), ("x",)]
    assert rows_of(priors.select_values(df, [1], (0.3,), 10000, None), "value") == [("x",)]


def test_weekend_dates(spark):
    df = spark.createDataFrame([("2019-03-02",), ("2019-03-04",), ("2019-03-30",)], "d string").select(F.col("d").cast("date").alias("use_date"))
    assert df.where(usage.is_weekend()).count() == 2
    assert df.where(usage.is_weekend(dates=usage.WEEKEND_DATES)).count() == 1


def test_list_concat_and_padding(spark):
    first = sequence.list_rows(spark.createDataFrame([(1, "a#b"), (2, "c")], "uid int, apps string"))
    second = spark.createDataFrame([(1, 1, "z"), (9, 1, "q")], "uid int, pos long, app string")
    both = sequence.list_concat_rows(first, second)
    assert rows_of(both) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "z"), (2, 1, "c")]
    vocabulary = sequence.build_vocabulary(first.where("app <> 'b'"), second)
    assert rows_of(vocabulary) == [("a", 1), ("c", 2), ("q", 3), ("z", 4)]
    users = spark.createDataFrame([(1,), (2,), (3,)], "uid int")
    got = rows_of(sequence.padded(sequence.encode(both, vocabulary), users, 2))
    assert got == [(1, [1, 4]), (2, [0, 2]), (3, [0, 0])]


def test_folds_are_even(spark):
    rows = spark.range(1003).select(F.col("id").alias("uid"), (F.col("id") % 3).alias("label"))
    sizes = population.stratified_folds(rows).groupBy("label", "fold").count().collect()
    for label in range(3):
        counts = [r["count"] for r in sizes if r["label"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_blocks_must_not_share_columns(spark):
    a = spark.createDataFrame([(1, 2)], "uid int, x int")
    with pytest.raises(ValueError):
        assemble.assemble(a, [a])


def test_sparse_block(spark):
    rows = spark.createDataFrame([(1, 3, 0.5), (1, 0, 1.0)], "uid int, slot int, value double")
    users = spark.createDataFrame([(1,), (2,)], "uid int")
    got = {r["uid"]: r["features"] for r in assemble.sparse_block(rows, users, 4).collect()}
    assert list(got[1].indices) == [0, 3] and list(got[1].toArray()) == [1.0, 0, 0, 0.5]
    assert got[2].numNonzeros() == 0 and got[2].size == 4


def test_routing(spark):
    full = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "id int, label int")
    usage_part = spark.createDataFrame([(1, 2), (3, 3)], "id int, label int")
    absent = spark.createDataFrame([(2,)], "uid int")
    assert rows_of(route.route(usage_part, full, absent)) == [(1, 2), (2, 5), (3, 3)]


@pytest.fixture(scope="module")
def skewed(spark):
    """One user holds most rows; other users have few."""
    rng = random.Random(7)
    rows = [(1 if rng.random() < 0.6 else rng.randint(2, 40), rng.randint(0, 300), i, rng.choice("abcd")) for i in range(3000)]
    return spark.createDataFrame(rows, "uid int, v int, i int, k string").repartition(8).cache()


def python_median(values):
    values = sorted(values)
    n = len(values)
    return (values[(n - 1) // 2] + values[n // 2]) / 2


def test_hot_medians(spark, skewed):
    spark.conf.set("tallyloom.groupRows", "500")
    try:
        got = {r["uid"]: r["v_median"] for r in stats.six_stats(skewed, ["uid"], {"v": "v"}).collect()}
    finally:
        spark.conf.unset("tallyloom.groupRows")
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r["uid"], []).append(r["v"])
    assert got == {u: python_median(v) for u, v in groups.items()}


def test_hot_ranks_and_fills(spark, skewed):
    order = [F.col("v").desc(), F.col("i")]
    holes = skewed.withColumn("k", F.when(F.col("v") % 3 == 0, F.col("k")))
    plain = rows_of(hot_plans.rank_in_group(skewed, ["uid"], order, "rank"), "uid", "i", "rank")
    filled = hot_plans.last_known(holes, ["uid"], [F.col("i")], "k", "f").na.fill("-", ["f"])
    want = rows_of(filled, "uid", "i", "f")
    spark.conf.set("tallyloom.groupRows", "500")
    try:
        assert rows_of(hot_plans.rank_in_group(skewed, ["uid"], order, "rank"), "uid", "i", "rank") == plain
        filled = hot_plans.last_known(holes, ["uid"], [F.col("i")], "k", "f").na.fill("-", ["f"])
        assert rows_of(filled, "uid", "i", "f") == want
    finally:
        spark.conf.unset("tallyloom.groupRows")


@pytest.mark.parametrize("key_list", ["10000", "1"])
def test_null_groups_are_split_like_others(hot, skewed, key_list):
    hot.conf.set("tallyloom.keyList", key_list)
    try:
        rows = skewed.withColumn("uid", F.when(F.col("uid") > 1, F.col("uid")))  # most rows have a null uid
        ranked = hot_plans.rank_in_group(rows, ["uid"], [F.col("i")], "rank")
        assert ranked.count() == skewed.count()
        assert ranked.groupBy("uid").agg((F.max("rank") == F.count("*")).alias("ok")).where("not ok").count() == 0
        filled = hot_plans.last_known(rows.withColumn("k", F.when(F.col("i") % 5 == 0, F.col("k"))), ["uid"], [F.col("i")], "k", "f")
        assert filled.where("uid is null and f is null").count() < 20
    finally:
        hot.conf.unset("tallyloom.keyList")


def test_hstack_keeps_every_user(spark):
    a = assemble.to_vector(spark.createDataFrame([(1, 1.0), (2, 2.0)], "uid int, x double"), ["x"], "a")
    b = assemble.to_vector(spark.createDataFrame([(1, 3.0, 4.0)], "uid int, y double, z double"), ["y", "z"], "b")
    users = spark.createDataFrame([(1,), (2,), (3,)], "uid int")
    got = {r["uid"]: list(r["features"].toArray()) for r in assemble.hstack({"a": a, "b": b}, users=users).collect()}
    assert got == {1: [1.0, 3.0, 4.0], 2: [2.0, 0.0, 0.0], 3: [0.0, 0.0, 0.0]}
    assert assemble.hstack({"a": a, "b": b}).count() == 2


def test_sparse_block_refuses_slots_out_of_range(spark):
    rows = spark.createDataFrame([(1, 3, 0.5), (1, 7, 1.0)], "uid int, slot int, value double")
    with pytest.raises(Exception, match="not a slot"):
        assemble.sparse_block(rows, rows, 4).collect()


def test_selected_values_as_vectors(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "c"), (3, "x"), (4, None)], "uid int, v string")
    slots = encode.one_hot_selected(rows, "v", spark.createDataFrame([("a",), ("c",)], "v string"))
    got = {r["uid"]: list(r["f"].toArray()) for r in assemble.slot_vector(slots, "v_slot", 2, "f").collect()}
    assert got == {1: [1.0, 0.0], 2: [0.0, 1.0], 3: [0.0, 0.0], 4: [0.0, 0.0]}


def test_users_without_orders_keep_their_attributes(spark, tmp_path):
    from tallyloom.sources.roles import Roles

    folder = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    orders.where("o_custkey >= 5").write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet(f"{folder}/customer.parquet").write.parquet(f"{tmp_path}/customer.parquet")
    users = Roles(spark, str(tmp_path)).attributes()
    assert users.count() == spark.read.parquet(f"{folder}/customer.parquet").count()
    alone = users.where("uid < 5").collect()
    assert len(alone) == 5 and all(r["boot_times"] == r["f_sum"] == r["a_times"] == 0 and r["model"] is None for r in alone)


def test_top_apps_of_any_number(spark):
    from tallyloom.operators import ranking

    log = spark.range(1000).select((F.col("id") % 37).alias("app"), F.lit(1).alias("use_date"))
    want = sorted(((r["app"], r["uses"]) for r in ranking.app_frequency(log).collect()), key=lambda x: (-x[1], x[0]))
    assert sorted(rows_of(ranking.most_used_apps(log, 20))) == sorted(want[:20])
    plan = ranking.most_used_apps(log, 20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan


class _Session:
    def __init__(self, settings):
        self.conf = settings


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert shared_folder(_Session({"spark.checkpoint.dir": "hdfs://x/named/"})) == "hdfs://x/named"
    assert shared_folder(_Session({"spark.sql.warehouse.dir": "hdfs://x/house"})) == "hdfs://x/house/_staged"
