"""The three pipelines over the driver tables, and the shape of some plans."""

from conftest import SMALL
from pyspark.sql import functions as F

from tallyloom.operators import ranking, text, usage
from tallyloom.operators.assemble import to_vector
from tallyloom.plans import blocks
from tallyloom.sources.roles import ATTRIBUTES, CLASSES, COUNTERS, CROSSES, PART_TYPES, PRIORITIES, Roles


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_usage_block_has_one_full_row_per_user(spark):
    r = Roles(spark, SMALL)
    out = blocks.usage_block(r.usage(), r.categories(), r.labelled(), CLASSES, PART_TYPES, support=5)
    numbers = [c for c, t in out.dtypes if t != "string"]
    out = out.select(*numbers).cache()
    assert out.count() == r.usage().select("uid").distinct().count()
    gaps = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numbers]).first()
    assert not [c for c in numbers if gaps[c]]
    assert len(numbers) == len(set(numbers)) > 150


def test_installed_block_has_one_row_per_user(spark):
    r = Roles(spark, SMALL)
    out = blocks.installed_block(
        r.installed(), r.name_categories(), r.labelled(), CLASSES, PART_TYPES, support=5, order="place"
    )
    assert out.count() == r.installed().select("uid").distinct().count()
    assert "weight_mean_sq" in out.columns and "app_share_1_median" in out.columns


def test_base_block_becomes_vectors(spark):
    r = Roles(spark, SMALL)
    attributes, counters = ["model", "city", "f_sum"], COUNTERS
    crosses = {"memory_storage_system": CROSSES["memory_storage_system"]}
    out = blocks.base_block(
        r.attributes(), r.labelled(), CLASSES, attributes, counters, crosses, {"network": PRIORITIES}
    )
    columns = [c for c in out.columns if c != "uid"]
    vectors = to_vector(out, columns).collect()
    assert len(vectors) == r.users().count() and all(v["features"].size == len(columns) for v in vectors)
    assert set(attributes) <= set(ATTRIBUTES)


def test_only_needed_columns_are_read(spark):
    plan = plan_of(usage.user_app_nunique(Roles(spark, SMALL).usage()))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_leading_apps_are_cut_before_the_shuffle(spark):
    r = Roles(spark, SMALL)
    plan = plan_of(ranking.leading_apps(usage.app_totals(r.usage()), "duration", r.categories()))
    assert "WindowGroupLimit" in plan


def test_texts_are_read_and_split_once(spark):
    docs = Roles(spark, SMALL).texts()
    plan = plan_of(text.tfidf(docs, F.split("text", " "), 1))
    # what is left to do reads the staged counts; the texts are scanned for their number only
    assert "split(" not in plan and "text" not in "".join(x for x in plan.splitlines() if "ReadSchema" in x)


def test_profile_reads_the_log_once(spark):
    plan = plan_of(usage.usage_profile(Roles(spark, SMALL).usage()))
    assert "lineitem" not in plan


def test_bucketed_blocks_join_without_an_exchange(spark):
    from pyspark.ml.functions import array_to_vector

    from tallyloom.operators.assemble import assemble, hstack
    from tallyloom.sources.stage import drop_staged, stage_by_key

    wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(200).select(F.col("id").alias("uid"))
        blocks = [stage_by_key(base.where(F.col("uid") % k > 0).select("uid", (F.col("uid") * k).alias(f"x{k}"))) for k in range(2, 8)]
        out = assemble(stage_by_key(base), blocks)
        rows = out.collect()  # the final plan is known after the run
        assert "Exchange" not in plan_of(out) and plan_of(out).count("SortMergeJoin") >= 6
        assert len(rows) == 200 and all(r.x3 == (r.uid * 3 if r.uid % 3 else 0) for r in rows)
        vectors = {f"v{k}": stage_by_key(b.select("uid", array_to_vector(F.array(F.col(b.columns[1]).cast("double"))).alias(f"v{k}"))) for k, b in enumerate(blocks)}
        stacked = hstack(vectors, users=stage_by_key(base))
        assert stacked.count() == 200 and "Exchange" not in plan_of(stacked)
        drop_staged(spark)
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("tallyloom_")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)


def test_top_apps_are_broadcast_only_up_to_a_bound(spark, monkeypatch):
    log = Roles(spark, SMALL).usage()
    few = ranking.top_app_usage(log, 20)
    assert "strategy=broadcast" in few._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", 19)
    many = ranking.top_app_usage(log, 20)
    assert "strategy=broadcast" not in many._jdf.queryExecution().analyzed().toString()
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(few) == order(many)
