"""Mixing sources to target weights by weighted fair queueing.

Every document of a source, in shuffled order, gets a virtual finish time: the words of
its source up to and with it, divided by the target of the source. All documents are
range-sorted by that time and taken until the total budget is spent. A source whose
target is above its size goes round again, up to the allowed number of rounds.

The running sums come from range-partitioned slices, so neither a large source nor the
whole table is ever in one task. The table of sources has one row per source, as the
weights do that somebody wrote for them.

Defined results: a null text has no words; a null source is a source of its own, last in
order; documents without words are never taken; rows with equal ids are separate
documents; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import carried, same, word_count
from tallyloom.operators.hot import running_total
from tallyloom.sources.stage import stage

WEIGHTS = (5, 2, 1)
ROUNDS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...], rounds: int) -> DataFrame:
    """(source, source_no, source_size, target) from (source, source_size).

    A target stops at `rounds` times the size of its source, and the excess goes to the
    others by weight. With sources in order of size / weight, the first ones are capped
    and the rest share what is left, so one pass of running sums finds the level.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*[F.lit(w) for w in weights])
    t = sizes.withColumn("source_no", F.row_number().over(names).cast("long"))
    t = t.withColumn("w", F.get(pick, F.pmod(F.col("source_no") - 1, F.lit(len(weights))).cast("int")).cast("long"))
    t = t.withColumn("cap", F.col("source_size") * rounds)
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    t = t.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "capped": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "open_w": F.sum("w").over(after),
        }
    )
    t = t.withColumn("level", (F.col("total") - F.col("capped")).cast("double") / F.col("open_w").cast("double"))
    # the level holds from the first source on whose cap is not below its share
    t = t.withColumn("fits", F.col("cap").cast("double") >= F.col("level") * F.col("w").cast("double"))
    t = t.withColumn(
        "level", F.min_by(F.when(F.col("fits"), F.col("level")), F.when(F.col("fits"), F.struct(F.col("cap") / F.col("w"), "source_no"))).over(everything)
    )
    share = F.col("level") * F.col("w").cast("double")
    return t.select(
        "source", "source_no", "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(share, F.col("cap").cast("double"))).alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    rounds: int = ROUNDS,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, copies, taken, text_hash."""
    texts = docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), docs[source_col].alias("source")
    )
    rows = stage(
        texts.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    )
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sources = stage(source_targets(sizes, weights, rounds))
    joined = rows.join(
        sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    shuffled = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    timed = stage(
        running_total(
            joined.withColumn("_place", shuffled),
            ["source_no"],
            [F.col("_place"), F.col("doc_id").asc_nulls_last(), F.col("text_hash")],
            F.col("size"),
            "_upto",
        )
    )
    turn = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("_round")
    upto = F.col("_round").cast("long") * F.col("source_size") + F.col("_upto")
    turns = timed.where("size > 0").select("source_no", "size", "_place", "target", "source_size", "_upto", turn).select(
        F.try_divide(upto.cast("double"), F.col("target")).alias("finish"),
        ((upto - F.col("size")).cast("double") < F.col("target")).alias("_begins"),
        "source_no", "_place", "_upto", "size",
    )
    # all that ends by time 1 fits the budget, and no source needs more than one document beyond it
    order = ["finish", "source_no", "_place", "_upto"]
    queue = running_total(turns.where("_begins").drop("_begins"), [], [F.col(c) for c in order], F.col("size"), "_spent")
    budget = sources.agg(F.sum("source_size").alias("budget"))
    first_out = (
        queue.where(F.col("_spent") > F.coalesce(budget.scalar(), F.lit(0)))
        .agg(F.min(F.struct(*order)).alias("cut"))
    )
    cut = first_out.first()["cut"]  # one row: the place in the queue where the budget ends
    key = F.struct(*order)

    def served(r: int):
        upto = F.lit(r).cast("long") * F.col("source_size") + F.col("_upto")
        begins = (upto - F.col("size")).cast("double") < F.col("target")
        place = F.struct(
            F.try_divide(upto.cast("double"), F.col("target")).alias("finish"), "source_no", "_place", "_upto"
        )
        if cut is not None:
            last = F.struct(*[F.lit(cut[c]).cast(kind).alias(c) for c, kind in zip(order, ("double", "long", "string", "long"))])
            begins = begins & (place < last)
        return F.when((F.col("size") > 0) & begins, 1).otherwise(0)

    copies = sum((served(r) for r in range(1, rounds)), served(0))
    return timed.withColumn("copies", copies.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), "text_hash", F.col("_place").alias("place"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows that the mix takes, as often as it takes them, all columns as they were."""
    taken = mix(docs, id_col, text_col, source_col, **options).where("copies > 0")
    # rows with one id, text and source are repeats of one document; what they are given is made from one of them
    taken = taken.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("source").alias("origin")).agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("repeats")
    )
    rows = carried(docs, text_col, doc_id=id_col, source=source_col)
    joined = rows.join(taken, same(rows, taken, [("doc_id", "id"), ("text_hash", "hash"), ("source", "origin")]))
    several = joined.where("repeats > 1").dropDuplicates(["id", "hash", "origin"])
    both = joined.where("repeats = 1").unionByName(several)
    return both.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")).select("row.*")
