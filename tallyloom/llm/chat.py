"""Chat formatting over reply trees.

A tree has nodes with a parent; a branch is a path from a root to a leaf. Iterative
self-joins double the reach of every node (its 1st, 2nd, 4th, ... ancestor), and the
paths of the leaves are then put together from those jumps, so that a branch of n turns
takes about 2 log n joins and no join makes more rows than the branches have turns.
Branches of a tree are ranked by the sum of their scores, and each chosen one becomes one
conversation.

The template marks turns. Control strings inside texts are broken by an escape character
after their first character, and escape characters are doubled, so texts read back exactly.

Defined results: null texts and roles count as empty; a node whose parent is missing is a
root; nodes on a cycle, and those below one, are on no branch; a null tree is a tree of
its own; of repeated nodes (same tree and node) the smallest row counts; an empty table
gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import let
from tallyloom.sources.stage import stage

BEGIN, END = "<|im_start|>", "<|im_end|>"
# Control strings of chat templates, as fixed values.
CONTROLS = (BEGIN, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\u2063"
LEARNED = "assistant"

_heads = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS)


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, f"({_heads})", f"$1{ESCAPE}")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, f"{ESCAPE}({ESCAPE}?)", "$1")


def escaped_role(role: Column) -> Column:
    """As escaped, and on one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(f"{ESCAPE}n"))


def unescaped_role(role: Column) -> Column:
    lines = F.regexp_replace(role, f"(?<!{ESCAPE})((?:{ESCAPE * 2})*){ESCAPE}n", "$1\n")
    return unescaped(lines)


def linked_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Nodes (tree, node, parent, role, text, score) of a table of plain conversations: each turn replies to the one before."""
    rows = turns.select(
        turns[conv_col].alias("tree"), turns[turn_col].alias("_turn"),
        F.coalesce(turns[role_col], F.lit("")).alias("role"), F.coalesce(turns[text_col], F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy(F.col("_turn").asc_nulls_first(), "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.withColumn("node", node).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def _keyed(nodes: DataFrame) -> DataFrame:
    """Trees as a text key that is never null, one row per node."""
    key = F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("null"))
    rows = nodes.select(
        key.alias("key"), "tree", F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )
    best = F.min(F.struct(F.col("parent").isNotNull().alias("_has"), "parent", "role", "text", "score", "tree")).alias("b")
    return rows.groupBy("key", "node").agg(best).select("key", "node", "b.tree", "b.parent", "b.role", "b.text", "b.score")


def branches(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """(key, tree, leaf, place, distance, node) of the chosen branches; distance counts from the leaf.

    place is the rank of the branch in its tree: highest sum of scores, then lowest leaf.
    """
    links = nodes.select("key", "node", "parent", "score")
    known = links.select("key", F.col("node").alias("parent"), F.lit(True).alias("_known"))
    links = links.join(known, ["key", "parent"], "left").select(
        "key", "node", F.when(F.col("_known"), F.col("parent")).alias("parent"), "score"
    )
    links = stage(links)
    largest = links.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    jumps = [links.where("parent is not null").select("key", "node", F.col("parent").alias("up"))]
    while 2 ** len(jumps) < largest:
        step = jumps[-1]
        next_up = step.select("key", F.col("node").alias("up"), F.col("up").alias("_up"))
        further = stage(step.join(next_up, ["key", "up"]).select("key", "node", F.col("_up").alias("up")))
        if further.isEmpty():
            break
        jumps.append(further)
    parents = links.where("parent is not null").select("key", F.col("parent").alias("node")).distinct()
    leaves = links.join(parents, ["key", "node"], "left_anti")
    paths = leaves.select("key", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("distance"))
    for k in range(len(jumps) - 1, -1, -1):
        moved = paths.join(jumps[k], ["key", "node"]).select(
            "key", "leaf", F.col("up").alias("node"), (F.col("distance") + 2**k).alias("distance")
        )
        paths = stage(paths.unionByName(moved))
    scored = paths.join(links.select("key", "node", "parent", "score"), ["key", "node"])
    whole = scored.groupBy("key", "leaf").agg(
        F.sum("score").alias("score"), F.bool_or(F.col("parent").isNull()).alias("rooted")
    )
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("score").desc(), "leaf"))
    chosen = whole.where("rooted").withColumn("place", rank).where(F.col("place") <= per_tree).select("key", "leaf", "place")
    return paths.join(chosen, ["key", "leaf"])


def format_trees(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, place, formatted, loss) per chosen branch.

    loss lists (start, length) in code points of the parts of `formatted` that a model is
    to learn: the texts of the assistant.
    """
    rows = stage(_keyed(nodes))
    chosen = branches(rows, per_tree)
    told = chosen.join(rows.select("key", "node", "tree", "role", "text"), ["key", "node"])
    head = F.concat(F.lit(BEGIN), escaped_role(F.col("role")), F.lit("\n"))
    parts = told.select(
        "key", "tree", "place",
        F.struct((-F.col("distance")).alias("at"), (F.col("role") == LEARNED).alias("learned"), head.alias("head"), escaped(F.col("text")).alias("body")).alias("part"),
    )
    lists = parts.groupBy("key", "place").agg(F.first("tree").alias("tree"), F.array_sort(F.collect_list("part")).alias("parts"))
    tail = f"{END}\n"
    shown = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")

    spans = F.aggregate(
        "parts",
        F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + len(tail)).alias("at"),
            F.when(
                p["learned"],
                F.array_append(
                    acc["spans"],
                    F.struct((acc["at"] + F.char_length(p["head"])).alias("start"), F.char_length(p["body"]).cast("long").alias("length")),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return lists.select("tree", "place", shown.alias("formatted"), spans.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    marked = F.filter(F.split(formatted, re.escape(f"{END}\n")), lambda x: x != "")
    return F.transform(
        marked,
        lambda x: F.struct(
            unescaped_role(F.substring_index(F.substr(x, F.lit(len(BEGIN) + 1)), "\n", 1)).alias("role"),
            unescaped(F.regexp_replace(x, "^[^\n]*\n", "")).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask, with nothing between."""
    return F.array_join(
        F.transform(loss, lambda s: unescaped(F.substr(formatted, s["start"].cast("int"), s["length"].cast("int")))), ""
    )


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the formatted text."""

    def read(turns: Column) -> Column:
        told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
        return F.struct(F.size(turns).cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"))

    read_back = formatted.select(
        F.col("tree").alias("conv_id"), let(read_turns(F.col("formatted")), read).alias("t"),
        read_loss(F.col("formatted"), F.col("loss")).alias("learned"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    return read_back.select(
        "conv_id", "t.n_turns", "t.turns_sha256", F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )
