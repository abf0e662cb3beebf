"""Columns of the caller come through every stage unchanged, whatever their names."""

import pytest
from brute import docs_table

import corpus_pipeline

NAMES = [
    "__text_hash", "__copy", "__gone", "__kept_id", "__kept_hash", "__n", "__rows", "__one", "row", "text_hash", "kept_id", "kept_hash", "one", "gone",
    "id", "hash", "origin", "n", "repeats", "copy", "a.b", "Row.Text", "weird `name`", "_place", "_upto", "host", "line", "_id", "_hash",
]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", ["quality_rules", "exact_dedup", "jaccard_join", "weighted_mix"])
def test_clashing_columns_come_through(spark, name):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(k, text(k % 7), f"s{k % 2}") for k in range(9)] + [(9, None, None), (None, text(20), "s0"), (3, text(3), "s1")]
    docs = docs_table(spark, rows)
    marked = docs.select("*", *[docs.doc_id.cast("string").alias(c) for c in NAMES])
    out = STAGES[name](spark, marked, "")
    assert out.columns == marked.columns
    got = out.collect()
    assert got and all(set(r[len(docs.columns) :]) == {None if r[0] is None else str(r[0])} for r in got)
    plain = STAGES[name](spark, docs, "").collect()
    order = lambda found: sorted(map(str, found))
    assert order(tuple(r)[:5] for r in got) == order(map(tuple, plain))
