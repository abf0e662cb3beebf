"""The pipeline against plain Python, and the queries against their SQL."""

import brute
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyloom.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, con, name):
    from oracle import compare

    problem, rows = compare(spark, con, name, SMALL, queries.QUERIES, queries.SQL)
    assert problem == "" and rows > 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_stages_match_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    steps = dict(corpus_pipeline.STAGES)
    left = steps["quality_rules"](spark, docs, SMALL)
    kept = {r.doc_id for r in left.collect()}
    assert kept == {i for i, t in rows if not brute.quality_base(t)[-1]}  # no line is common enough here
    exact = steps["exact_dedup"](spark, left, SMALL)
    rows = [r for r in rows if r[0] in kept]
    groups, _ = brute.exact_groups(rows)
    kept = {r.doc_id for r in exact.collect()}
    assert kept == {groups[r][0] for r in rows}
    near = steps["jaccard_join"](spark, exact, SMALL)
    rows = [r for r in rows if r[0] in kept]
    classes = brute.near_groups(rows)
    kept = {r.doc_id for r in near.collect()}
    assert kept == {c for c, _ in classes.values()}
    mixed = steps["weighted_mix"](spark, near, SMALL)
    assert docs.columns == left.columns == exact.columns == near.columns == mixed.columns
    sizes = {i: len(brute.WORD.findall(t)) for i, t in rows}
    taken = sum(sizes[r.doc_id] for r in mixed.collect())
    total = sum(sizes[i] for i in kept)
    assert abs(taken - total) <= 0.05 * total
    final = steps["byte_bpe"](spark, mixed, SMALL)
    texts = dict(rows)
    assert final.count() == mixed.count()
    assert all(r.decoded_sha256 == brute.sha(texts[r.doc_id]) for r in final.collect())


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_chat_query_matches_plain_python(spark):
    talks = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    rows = duckdb.sql(f"SELECT conv_id, role, text FROM '{SMALL}/conversations.parquet' ORDER BY conv_id, turn").fetchall()
    for c, role, text in rows:
        talks.setdefault(c, []).append((role, text))
    got = {r.conv_id: tuple(r)[1:5] for r in queries.QUERIES["op9_chat_format"](spark, SMALL).collect()}
    assert got == {c: brute.talk_digests(t) for c, t in talks.items()}


@pytest.mark.parametrize("name, columns, read", [
    ("op2_license_scan", ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"], brute.license_base),
    ("op3_secret_scan", ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"], lambda t: (*brute.secret_base(t)[0], brute.secret_base(t)[1])),
])
def test_scans_match_plain_python(spark, name, columns, read):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES[name](spark, SMALL).select(*columns).collect()}
    assert got == {i: read(t) for i, t in texts.items()}


def test_repeats_and_scores_match_plain_python(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op1_suffix_dedup"](spark, SMALL).collect()}
    assert got == brute.repeated_bytes(rows)
    scores = {r.doc_id: r for r in queries.QUERIES["op8_lm_score"](spark, SMALL).collect()}
    for i, (held, n, known, total, base, score) in brute.model_scores(rows).items():
        r = scores[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6) and abs(r.score - score) / n < 0.05
