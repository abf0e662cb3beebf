"""Operators with Arrow tasks, against plain Python and public libraries."""

import random

import brute
import numpy as np
import pytest
from brute import EDGES, docs_table

from tallyloom.llm import byte_bpe, jaccard_join, lm_score, suffix_dedup
from tallyloom.llm.components import components
from tallyloom.llm.hashing import shingle_sets, word_hashes
from tallyloom.llm.ngram_trie import EliasFano

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_multi_50k.tiktoken")
ONE_ID = [r for r in EDGES if r[0] not in (None, 5)] + [(5, "one")]


def words(draw, n, vocabulary=400):
    return " ".join(f"v{draw.randrange(vocabulary)}" for _ in range(n))


def near_rows():
    draw = random.Random(4)
    rows = [(100 + k, words(draw, draw.randint(1, 80))) for k in range(150)]
    for g in range(12):  # groups of near copies, some with a word changed, some cut
        base = words(draw, 120).split()
        for k in range(20):
            t = list(base)
            for _ in range(k % 5):
                t[draw.randrange(len(t))] = f"n{draw.randrange(99)}"
            rows.append((1000 + 20 * g + k, " ".join(t[: len(t) - k % 7])))
    passage = words(draw, 60)
    rows += [(5000 + k, words(draw, 70) + " " + passage + " " + words(draw, 70)) for k in range(40)]
    return rows


def joined(df):
    return {r.doc_id: (r.class_id, r.n_links) for r in df.collect()}


def test_join_matches_all_pairs(spark):
    rows = near_rows() + [r for r in ONE_ID]
    got = joined(jaccard_join.near_duplicates(docs_table(spark, rows, extra=True)))
    assert got == brute.near_groups(rows)


def test_join_with_tiny_buckets_and_blocks(spark, monkeypatch):
    for name, value in (("BUCKET", 4), ("BLOCK_DOCS", 3), ("BLOCK_SHINGLES", 500)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = near_rows()
    assert joined(jaccard_join.near_duplicates(docs_table(spark, rows))) == brute.near_groups(rows)


def test_join_keeps_one_of_each_class(spark):
    rows = near_rows() + EDGES
    docs = docs_table(spark, rows, extra=True)
    out = jaccard_join.drop_near_copies(docs)
    found = jaccard_join.near_duplicates(docs).collect()
    classes = {r.class_id for r in found if r.class_id is not None}
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert len([i for i in ids if i is not None and i >= 100]) == len([c for c in classes if c >= 100])
    assert ids.count(5) <= 1 and ids.count(4) + ids.count(5) + ids.count(6) == 1


def test_candidates_reach_the_recall(spark):
    rows = near_rows()
    texts = docs_table(spark, rows).selectExpr("doc_id", "text")
    classes = jaccard_join.sketches(texts).where("shingles > 0").selectExpr("doc_id as node", "sketch")
    groups = {r.node: r.component for r in components(jaccard_join.candidate_links(classes, 0.8, 0.999)).collect()}
    sets = {i: brute.shingles(t) for i, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0]
    met = sum(groups.get(a, a) == groups.get(b, b) for a, b in pairs)
    assert len(pairs) > 500 and met >= 0.99 * len(pairs)


def test_shingle_sets_cut_like_the_words():
    texts = [t or "" for _, t in EDGES] + ["A b\tC  d e F g", "a B c D e f G"]
    _, counts = word_hashes(texts)
    assert counts.tolist() == [len(brute.WORD.findall(t)) for t in texts]
    sets = shingle_sets(texts, 5)
    assert [len(s) for s in sets] == [len(brute.shingles(t)) for t in texts]
    assert sets[-1].tolist() == sets[-2].tolist()


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5), (2001, 2000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(201)}, **{1000 + k: 1000 for k in range(300)}, 2000: 2000, 2001: 2000}


def removed(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_repeats_match_all_strings(spark):
    draw = random.Random(6)
    letters = "abcd efgh\n"
    make = lambda n: "".join(draw.choice(letters) for _ in range(n))
    p, q = make(130), make(99)
    rows = [(1, p + make(50)), (2, make(30) + p), (3, make(20) + q + make(9)), (4, q + make(40)), (5, "a" * 400), (6, None), (7, "")]
    rows += [(8, "ab" * 300), (9, make(5) + "a" * 150 + "é" * 80), (10, p[3:110] + p[20:]), (11, p * 3), (12, "é" * 200)]
    rows += [(100 + k, make(60) + p[k : k + 115] + make(60)) for k in range(30)]
    assert removed(suffix_dedup.removal_digests(docs_table(spark, rows, extra=True))) == brute.repeated_bytes(rows)


def test_repeats_in_texts_longer_than_a_slice(spark, monkeypatch):
    draw = random.Random(7)
    long = "".join(draw.choice("abcdefgh ") for _ in range(1_300_000))
    rows = [(1, long), (2, long[500_000:700_000] + "X" + long[100:400_000])]
    assert removed(suffix_dedup.removal_digests(docs_table(spark, rows))) == brute.repeated_bytes(rows)


def test_repeats_with_null_and_repeated_ids(spark):
    draw = random.Random(8)
    t = "".join(draw.choice("abcdef ") for _ in range(300))
    rows = [(3, t), (3, t), (None, t), (None, t), (None, None), (1, "x" + t)]
    got = {}
    for r in suffix_dedup.removal_digests(docs_table(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r.n_removed)
    assert got[1] == [0] and got[3] == [300, 300] and sorted(got[None]) == [0, 300, 300]


def test_interleave_refinement_orders_like_sorting():
    draw = np.random.default_rng(9)
    symbols = draw.integers(1, 3, (suffix_dedup.SPREAD + suffix_dedup.LENGTH, 60)).astype(np.uint8)
    symbols[:, 30:45] = symbols[:, 5:6]
    symbols[:10, 35:] = 0
    marks = suffix_dedup.repeated_strings(symbols)
    for o in range(suffix_dedup.SPREAD + 1):
        window = symbols[suffix_dedup.SPREAD - o :][: suffix_dedup.LENGTH].T
        seen, want = set(), []
        for row in window:
            key = row.tobytes()
            want.append(key in seen and 0 not in row)
            seen.add(key)
        assert marks[o].tolist() == want


def test_elias_fano_finds_successors():
    draw = np.random.default_rng(1)
    for n, universe in ((0, 10), (1, 1), (50, 64), (1000, 2**20), (777, 2**64)):
        values = np.unique(draw.integers(0, universe, n, dtype=np.uint64, endpoint=False)) if n else np.zeros(0, np.uint64)
        ef = EliasFano(EliasFano.pack(values, universe))
        if len(values):
            assert (ef.get(np.arange(len(values))) == values).all()
        asked = np.append(draw.integers(0, universe, 500, dtype=np.uint64, endpoint=False), values)
        rank, equal = ef.successor(asked)
        assert (rank == np.searchsorted(values, asked)).all()
        assert (equal == np.isin(asked, values)).all()


def check_scores(got, want):
    for i, (held, n, known, total, base, score) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert abs(r.score - score) / n < 0.05


def test_scores_match_counting(spark):
    rows = near_rows() + ONE_ID
    table = docs_table(spark, rows, extra=True)
    got = {r.doc_id: r for r in lm_score.score(table, shards=5).collect()}
    check_scores(got, brute.model_scores(rows))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_do_not_depend_on_batches(spark, monkeypatch):
    rows = near_rows()
    monkeypatch.setattr(lm_score, "BATCH_CHARS", 500)
    got = {r.doc_id: r for r in lm_score.score(docs_table(spark, rows), shards=3).collect()}
    check_scores(got, brute.model_scores(rows))


def test_scores_with_odd_ids(spark):
    got = lm_score.score(docs_table(spark, EDGES)).collect()
    assert len(got) == len(EDGES) and all(r.n_tokens >= 1 for r in got)


TEXTS = [t for _, t in EDGES] + ["a" * 3000, "ab" * 500, "\n" * 700 + "x", "x" * 257, "é" * 200, "don't I'LL 12345 中文 кот　 "]


def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(byte_bpe.read_ranks(PATH)), special_tokens={})


def test_encoding_equals_the_library(spark):
    rows = list(enumerate(TEXTS))
    docs = docs_table(spark, rows, extra=True)
    ours = {r.doc_id: list(r.ids) for r in byte_bpe.encode(docs, PATH, P.PATTERN).collect()}
    lib = library()
    assert ours == {k: lib.encode_ordinary(t or "") for k, t in rows}
    back = byte_bpe.decode(byte_bpe.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert {r.doc_id: bytes(r.data) for r in back.collect()} == {k: (t or "").encode() for k, t in rows}
    digests = {r.doc_id: tuple(r)[1:] for r in byte_bpe.round_trip(docs, PATH, P.PATTERN).collect()}
    want = {k: (len(i), brute.sha(",".join(map(str, i))), brute.sha(rows[k][1] or "")) for k, i in ours.items()}
    assert digests == want


def test_matrix_and_heap_give_the_same(monkeypatch):
    codec = byte_bpe.Codec(byte_bpe.read_ranks(PATH), P.PATTERN)
    draw = random.Random(2)
    pieces = ["".join(draw.choice("abetionré中") for _ in range(draw.randint(1, 200))) for _ in range(300)]
    lib = library()
    codec.pieces(pieces)
    assert all(codec._heap(p.encode()) == list(codec.known[p]) for p in pieces)
    assert all(lib.decode(list(codec.known[p])) == p for p in pieces)


def test_empty_tables(spark):
    empty = docs_table(spark, [])
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.drop_near_copies(empty).count() == 0
    assert suffix_dedup.removal_digests(empty).count() == 0
    assert lm_score.score(empty).count() == 0
    assert byte_bpe.round_trip(empty, PATH, P.PATTERN).count() == 0
