"""Sharding, source divergence and conversation repair against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from brute import EDGES, docs_table, sha

from tallyloom.llm import chat_repair, divergence, sharding
from tallyloom.sources.stage import stage_path


def check_shards(rows, got, shards):
    sizes = {(i, t): (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows}
    want = Counter((i, *sizes[i, t]) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    loads, places = Counter(), defaultdict(list)
    for r in got:
        loads[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert set(loads) <= set(range(shards)) and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(loads.values()) <= sum(loads.values()) / shards + max(s for s, _ in sizes.values())


def test_shards_are_near_equal_and_gapless(spark):
    rows = EDGES + [(100 + k, "w" * (k * 37 % 400)) for k in range(500)]
    check_shards(rows, sharding.shard_documents(docs_table(spark, rows, extra=True)).collect(), 16)


def test_shards_of_an_empty_table(spark):
    assert sharding.shard_documents(docs_table(spark, [(1, "a")]).where("doc_id < 0")).collect() == []


def test_a_third_of_all_rows_may_be_one_record(spark):
    rows = [(7, "same")] * 100 + [(k, f"text {k}") for k in range(200)]
    check_shards(rows, sharding.shard_documents(docs_table(spark, rows)).collect(), 16)


def test_map_versions_move_few_slots(spark):
    rows = [(k, "w" * (k * 37 % 400)) for k in range(3000)]
    docs = docs_table(spark, rows)
    records = sharding.record_slots(docs, slots=1024)
    folder = stage_path(spark, "test-map")
    sharding.save_map(sharding.first_map(spark, 1024, 16), folder, 0)
    sharding.save_map(sharding.edited_map(sharding.load_map(spark, folder), sharding.slot_loads(records), 16), folder, 1)
    sharding.save_map(sharding.edited_map(sharding.load_map(spark, folder), sharding.slot_loads(records), 17), folder, 2)
    maps = [{r.vslot: r.shard for r in sharding.load_map(spark, folder, v).collect()} for v in range(3)]
    assert all(len(m) == 1024 for m in maps) and set(maps[2].values()) == set(range(17))
    assert maps[2] == {r.vslot: r.shard for r in sharding.load_map(spark, folder).collect()}
    moved = sum(maps[1][s] != maps[2][s] for s in maps[1])
    assert moved < 1024 / 4
    loads = Counter()
    for r in sharding.slot_loads(records).collect():
        loads[maps[2][r.vslot]] += r.bytes
    assert max(loads.values()) - min(loads.values()) <= 0.05 * sum(loads.values()) / 17


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows):
    """All rows of the audit from (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        groups[lang].add(source)
        terms = TERM.findall(text.translate(brute.FOLD))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k + 1) for k, (t, v) in enumerate(ranked) if part == "pair" or k < 200]
    return sorted(out)


def audit(spark, rows, monkeypatch=None):
    table = spark.createDataFrame(rows, "lang string, source string, text string")
    table = table.selectExpr("*", "1 as batch", "2 as term", "'x' as docs", "'y' as `a.b`")
    return sorted(tuple(r) for r in divergence.divergence(table).collect())


def test_divergence_matches_python(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BATCH_BYTES", 2000)
    pick = random.Random(5)
    words = ["the", "The", "the,", "of", "don't", "Straße", "ÀÉ", "naïve", "😀x", "a-b-a", "...", " nb", "x1y2", "\x00z", "zz"]
    rows = [(pick.choice(["en", "de", None]), pick.choice(["a", "b", "c", None]), " \t\n".join(pick.choices(words, k=pick.randint(0, 40)))) for _ in range(200)]
    rows += [("en", "a", None), ("en", "z", ""), ("fr", "a", "alone"), ("fr", "b", None), ("en", "a", "rare " * 5000), ("en", "b", "q.w." * 20000)]
    rows += rows[:20]
    assert audit(spark, rows) == plain_divergence(rows)


def test_divergence_of_an_empty_table(spark):
    assert divergence.divergence(docs_table(spark, [(1, "a")]).where("doc_id < 0")).collect() == []


def test_shares_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    cases = [(0, 0, 1), (5, 5, 0), (0, 10**15, 7), (10**15, 10**15, 1), (10**14 + 12345, 8 * 10**15, 10**9), (3, 10, 4)]
    table = spark.createDataFrame(cases, "c long, n long, v long")
    got = table.select(divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (c + 1) // (n + v) for c, n, v in cases]


def plain_best(signs, start=0, ends=(0, 3)):
    """Least (cost, audit) by going through all states turn by turn."""
    live = {start: (0, "")}

    def put(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def insert(table):
        for _ in range(2):
            more = dict(table)
            for state, (cost, done) in table.items():
                put(more, 3 if state == 2 else 2, (cost + 5, done + "I"))
            table = more
        return table

    for sign in signs:
        after = {}
        for state, (cost, done) in insert(live).items():
            put(after, state, (cost + 2, done + "D"))
            if sign != "x":
                cut = 5 * sign.isupper()
                role, to = ("a", 3) if state == 2 else ("u", 2)
                put(after, to, (cost + 1 + cut, done + "R"))
                if sign.lower() == role:
                    put(after, to, (cost + cut, done + "K"))
                if sign.lower() == "s" and state == 0:
                    put(after, 1, (cost + cut, done + "K"))
        live = after
    found = [v for s, v in insert(live).items() if s in ends]
    return min(found) if found else None


@pytest.mark.parametrize("alphabet", ["suaoxSUAO", "ua", "uaUA", "uax", "oO", "s"])
def test_search_is_the_best(alphabet):
    pick = random.Random(alphabet)
    for n in (0, 1, 2, 3, 5, 8, 13, 30):
        for _ in range(20):
            signs = "".join(pick.choices(alphabet, k=n))
            for start, ends in ((0, (0, 3)), (2, (3,)), (3, (2,)), (1, (1,)), (0, (1,))):
                got = chat_repair.search(signs, start, ends)
                assert (None if got is None else got[:2]) == plain_best(signs, start, ends)


def plain_repair(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)} of (conv, turn, role, text)."""
    import hashlib

    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            turns += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest()))
        faults, said = [], set()
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in said else "truncated" if body[-1] not in ".!?" else "")
            said.add((role, text))
        initials = [t[1][:1] for t in turns]
        letter = [i if i in ("s", "u", "a") else "o" for i in initials]
        signs = "".join("x" if f in ("blank", "duplicate") else i.upper() if f else i for i, f in zip(letter, faults))
        cost, done = plain_best(signs)
        lines, state, k = [], 0, 0
        for e in done:
            role, to = ("assistant", 3) if state == 2 else ("user", 2)
            if e == "I":
                lines.append(f"{role}:")
                state = to
                continue
            if e == "K":
                lines.append(f"{turns[k][1]}:{turns[k][2]}")
                state = 1 if turns[k][1][:1] == "s" else to
            elif e == "R":
                lines.append(f"{role}:{turns[k][2]}")
                state = to
            k += 1
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, done, sha("\n".join(lines)))
    return out


TURNS = "conv_id long, turn long, role string, text string"


def repaired(spark, rows):
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as slice", "'x' as audit", "2 as first", "3 as `a.b`", "4 as _conv")
    got = chat_repair.repair(table).collect()
    assert len(got) == len({r[0] for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_repair_matches_python(spark, monkeypatch):
    monkeypatch.setattr(chat_repair, "RUN", 6)
    pick = random.Random(3)
    texts = ["Yes.", "No!", "well", "", None, " \t\n", "Why? ", "naïve ÀÉ 😀.", "x" * 5000 + ".", "cut, ", "Yes.\n"]
    rows = [
        (conv if conv < 40 else None, pick.choice([t, t, t, t + 1, None]), pick.choice(["user", "assistant", "system", "tool", None, "", "User"]), pick.choice(texts))
        for conv in range(42) for t in range(pick.randint(0, 30))
    ]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for t in range(400)]  # longer than a run, over several tasks
    rows += [(101, 5, "user", "same.")] * 60 + [(102, None, "user", "same.")] * 3 + [(103, 0, None, None)]
    rows += rows[:30]
    assert repaired(spark, rows) == plain_repair(rows)


def test_repair_of_conversations_that_lose_all_rows(spark):
    lost = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert len(lost) > 5
    assert set(repaired(spark, lost).values()) == {(0, 0, 0, 0, 0, 0, "", sha(""))}


def test_repair_of_an_empty_table(spark):
    assert chat_repair.repair(spark.createDataFrame([], TURNS)).collect() == []
