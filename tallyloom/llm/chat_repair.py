"""Repair of conversation structure at the least cost, by branch-and-bound.

What decides a repair is one sign per turn: its role's first letter, whether it must go
(blank or said before) and whether it is cut off. The search goes through a run of such
signs depth first. A node is a place in the run and what the roles so far allow next; the
stack is explicit; the costs that the remaining turns have in any case bound a node from
below; the incumbent is the best (cost, audit) found; a table per node holds the best prefix
that reached it, and a prefix that is no better is dropped. When the stack is empty, the
incumbent is proved best.

Two prefixes of equal cost at one node are never prefixes of each other, as one turn more or
less means another node and an insertion costs. So the smaller audit stays the smaller one
whatever follows, which makes the tables exact, and lets runs be searched apart: a
conversation is cut into runs of RUN turns, each is searched from and to every state, and
the runs are joined in order. Turns are range-partitioned by place for the search, so a
conversation of any length is searched by many tasks. Its digest needs its texts in order:
they stream through one task, sorted, which holds one batch of turns at a time.

Defined results: null role and text are one space, null ids and turns one space in the key of
the damage; null turns come first; turns of one number come in order of role, then of the MD5
of the text; rows equal in all of these are adjacent copies; rows with a null conversation
are one conversation; roles other than system, user and assistant count by their first letter
too; a conversation that has lost all rows gets zeros, an empty audit and the digest of the
empty string; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import same
from tallyloom.sources.stage import stage

RUN = 48
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
# States: nothing yet, after system, after user, after assistant. The first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
LEGAL = ("su", "ua", "au")
# Signs: x must go; s, u, a, o (other) are whole turns, S, U, A, O cut-off ones.
SIGNS = "suao"


def _edits(sign: str, state: int):
    """(cost, letter, next state) of the edits of one turn, cheapest first."""
    if sign == "x":
        return ((DELETE, "D", state),)
    extra = CUT_OFF if sign.isupper() else 0
    role, after = NEXT[state]
    out = [(DELETE, "D", state), (REROLE + extra, "R", after)]
    if sign.lower() == role:
        out.append((KEEP + extra, "K", after))
    elif sign.lower() == "s" and state == START:
        out.append((KEEP + extra, "K", SYSTEM))
    return tuple(sorted(out))


EDITS = {(sign, state): _edits(sign, state) for sign in "x" + SIGNS + SIGNS.upper() for state in range(4)}
# What a turn costs at least, wherever it stands.
LEAST = {sign: min(EDITS[sign, state][0][0] for state in range(4)) for sign in "x" + SIGNS + SIGNS.upper()}


@lru_cache(100_000)
def search(signs: str, start: int, ends: tuple[int, ...]) -> tuple[int, str, int] | None:
    """The least (cost, audit) from a state to one of the end states, and the end state reached."""
    n = len(signs)
    bound = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        bound[i] = bound[i + 1] + LEAST[signs[i]]
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    best: tuple[int, str] | None = None
    reached = None
    stack = [(0, "", 0, start)]
    while stack:
        cost, audit, i, state = stack.pop()
        if best is not None and cost + bound[i] > best[0]:
            continue
        known = seen.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        seen[i, state] = cost, audit
        if i == n and state in ends and (best is None or (cost, audit) < best):
            best, reached = (cost, audit), state
        # pushed in reverse, so that the cheapest edit is tried first
        stack.append((cost + INSERT, audit + "I", i, NEXT[state][1]))
        if i < n:
            for more, letter, after in reversed(EDITS[signs[i], state]):
                stack.append((cost + more, audit + letter, i + 1, after))
    return None if best is None else (*best, reached)


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the key of each row decides."""
    space = F.lit(" ")
    named = lambda c: F.coalesce(c.cast("string"), space)
    rows = turns.select(
        turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"),
        F.coalesce(turns[role_col], space).alias("role"), F.coalesce(turns[text_col], space).alias("text"),
    )
    kind = F.crc32(F.concat(named(F.col("conv_id")), F.lit(":"), named(F.col("turn")))) % 20
    hit = rows.withColumn("_kind", kind).where("_kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, F.lit(""))
        .when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return hit.drop("_copy")


def judged(rows: DataFrame) -> DataFrame:
    """The rows with digest of the text, fault of the text alone, and whether role and text stand in an earlier turn."""
    body = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    last = F.substring(body, -1, 1)
    rows = rows.select(
        "*", F.md5("text").alias("digest"), (body == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut_off")
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = rows.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    often = said.where(F.col("first") < F.col("last")).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first"
    )
    found = rows.join(often, same(rows, often, [("conv_id", "_conv"), ("role", "_role"), ("digest", "_digest")]), "left")
    return found.select("conv_id", "turn", "role", "text", "digest", "blank", "cut_off", F.coalesce(place > F.col("first"), F.lit(False)).alias("later"))


def _sign(role: str, fault: str) -> str:
    sign = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return {"blank": "x", "duplicate": "x", "truncated": sign.upper(), "": sign}[fault]


def _fault(row: dict, before: tuple | None) -> str:
    """The first fault of a turn; copies of one turn are adjacent."""
    if row["blank"]:
        return "blank"
    if row["later"] or before == (row["turn"], row["role"], row["digest"]):
        return "duplicate"
    return "truncated" if row["cut_off"] else ""


ORDER = ("conv_id", "turn", "role", "digest")


ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _arrow(told: str) -> pa.Schema:
    """The Arrow schema of a table told as "name type, ..."."""
    table = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    pairs = [c.split(" ") for c in told.split(", ")]
    return pa.schema([(name, ARROW.get(kind, table)) for name, kind in pairs])


def _searched(signs: str, alone: bool) -> list[dict]:
    """Best edits of a run: of a whole conversation, or else from and to every state."""
    if alone:
        cost, audit, end = search(signs, START, ENDS)
        return [{"start": START, "end": end, "cost": cost, "audit": audit}]
    found = [(s, search(signs, s, (e,))) for s in range(4) for e in range(4)]
    return [{"start": s, "end": f[2], "cost": f[0], "audit": f[1]} for s, f in found if f is not None]


def _runs(rows: DataFrame) -> DataFrame:
    """Runs of up to RUN turns in order: (conv_id, slice, run, first, last, counts of faults, found)."""
    kind = dict(rows.dtypes)["conv_id"]
    told = f"conv_id {kind}, slice int, run int, first string, last string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    found = "found array<struct<start:int,end:int,cost:bigint,audit:string>>"
    schema = _arrow(f"{told}, {found}")

    def run(parts):
        here, number, held, faults, before, inner = TaskContext.get().partitionId(), 0, [], [], None, False

        def close(alone):
            nonlocal number
            number += 1
            initials = [r["role"][:1] for r in held]
            return {
                "conv_id": held[0]["conv_id"], "slice": here, "run": number, "first": initials[0], "last": initials[-1],
                "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
                "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
                "found": _searched("".join(_sign(r["role"], f) for r, f in zip(held, faults)), alone),
            }

        for part in parts:
            out = []
            for row in part.to_pylist():
                other = bool(held) and row["conv_id"] != held[0]["conv_id"]
                if other or len(held) == RUN:
                    # the first and the last conversation of a task may go on in another one
                    out.append(close(alone=other and inner))
                    held, faults, inner = [], [], other
                    before = None if other else before
                faults.append(_fault(row, before))
                held.append(row)
                before = row["turn"], row["role"], row["digest"]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist([close(alone=False)], schema)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select(*ORDER, "blank", "cut_off", "later")
    return narrow.repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, f"{told}, {found}")


def _extend(live: dict[int, tuple[int, str]], found: list[dict]) -> dict[int, tuple[int, str]]:
    """The best (cost, audit) per state after one run more."""
    out: dict[int, tuple[int, str]] = {}
    for f in found:
        if f["start"] in live:
            cost, audit = live[f["start"]]
            total = cost + f["cost"], audit + f["audit"]
            if f["end"] not in out or total < out[f["end"]]:
                out[f["end"]] = total
    return out


def repairs(rows: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) of the conversations that have rows."""
    kind = dict(rows.dtypes)["conv_id"]
    told = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", cost bigint, audit string"
    schema = _arrow(told)

    def run(parts):
        current = None

        def close():
            cost, audit = min(live[e] for e in ENDS if e in live)
            return {"conv_id": current["conv_id"], **counts, "cost": cost, "audit": "".join([*settled, audit])}

        for part in parts:
            out = []
            for row in part.to_pylist():
                if current is None or row["conv_id"] != current["conv_id"]:
                    if current is not None:
                        out.append(close())
                    live, settled, counts = {START: (0, "")}, [], dict.fromkeys(COUNTS, 0)
                else:
                    counts["illegal"] += current["last"] + row["first"] not in LEGAL
                for c in COUNTS:
                    counts[c] += row[c]
                live, current = _extend(live, row["found"]), row
                shared = os.path.commonprefix([a for _, a in live.values()])
                if shared:
                    settled.append(shared)
                    live = {s: (c, a[len(shared) :]) for s, (c, a) in live.items()}
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([close()], schema)

    place = ["conv_id", "slice", "run"]
    return _runs(rows).repartition("conv_id").sortWithinPartitions(*place).mapInArrow(run, told)


def repaired_lines(turns, audit: str):
    """The lines `role:text` of (role, text) turns in order under an audit; deleted turns need no text."""
    names = {"u": "user", "a": "assistant"}
    state, letters = START, iter(audit)

    def inserted():
        nonlocal state
        for letter in letters:
            if letter != "I":
                return letter
            role, state = NEXT[state]
            yield f"{names[role]}:"

    for role, text in turns:
        letter = yield from inserted()
        if letter == "K":
            state = SYSTEM if role[:1] == "s" else NEXT[state][1]
            yield f"{role}:{text}"
        elif letter == "R":
            given, state = NEXT[state]
            yield f"{names[given]}:{text}"
    yield from inserted()


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the texts of a conversation stream through one task in order, behind its audit."""
    kind = dict(rows.dtypes)["conv_id"]
    told = f"conv_id {kind}, repaired_sha256 string"
    schema = _arrow(told)

    def told_of(turns, audit):
        sha, first = hashlib.sha256(), True
        for line in repaired_lines(turns, audit):
            sha.update(line.encode() if first else b"\n" + line.encode())
            first = False
        return sha.hexdigest()

    def run(parts):
        stream = (row for part in parts for row in part.to_pylist())
        for conv, group in groupby(stream, key=lambda r: (r["conv_id"],)):
            audit = next(group)["audit"]
            digest = told_of(((r["role"], r["text"]) for r in group), audit)
            yield pa.RecordBatch.from_pylist([{"conv_id": conv[0], "repaired_sha256": digest}], schema)

    text = F.when(~F.col("blank") & ~F.col("later"), F.col("text")).alias("text")
    turns = rows.select(*ORDER, text, F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in turns.dtypes if c not in ("conv_id", "audit")], "audit")
    both = turns.unionByName(heads).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.col("audit").isNull(), *ORDER[1:]).mapInArrow(run, told)


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = stage(judged(damaged(turns, conv_col, turn_col, role_col, text_col)))
    every = turns.select(turns[conv_col].alias("conv_id")).distinct()
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = rows.groupBy(F.col("conv_id").alias("_conv")).agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    found = stage(repairs(rows))
    out = every.join(gaps, same(every, gaps, [("conv_id", "_conv")]), "left").drop("_conv")
    for more in (found, digests(rows, found.select("conv_id", "audit"))):
        named = more.withColumnRenamed("conv_id", "_conv")
        out = out.join(named, same(out, named, [("conv_id", "_conv")]), "left").drop("_conv")
    empty = {**dict.fromkeys(("gaps", *COUNTS, "cost"), 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return out.select("conv_id", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in empty.items()])
