"""Audit of how far the sources of a language differ, by chunk factorization.

Texts are cut at blanks only, and the chunks of each document counted, in batches of about
BATCH_BYTES: a list of the different chunks of the batch, and its documents as numbers in
that list with counts. Chunks of all batches meet once; each globally different one is split
into terms there, and only there. The terms then go back to the batches that asked for them
(a chunk that is a term itself needs no answer), where they replace the chunk numbers, so that one term from several chunks of a document
counts that document once. A batch sends on one row per group and term; sums over batches
give documents and occurrences of every term in every (lang, source).

A batch holds whole documents, so no document is counted twice, and a chunk or term that is
everywhere costs one narrow row per batch. What is kept of a term as an array has one entry
per source of its language, and the result has one row per pair of these.

A share is p = 1 + floor(10^9 (count + 1) / (N + V)), V the kept terms of the language (those
in MIN_DOCS of its documents), N the sum of their counts. It comes from a long division in
three steps, exact while N + V is below 9 * 10^15.

Defined results: a null text, lang or source is the empty string; every row is a document of
its own, repeated ids and rows too; a group without terms has count 0 everywhere; a language
without kept terms has pairs with value 0; ties of value go by the item's bytes; a long text
is a batch of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.lm_score import pack, unpack
from tallyloom.sources.stage import stage

# A term is a run of letters A-Z, folded, and characters beyond ASCII; all other bytes become blanks.
NO_TERM = bytes(b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))
BATCH_BYTES = 32_000_000
MIN_DOCS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
# Cells of a block of terms and sources that is worked on at a time.
CELLS = 2_000_000


def _batches(docs: DataFrame) -> DataFrame:
    """(batch, blob): the groups, chunks and documents of a batch, as one compressed value."""
    schema = pa.schema([("batch", pa.int64()), ("blob", pa.binary())])

    def packed(ids, groups, group_of, found):
        order = sorted(range(len(found)), key=group_of.__getitem__)  # documents of a group stand together
        chunk = np.concatenate([found[k][0] for k in order]).astype(np.int32)
        blob = pack(
            np.frombuffer(json.dumps(list(groups)).encode(), np.uint8), np.frombuffer(b"\n".join(ids), np.uint8),
            np.array([group_of[k] for k in order], np.int32), np.array([len(found[k][0]) for k in order], np.int32),
            np.diff(chunk, prepend=np.int32(0)), np.concatenate([found[k][1] for k in order]).astype(np.int32),
        )
        return pa.RecordBatch.from_pylist([{"batch": uuid.uuid4().int >> 65, "blob": blob}], schema)

    def run(parts):
        def start():
            ids, groups = defaultdict(), defaultdict()
            ids.default_factory, groups.default_factory = ids.__len__, groups.__len__
            return ids, groups, [], []

        held, size = start(), 0
        for part in parts:
            texts = part.column("text").cast(pa.binary())
            for text, *group in zip(texts, part.column("lang").to_pylist(), part.column("source").to_pylist()):
                ids, groups, group_of, found = held
                raw = text.as_py()
                group_of.append(groups[tuple(group)])
                # bytes are split at the six ASCII blanks
                found.append(np.unique(np.array([ids[c] for c in raw.split()], np.int32), return_counts=True))
                size += len(raw) + 1
                if size >= BATCH_BYTES:
                    yield packed(*held)
                    held, size = start(), 0
        if held[-1]:
            yield packed(*held)

    return docs.mapInArrow(run, "batch long, blob binary")


def _unpacked(blob: bytes) -> tuple:
    """Groups, chunks, and per document its group, number of chunks, chunks and counts."""
    named, chunks, group_of, many, chunk, n = unpack(blob, np.uint8, np.uint8, np.int32, np.int32, np.int32, np.int32)
    own = chunks.tobytes().split(b"\n") if len(chunks) else []
    return json.loads(named.tobytes()), own, group_of, many, np.cumsum(chunk, dtype=np.int32), n


def _chunks(batches: DataFrame) -> DataFrame:
    """(chunk, batch, id) of the different chunks of each batch."""
    schema = pa.schema([("chunk", pa.string()), ("batch", pa.int64()), ("id", pa.int32())])

    def run(parts):
        for part in parts:
            for number, blob in zip(part.column("batch").to_pylist(), part.column("blob")):
                own = _unpacked(blob.as_py())[1]
                for at in range(0, len(own), 50_000):
                    some = pa.array(own[at : at + 50_000], pa.binary()).cast(pa.string())
                    place = np.arange(at, at + len(some), dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([some, pa.array(np.full(len(some), number)), pa.array(place)], schema=schema)

    return batches.mapInArrow(run, "chunk string, batch long, id int")


def _answers(asked: DataFrame) -> DataFrame:
    """(batch, id, terms) from (chunk, batch, id): chunks come sorted, and each different one is split once.

    A chunk is in one partition with one narrow row per batch. Terms are joined with blanks;
    a chunk that is one term and nothing else needs no answer. Bytes of terms are letters and
    all of characters beyond ASCII, so bytes can be split as characters would be.
    """
    schema = pa.schema([("batch", pa.int64()), ("id", pa.int32()), ("terms", pa.string())])

    def run(parts):
        last, terms = None, b""
        for part in parts:
            chunks = part.column("chunk").cast(pa.binary())
            changed = np.append(True, pc.not_equal(chunks[1:], chunks[:-1]).to_numpy(zero_copy_only=False))
            heads = chunks.filter(pa.array(changed)).to_pylist()
            found = [terms if k == 0 and c == last else b" ".join(c.lower().translate(NO_TERM).split()) for k, c in enumerate(heads)]
            if found:
                last, terms = heads[-1], found[-1]
            place = np.cumsum(changed) - 1
            told = np.array([c != t for c, t in zip(heads, found)], bool)[place]
            every = pa.array(found, pa.binary()).cast(pa.string()).take(pa.array(place))
            yield pa.RecordBatch.from_arrays([part.column("batch"), part.column("id"), every], schema=schema).filter(pa.array(told))

    return asked.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, "batch long, id int, terms string")


def _batch_counts(batches: DataFrame) -> DataFrame:
    """(lang, source, term, docs, occurrences) of every batch."""
    answers = _answers(_chunks(batches))
    none = F.lit(None)
    documents = batches.select("batch", none.cast("int").alias("id"), none.cast("string").alias("terms"), "blob")
    both = documents.unionByName(answers.withColumn("blob", none.cast("binary")))
    dealt = both.repartition("batch").sortWithinPartitions("batch", F.col("blob").isNull())
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("occurrences", pa.int64())])

    def counted(blob, ids, answers):
        groups, own, group_of, many, chunk, n = _unpacked(blob)
        lists = [t.split() for t in answers]
        coded = pa.array([*own, *[t for terms in lists for t in terms]], pa.binary()).dictionary_encode()
        names, codes = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
        # where the terms of each chunk stand among the codes, and how many they are
        first, size = np.arange(len(own)), np.ones(len(own), np.int64)
        size[ids] = [len(terms) for terms in lists]
        first[ids] = len(own) + np.cumsum(size[ids]) - size[ids]
        ends = np.cumsum(many)
        starts = np.append(np.flatnonzero(np.append(True, np.diff(group_of) != 0)), len(group_of))
        for a, b in zip(starts, starts[1:]):
            part = slice(ends[a] - many[a], ends[b - 1])
            times = size[chunk[part]]
            inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            if not len(inside):
                continue
            found = codes[np.repeat(first[chunk[part]], times) + inside].astype(np.int64)
            key = found * (b - a) + np.repeat(np.repeat(np.arange(b - a), many[a:b]), times)
            order = np.argsort(key)
            key, weight = key[order], np.repeat(n[part], times)[order].astype(np.int64)
            term = key // (b - a)
            new_doc = np.append(True, key[1:] != key[:-1]).astype(np.int64)
            heads = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
            lang, source = groups[group_of[a]]
            whole = pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(heads), pa.string()), pa.array([source] * len(heads), pa.string()), names.take(pa.array(term[heads])),
                    pa.array(np.add.reduceat(new_doc, heads)), pa.array(np.add.reduceat(weight, heads)),
                ],
                schema=schema,
            )
            for k in range(0, len(whole), 50_000):
                yield whole.slice(k, 50_000)

    def run(parts):
        current, blob, ids, answers = None, None, [], []
        for part in parts:
            numbers = part.column("batch").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                piece = part.slice(a, b - a)
                if numbers[a] != current:
                    if current is not None:
                        yield from counted(blob, np.array(ids, np.int64), answers)
                    current, blob, ids, answers = numbers[a], piece.column("blob")[0].as_py(), [], []
                    piece = piece.slice(1)
                ids.extend(piece.column("id").to_pylist())
                answers.extend(piece.column("terms").cast(pa.binary()).to_pylist())
        if current is not None:
            yield from counted(blob, np.array(ids, np.int64), answers)

    return dealt.mapInArrow(run, "lang string, source string, term string, docs long, occurrences long")


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, docs, occurrences) over all documents."""
    read = docs.select(
        *[F.coalesce(docs[c].cast("string"), F.lit("")).alias(name) for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))]
    )
    # dealt by language and term, so that sums over sources need no further shuffle
    parts = _batch_counts(stage(_batches(read))).repartition("lang", "term")
    return parts.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("occurrences").alias("occurrences"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + kept)) in longs: a long division, three digits a step."""
    whole = total + kept
    out, rest = F.lit(0).cast("long"), count + 1
    parts = []
    for _ in range(3):
        parts.append(rest)
        rest = (rest * 1000) % whole
    for r in parts:
        out = out * 1000 + F.call_function("div", r * 1000, whole)
    return out + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value) from (lang, shares): sums over the terms for each pair of places in the array."""

    def sums(lang, shares):
        width = len(shares[0])
        step = max(1, CELLS // width)
        total = np.zeros((width, width), np.int64)
        for k in range(0, len(shares), step):
            p = np.stack(shares[k : k + step])
            for a in range(width):
                total[a] += ((p[:, a : a + 1] - p) ** 2 // p).sum(axis=0)
        for a in range(0, width, step):
            block = total[a : a + step]
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(block), "a": np.arange(a, a + len(block), dtype=np.int32), "sums": list(block)},
                pa.schema([("lang", pa.string()), ("a", pa.int32()), ("sums", pa.list_(pa.int64()))]),
            )

    def run(parts):
        for part in parts:
            by_lang = defaultdict(list)
            shares = part.column("shares")
            ends, values = shares.offsets.to_numpy(), shares.flatten().to_numpy()
            ends = ends - ends[0]
            for lang, a, b in zip(part.column("lang").to_pylist(), ends.tolist(), ends[1:].tolist()):
                by_lang[lang].append(values[a:b])
            for lang, lists in by_lang.items():
                yield from sums(lang, lists)

    found = rows.mapInArrow(run, "lang string, a int, sums array<long>")
    return found.select("lang", "a", F.posexplode("sums").alias("b", "value")).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part `pair`: how far the other sources of the language are from this one, summed over
    all kept terms. Part `term`: the terms that the source has more of than its language,
    the first `top` of them.
    """
    named = lambda c, name: F.coalesce(docs[c].cast("string"), F.lit("")).alias(name)
    groups = docs.select(named(lang_col, "lang"), named(source_col, "source")).distinct()
    per = F.collect_list(F.struct("source", "occurrences"))  # one entry per source of the language
    kept = stage(
        term_counts(docs, text_col, lang_col, source_col)
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("occurrences").alias("count"), F.map_from_entries(per).alias("per"))
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )
    single = kept.select("lang", "term", F.col("count").alias("lang_count"), F.explode("per").alias("source", "count"))
    totals = single.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("count").alias("lang_n"))
    sized = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n", "v", "lang_n"])
    sized = stage(sized)
    listed = sized.groupBy("lang").agg(F.first("v").alias("v"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"))

    shares = F.transform("groups", lambda g: share(F.coalesce(F.get(F.map_values("per"), F.array_position(F.map_keys("per"), g["source"]).cast("int") - 1), F.lit(0)), g["n"], F.col("v")))
    sums = _pair_sums(kept.join(listed, "lang").select("lang", shares.alias("shares")))
    own = listed.select("lang", "groups", F.posexplode("groups").alias("a", "own"))
    pairs = own.select("lang", "a", F.col("own.source").alias("source"), F.posexplode("groups").alias("b", "other")).where("a <> b")
    pairs = pairs.join(sums, ["lang", "a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other.source").alias("item"), F.coalesce("value", F.lit(0)).cast("long").alias("value")
    )

    scored = single.join(sized, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        share(F.col("count"), F.col("n"), F.col("v")).alias("p"), share(F.col("lang_count"), F.col("lang_n"), F.col("v")).alias("q"),
    )
    terms = scored.where("p > q").select("lang", "source", "part", "item", gap(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked = pairs.withColumn("rank", place).unionByName(terms.withColumn("rank", place).where(F.col("rank") <= top))
    return ranked
