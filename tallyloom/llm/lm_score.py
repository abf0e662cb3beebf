"""Scoring texts with an n-gram model kept in Elias-Fano tries.

Texts are turned into batches of about BATCH_CHARS characters: a dictionary of word hashes
and a stream of ids. A batch sends each trie shard the contexts that belong to it with
their different followers, once each however often they occur, and their counts in the
training documents. The shard adds up the counts of all batches, builds its trie, maps
it, looks up what each batch asked for and answers in the same order: counts, and one code
for each context and follower. The batch then sums up its documents. So a frequent word
costs a shard one entry per batch and follower, and no document is ever split.

The model has pairs of words: P(w | h) = discounted share of w after h + weight left over *
P(w), with P(w) = (c + 0.5) / (N + 0.5 (V + 1)). It sums to 1 over the known words and one
unknown one. All counts cover all training documents; nothing is cut off.

Defined results: a null or empty text has one token, its end; a null id counts as the text
"null" when documents are dealt into training and held-out ones; repeated rows are
documents of their own; a long text is a batch of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import text_of
from tallyloom.llm.hashing import chunks, mix, word_hashes
from tallyloom.llm.ngram_trie import Trie
from tallyloom.sources.stage import stage

BATCH_CHARS = 12_000_000
DISCOUNT = 0.75
FOLDS, HELD_OUT = 5, 1
# Hashes of the marks at the two ends of a text.
BEGIN, END = np.uint64(0x0B0B0B0B0B0B0B0B), np.uint64(0x0E0E0E0E0E0E0E0E)
KEY = np.uint64(2**48 - 1)
# A context is frequent from this share of all words on; the parts it is cut into.
FREQUENT, SPLIT = 1000, 16


def squeeze(a: np.ndarray) -> bytes:
    """An array as compressed byte planes, with its type and length in front."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    data = pa.compress(planes.tobytes(), codec="zstd", asbytes=True)
    return np.array([len(a), a.dtype.itemsize, len(data)], np.int64).tobytes() + data


def unsqueeze(raw: bytes, at: int, kind) -> tuple[np.ndarray, int]:
    n, width, size = np.frombuffer(raw, np.int64, 3, at).tolist()
    data = pa.decompress(raw[at + 24 : at + 24 + size], n * width, codec="zstd", asbytes=True) if n else b""
    planes = np.frombuffer(data, np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n), at + 24 + size


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join(map(squeeze, arrays))


def unpack(raw: bytes, *kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        a, at = unsqueeze(raw, at, kind)
        out.append(a)
    return out


def _batches(texts: DataFrame) -> DataFrame:
    """(batch, docs, held, blob, tokens, top): documents as ids into the words of the batch, most frequent first.

    A batch gets a random number: the table is written once, and only whole tasks enter it.
    """

    top = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))

    def row(ids, held, texts):
        parts = [word_hashes(texts[a:b]) for a, b in chunks(texts)]
        stream, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        words, place, count = np.unique(stream, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().int >> 65]), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
                pa.array([pack(sizes, words[order], rank[place])], pa.binary()), pa.array([len(stream)]),
                pa.array([[(int(words[k].view(np.int64)), int(count[k])) for k in order[: int((count * FREQUENT >= len(stream)).sum())]]], top),
            ],
            ["batch", "docs", "held", "blob", "tokens", "top"],
        )

    def run(batches):
        ids, held, texts, total = [], [], [], 0
        for batch in batches:
            for i, h, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
                if total and total + len(t) > BATCH_CHARS:
                    yield row(ids, held, texts)
                    ids, held, texts, total = [], [], [], 0
                ids.append(i)
                held.append(h)
                texts.append(t)
                total += len(t)
        if ids:
            yield row(ids, held, texts)

    return texts.mapInArrow(run, "batch long, docs array<long>, held array<boolean>, blob binary, tokens long, top array<struct<word:bigint,n:bigint>>")


class Asked:
    """What a batch asks of the shards, in a fixed order: by shard, context and follower.

    Every word is a context, a frequent one as SPLIT more; `word_of` tells the word of each.
    """

    def __init__(self, blob: bytes, held: list[bool], shards: int, frequent: np.ndarray):
        sizes, words, ids = unpack(blob, np.int64, np.uint64, np.uint32)
        hashes = np.append(words, [END, BEGIN])
        self.sizes = sizes
        m = len(words)
        n = len(ids) + 2 * len(sizes)
        # each document as BEGIN, its words, END
        self.heads = np.cumsum(sizes + 2) - (sizes + 2)
        seq = np.empty(n, np.int64)
        inner = np.ones(n, bool)
        inner[self.heads] = inner[self.heads + sizes + 1] = False
        seq[inner] = ids
        seq[self.heads], seq[self.heads + sizes + 1] = m + 1, m
        self.seq = seq
        cut = np.flatnonzero(np.isin(hashes, frequent))
        part = np.full(m + 2, -1)
        part[cut] = m + 2 + np.arange(len(cut)) * SPLIT
        word = np.concatenate([np.arange(m + 2), np.repeat(cut, SPLIT)])
        marks = mix(np.arange(1, SPLIT + 1, dtype=np.uint64))
        keys = np.concatenate([hashes, mix(np.repeat(hashes[cut], SPLIT) ^ np.tile(marks, len(cut)))])
        shard = (mix(keys) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((keys, shard))
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        self.shard, self.sorted, self.word_of, self.home = shard[order], keys[order], word[order], place[: m + 2]
        short = hashes & KEY
        by_key = np.argsort(short, kind="stable")
        follower = np.empty(m + 2, np.int64)
        follower[by_key] = np.arange(m + 2)
        last = np.zeros(n, bool)
        last[self.heads + sizes + 1] = True
        at = np.flatnonzero(~last)
        context, after = seq[at], seq[at + 1]
        side = (mix(hashes) % np.uint64(SPLIT)).astype(np.int64)
        unit = place[np.where(part[context] < 0, context, part[context] + side[after])]
        self.pairs, self.pair_of = np.unique(unit << 32 | follower[after], return_inverse=True)
        self.pair_context = self.pairs >> 32
        self.pair_key = short[by_key][self.pairs & 0xFFFFFFFF]
        self.training = np.repeat(~np.array(held, bool), sizes + 2)
        self.at = at

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of words and of pairs; BEGIN is no word."""
        words = np.bincount(self.home[self.seq[self.training]], minlength=len(self.sorted))
        words[self.home[-1]] = 0
        pairs = np.bincount(self.pair_of[self.training[self.at]], minlength=len(self.pairs))
        return words, pairs


def _requests(batches: DataFrame, shards: int, frequent: np.ndarray) -> DataFrame:
    """(shard, batch, asked): contexts, their counts and number of followers, followers and their counts."""

    def run(rows):
        for part in rows:
            for name, held, blob in zip(*(part.column(c).to_pylist() for c in ("batch", "held", "blob"))):
                asked = Asked(blob, held, shards, frequent)
                words, pairs = asked.counts()
                fan = np.bincount(asked.pair_context, minlength=len(words))
                cut = np.searchsorted(asked.shard, np.arange(shards + 1))
                upto = np.append(0, np.cumsum(fan))
                six = asked.pair_key.view(np.uint8).reshape(-1, 8)[:, :6]
                out = []
                for s in range(shards):
                    a, b = cut[s], cut[s + 1]
                    c, d = upto[a], upto[b]
                    if a < b:
                        keys = np.ascontiguousarray(six[c:d]).view("V6").reshape(-1)
                        out.append((s, name, pack(asked.sorted[a:b], words[a:b].astype(np.uint32), fan[a:b].astype(np.uint32), keys, pairs[c:d].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], ["shard", "batch", "asked"]
                )

    return batches.select("batch", "held", "blob").mapInArrow(run, "shard int, batch long, asked binary")


def _answers(requests: DataFrame) -> DataFrame:
    """(shard, batch, answer, tokens, words): the replies of each shard, and on a row without a batch its totals."""

    def shard_rows(shard, names, blobs):
        asked = [unpack(b, np.uint64, np.uint32, np.uint32, "V6", np.uint32) for b in blobs]
        keys = []
        for a in asked:
            wide = np.zeros((len(a[3]), 8), np.uint8)
            wide[:, :6] = a[3].view(np.uint8).reshape(-1, 6)
            keys.append(wide.view(np.uint64).reshape(-1))
        hashes, place = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        count = np.bincount(place, np.concatenate([a[1] for a in asked]), len(hashes)).astype(np.int64)
        context = np.concatenate([np.repeat(a[0], a[2]) for a in asked])
        key, seen = np.concatenate(keys), np.concatenate([a[4] for a in asked]).astype(np.int64)
        some = seen > 0
        context, key, seen = context[some], key[some], seen[some]
        order = np.lexsort((key, context))
        context, key, seen = context[order], key[order], seen[order]
        head = np.flatnonzero(np.append(True, (context[1:] != context[:-1]) | (key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        total = np.add.reduceat(seen, head) if len(head) else seen
        followed = np.bincount(np.searchsorted(hashes, context[head]), total, len(hashes)).astype(np.int64)
        with tempfile.TemporaryFile() as file:  # unlinked at once; pages of the task only
            trie = Trie.map(file, Trie.write(Trie.build(context[head], key[head], total, DISCOUNT), file))
            tables = np.concatenate([trie.table, trie.rest_table])
            at = 0
            for name, a, k in zip(names, asked, keys):
                rank, known = trie.context(a[0])
                fan = a[2].astype(np.int64)
                codes = trie.probability(np.repeat(rank, fan), np.repeat(known, fan), k)
                own = place[at : at + len(a[0])]
                at += len(a[0])
                yield shard, name, pack(count[own], followed[own], trie.left_over(rank, known), codes, tables), None, None
        yield shard, None, None, int(count.sum()), int((count > 0).sum())

    def run(batches):
        def table(rows):
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["shard", "batch", "answer", "tokens", "words"]
            )

        current, names, blobs = None, [], []
        for part in batches:
            for shard, name, blob in zip(*(part.column(c).to_pylist() for c in ("shard", "batch", "asked"))):
                if shard != current:
                    if names:
                        yield table(list(shard_rows(current, names, blobs)))
                    current, names, blobs = shard, [], []
                names.append(name)
                blobs.append(blob)
        if names:
            yield table(list(shard_rows(current, names, blobs)))

    dealt = requests.repartition("shard").sortWithinPartitions("shard", "batch")
    return dealt.mapInArrow(run, "shard int, batch long, answer binary, tokens long, words long")


def _scores(batches: DataFrame, answers: DataFrame, shards: int, frequent: np.ndarray, tokens: int, words: int) -> DataFrame:
    floor = tokens + 0.5 * (words + 1)

    def scored(docs, held, blob, replies):
        asked = Asked(blob, held, shards, frequent)
        kinds = (np.int64, np.int64, np.uint8, np.uint8, np.float64)
        parts = [unpack(r, *kinds) for _, r in sorted(replies, key=lambda x: x[0])]
        count = np.concatenate([p[0] for p in parts])[asked.home]
        followed = np.concatenate([p[1] for p in parts]).astype(np.float64)
        rest = np.concatenate([p[4][256:][p[2]] for p in parts])
        share = np.concatenate([p[4][:256][p[3]] for p in parts])
        # the parts of a frequent context weigh as often as they were followed
        whole = np.bincount(asked.word_of, followed, len(count))
        weight = followed / np.maximum(whole[asked.word_of], 1)
        rest = np.bincount(asked.word_of, rest * weight, len(count))
        share = share * weight[asked.pair_context]
        single = (count + 0.5) / floor
        # per pair in the stream: the word, and what its context says about it
        word, context = asked.seq[asked.at + 1], asked.seq[asked.at]
        both = share[asked.pair_of] + rest[context] * single[word]
        chance = np.log10(np.where(whole[context] > 0, both, single[word]))
        base = np.log10(single)[word]
        heads = asked.heads - np.arange(len(asked.heads))  # one pair fewer than tokens with BEGIN, per document
        return pa.RecordBatch.from_arrays(
            [
                pa.array(docs, pa.int64()), pa.array(held, pa.bool_()), pa.array(asked.sizes + 1),
                pa.array(np.add.reduceat((count[word] > 0).astype(np.int64), heads)), pa.array(np.full(len(heads), tokens)),
                pa.array(np.add.reduceat(base, heads)), pa.array(np.add.reduceat(chance, heads)),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(parts):
        current, docs, replies = None, None, []
        for part in parts:
            for row in part.to_pylist():
                if row["batch"] != current:
                    if docs:
                        yield scored(*docs, replies)
                    current, docs, replies = row["batch"], None, []
                if row["shard"] is None:
                    docs = row["docs"], row["held"], row["blob"]
                else:
                    replies.append((row["shard"], row["blob"]))
        if docs:
            yield scored(*docs, replies)

    none = lambda kind: F.lit(None).cast(kind)
    both = batches.select("batch", none("int").alias("shard"), "docs", "held", "blob").unionByName(
        answers.where("batch is not null").select(
            "batch", "shard", none("array<bigint>").alias("docs"), none("array<boolean>").alias("held"), F.col("answer").alias("blob")
        )
    )
    dealt = both.repartition("batch").sortWithinPartitions("batch", F.col("shard").asc_nulls_first())
    return dealt.mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    texts = text_of(docs, id_col, text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.crc32(named) % FOLDS == HELD_OUT).alias("held_out"), "text"
    )
    batches = stage(_batches(texts))
    frequent = _frequent(batches)
    answers = stage(_answers(_requests(batches, shards, frequent)))
    totals = answers.agg(F.sum("tokens"), F.sum("words")).first()
    return _scores(batches, answers, shards, frequent, totals[0] or 0, totals[1] or 0)


def _frequent(batches: DataFrame) -> np.ndarray:
    """Hashes of the contexts to cut: words with a share of 1 / FREQUENT of all, FREQUENT of them at most, and BEGIN."""
    tokens = batches.agg(F.coalesce(F.sum("tokens"), F.lit(0))).scalar()
    tops = batches.select(F.inline("top")).groupBy("word").agg(F.sum("n").alias("n"))
    rows = tops.where(F.col("n") * FREQUENT >= tokens).select("word").collect()
    return np.append(np.array([r["word"] for r in rows], np.int64).view(np.uint64), BEGIN)
