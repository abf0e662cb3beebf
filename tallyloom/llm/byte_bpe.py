"""Byte-level BPE: encoding and decoding by a table of ranks.

Each task cuts its texts into pieces by the pattern, encodes the different pieces of a
chunk as rows of length-bucketed padded matrices, and puts the documents together again
from the pieces. In every round each row merges its leftmost pair of the lowest rank,
found in a hash table of pairs, and closes the gap. Pieces too long for a matrix are
merged with a heap, which gives the same ids. The ranks, fixed by the tokenizer file,
go to the executors once.

Defined results: a null or empty text has no tokens; texts of any length are cut into
pieces as a whole, never at a chunk border; every row gives one row; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import text_of
from tallyloom.llm.hashing import chunks

# Widths of the padded matrices; longer pieces go to the heap.
WIDTHS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256)
CHUNK_CHARS = 2_000_000
KNOWN_PIECES = 400_000
NEVER = np.int32(2**31 - 1)
# Codecs of this Python worker, kept from task to task.
_CODECS: dict[tuple[str, str], Codec] = {}


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in map(bytes.split, f) if a]


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of its merge."""

    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        bits = max(4, int(len(pairs) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << bits, NEVER)
        slots = self._slot(keys)
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = self.keys[slots] == np.uint64(2**64 - 1)
            first = np.zeros(len(keys), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = free & first
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            keys, values, slots = keys[~put], values[~put], (slots[~put] + 1) & self.mask
        self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.MULT) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the merge of each pair, or NEVER. Ids below 0 are padding."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64) & np.uint64(0xFFFFFFFF)
        out = np.full(keys.shape, NEVER)
        slots = self._slot(keys)
        got = self.keys[slots]
        hit = (got == keys) & (a >= 0) & (b >= 0)
        out[hit] = self.values[slots[hit]]
        open_ = np.nonzero((got != keys) & (got != np.uint64(2**64 - 1)) & (a >= 0) & (b >= 0))
        if len(open_[0]):
            k, s = keys[open_], slots[open_]
            at = np.arange(len(k))
            found = np.full(len(k), NEVER)
            while len(at):
                s = (s + 1) & self.mask
                got = self.keys[s]
                hit = got == k
                found[at[hit]] = self.values[s[hit]]
                on = ~hit & (got != np.uint64(2**64 - 1))
                at, k, s = at[on], k[on], s[on]
            out[open_] = found
        return out


class Codec:
    """Encoder and decoder of one tokenizer."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str):
        import regex

        self.ranks = dict(ranks)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(len(self.tokens))]
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        self.cut = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def _matrix(self, rows: list[bytes], width: int) -> list[list[int]]:
        n = len(rows)
        sizes = np.fromiter(map(len, rows), np.int64, n)
        ids = np.full((n, width), -1, np.int32)
        filled = np.arange(width) < sizes[:, None]
        ids[filled] = self.bytes[np.frombuffer(b"".join(rows), np.uint8)]
        rank = self.pairs.find(ids[:, :-1], ids[:, 1:])
        out: list[list[int]] = [[]] * n
        live = np.arange(n)
        while True:
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(live), np.int64)
            low = rank[np.arange(len(live)), at] if rank.shape[1] else np.full(len(live), NEVER)
            done = low == NEVER
            if done.any():
                for k, row in zip(live[done].tolist(), ids[done].tolist()):
                    out[k] = [x for x in row if x >= 0]
                live, ids, rank, at, low = live[~done], ids[~done], rank[~done], at[~done], low[~done]
            if not len(live):
                return out
            r = np.arange(len(live))
            ids[r, at] = low
            gone = np.ones(ids.shape, bool)
            gone[r, at + 1] = False
            ids = ids[gone].reshape(len(live), -1)
            gone = np.ones(rank.shape, bool)
            gone[r, at] = False
            rank = rank[gone].reshape(len(live), -1)
            if not rank.shape[1]:
                continue
            left = at > 0
            rank[r[left], at[left] - 1] = self.pairs.find(ids[r[left], at[left] - 1], ids[r[left], at[left]])
            right = at < rank.shape[1]
            rank[r[right], at[right]] = self.pairs.find(ids[r[right], at[right]], ids[r[right], at[right] + 1])

    def _heap(self, piece: bytes) -> list[int]:
        """Leftmost lowest pair first, over a linked list."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        first = self.pairs.find(ids[:-1], ids[1:])
        ids = ids.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(int(first[i]), int(i), ids[i], ids[i + 1]) for i in np.nonzero(first != NEVER)[0]]
        heapq.heapify(queue)
        rank_of, tokens = self.ranks.get, self.tokens

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := rank_of(tokens[ids[i]] + tokens[ids[j]])) is not None:
                heapq.heappush(queue, (rank, i, ids[i], ids[j]))

        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def pieces(self, new: list[str]) -> None:
        """Encode pieces not met before."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in new:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.known[piece] = (rank,)
                continue
            width = next((w for w in WIDTHS if len(raw) <= w), 0)
            buckets.setdefault(width, []).append((piece, raw))
        for width, rows in buckets.items():
            raws = [r for _, r in rows]
            step = max(1, 4_000_000 // width) if width else 1
            found = [x for k in range(0, len(raws), step) for x in self._matrix(raws[k : k + step], width)] if width else map(self._heap, raws)
            for (piece, _), ids in zip(rows, found):
                self.known[piece] = tuple(ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        cut = [self.cut(t) for t in texts]
        self.pieces([p for p in set().union(*cut) if p not in self.known])
        known = self.known
        return [[i for p in pieces for i in known[p]] for pieces in cut]

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


def _codec(spark, path: str, pattern: str):
    """A maker of the codec, from a broadcast of the ranks, whose size the tokenizer file fixes."""
    shared = spark.sparkContext.broadcast(read_ranks(path))

    def make() -> Codec:
        if (path, pattern) not in _CODECS:
            _CODECS[path, pattern] = Codec(shared.value, pattern)
        return _CODECS[path, pattern]

    return make


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) per row."""
    texts = text_of(docs, id_col, text_col)
    make = _codec(docs.sparkSession, path, pattern)

    def run(batches):
        codec = make()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts, CHUNK_CHARS):
                ids = pa.array(codec.encode(texts[a:b]), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], ids], ["doc_id", "ids"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data binary) from (doc_id, ids); the bytes are UTF-8 of the text."""
    make = _codec(encoded.sparkSession, path, pattern)

    def run(batches):
        codec = make()
        for batch in batches:
            data = pa.array([codec.decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), data], ["doc_id", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the ids, and the bytes decoded from them, as digests in one pass."""
    texts = text_of(docs, id_col, text_col)
    make = _codec(docs.sparkSession, path, pattern)

    def run(batches):
        codec = make()
        names, sha = codec.names, hashlib.sha256
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts, CHUNK_CHARS):
                coded = codec.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[a:b],
                        pa.array([len(ids) for ids in coded], pa.int64()),
                        pa.array([sha(",".join([names[i] for i in ids]).encode()).hexdigest() for ids in coded]),
                        pa.array([sha(codec.decode(ids)).hexdigest() for ids in coded]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
