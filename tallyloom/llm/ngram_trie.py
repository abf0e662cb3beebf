"""Elias-Fano n-gram trie: contexts, their followers and quantised probabilities, memory-mapped.

Levels:
  contexts   sorted word hashes, Elias-Fano
  pointers   monotone offsets of each context into the followers, Elias-Fano
  words      sorted follower keys of this trie, Elias-Fano; a follower is its rank there
  followers  context rank times the number of words plus follower rank, Elias-Fano
  codes      one byte for the smoothed probability of a follower, one for the weight that
             a context leaves to the lower order, with a table of 255 values for each
"""

from __future__ import annotations

import io

import numpy as np

ONE = np.uint64(1)


class EliasFano:
    """A sorted sequence of different 64-bit numbers: low bits packed, high bits in unary."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits = (int(x) for x in arrays["shape"])
        self.low, self.high, self.zeros = arrays["low"], arrays["high"], arrays["zeros"]

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        low = np.zeros(1, np.uint64)
        if n and bits:
            parts = []
            for k in range(0, n, 64_000):
                part = values[k : k + 64_000]
                planes = (part[:, None] >> np.arange(bits, dtype=np.uint64)) & ONE
                parts.append(np.packbits(planes.astype(np.uint8).ravel(), bitorder="little"))
            packed = np.concatenate(parts)
            low = np.append(np.pad(packed, (0, -len(packed) % 8)).view(np.uint64), np.uint64(0))
        top = (values >> np.uint64(bits)).astype(np.int64)
        size = n + (universe >> bits) + 2
        size += -size % 64
        unary = np.zeros(size, np.uint8)
        unary[top + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little").view(np.uint64)
        zeros = np.zeros(len(high) + 1, np.uint32 if size < 2**32 else np.uint64)
        np.cumsum(64 - np.bitwise_count(high).astype(np.int64), out=zeros[1:], dtype=zeros.dtype)
        return {"shape": np.array([n, bits], np.int64), "low": low, "high": high, "zeros": zeros}

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        at = index.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> shift
        spill = shift > np.uint64(64 - self.low_bits)
        value[spill] |= self.low[word[spill] + 1] << (np.uint64(64) - shift[spill])
        return value & ((ONE << np.uint64(self.low_bits)) - ONE)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero of the unary part."""
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), "right") - 1
        left = (k - self.zeros[word].astype(np.int64)).astype(np.uint64)
        flipped = ~self.high[word]
        at = np.zeros(len(k), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            w = np.uint64(width)
            inside = np.bitwise_count((flipped >> at) & ((ONE << w) - ONE)).astype(np.uint64)
            beyond = left >= inside
            at[beyond] += w
            left[beyond] -= inside[beyond]
        return word * 64 + at.astype(np.int64)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank of the first element not below each value, whether it is equal)."""
        if not self.n or not len(values):
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        values = values.astype(np.uint64)
        top = (values >> np.uint64(self.low_bits)).astype(np.int64)
        stop = self._zero(top) - top
        start = np.zeros(len(values), np.int64)
        some = top > 0
        start[some] = self._zero(top[some] - 1) - (top[some] - 1)
        want = values & ((ONE << np.uint64(self.low_bits)) - ONE)
        # halve the run of elements with the same high bits; contexts with many followers make long ones
        end = stop.copy()
        open_ = np.flatnonzero(start < end)
        while len(open_):
            middle = (start[open_] + end[open_]) >> 1
            below = self._low(middle) < want[open_]
            start[open_[below]] = middle[below] + 1
            end[open_[~below]] = middle[~below]
            open_ = open_[start[open_] < end[open_]]
        equal = np.zeros(len(values), bool)
        inside = np.flatnonzero(start < stop)
        equal[inside] = self._low(start[inside]) == want[inside]
        return start, equal

    def get(self, index: np.ndarray) -> np.ndarray:
        """Elements by rank."""
        ones = np.arange(len(self.high), dtype=np.int64) * 64 - self.zeros[:-1].astype(np.int64)
        word = np.searchsorted(ones, index, "right") - 1
        left = (index - ones[word]).astype(np.uint64)
        bits = self.high[word]
        at = np.zeros(len(index), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            w = np.uint64(width)
            inside = np.bitwise_count((bits >> at) & ((ONE << w) - ONE)).astype(np.uint64)
            beyond = left >= inside
            at[beyond] += w
            left[beyond] -= inside[beyond]
        top = (word * 64 + at.astype(np.int64) - index).astype(np.uint64)
        return top << np.uint64(self.low_bits) | self._low(index)


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes from 1, table of values by code): 255 equal steps of the logarithm, each with the mean of its values."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(256)
    logs = np.log10(values)
    low, high = logs.min(), logs.max()
    codes = np.minimum(254, ((logs - low) * (255 / max(high - low, 1e-9))).astype(np.int64))
    size = np.bincount(codes, minlength=255)
    means = np.bincount(codes, logs, 255) / np.maximum(size, 1)
    return (codes + 1).astype(np.uint8), np.append(0.0, np.where(size > 0, 10.0**means, 0.0))


class Trie:
    """Words after a context, from counts, with absolute discounting."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        level = lambda name: EliasFano({k: arrays[f"{name}.{k}"] for k in ("shape", "low", "high", "zeros")})
        self.contexts, self.pointers, self.words, self.followers = map(level, ("contexts", "pointers", "words", "followers"))
        self.codes, self.table = arrays["codes"], arrays["table"]
        self.rest, self.rest_table = arrays["rest"], arrays["rest_table"]

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, count: np.ndarray, discount: float) -> dict[str, np.ndarray]:
        """Levels from different (context, word) with counts above 0; words are at most 48 bits."""
        contexts, c = np.unique(context, return_inverse=True)
        words, w = np.unique(word, return_inverse=True)
        value = c.astype(np.uint64) * np.uint64(max(1, len(words))) + w.astype(np.uint64)
        order = np.argsort(value)
        value, c, count = value[order], c[order], count[order]
        total = np.bincount(c, count, len(contexts))
        kinds = np.bincount(c, minlength=len(contexts))
        codes, table = quantise((count - discount) / total[c] if len(c) else count.astype(float))
        rest, rest_table = quantise(discount * kinds / total)
        starts = np.cumsum(kinds) - kinds
        levels = {
            "contexts": EliasFano.pack(contexts, 2**64),
            "pointers": EliasFano.pack(starts, max(1, len(value))),
            "words": EliasFano.pack(words, 2**48),
            "followers": EliasFano.pack(value, max(1, len(contexts) * max(1, len(words)))),
        }
        out = {f"{name}.{k}": a for name, arrays in levels.items() for k, a in arrays.items()}
        return out | {"codes": codes, "table": table, "rest": rest, "rest_table": rest_table}

    @staticmethod
    def write(arrays: dict[str, np.ndarray], file: io.BufferedIOBase) -> dict[str, tuple]:
        """Put the levels one behind the other; gives (type, length, offset) of each."""
        places = {}
        for name, a in arrays.items():
            file.seek(-file.tell() % 8, 1)
            places[name] = (a.dtype.str, len(a), file.tell())
            file.write(a.tobytes())
        file.flush()
        return places

    @classmethod
    def map(cls, file, places: dict[str, tuple]) -> Trie:
        """The trie over the mapped file; pages are read as queries touch them."""
        return cls(
            {
                name: np.memmap(file, kind, "r", offset, (n,)) if n else np.zeros(0, kind)
                for name, (kind, n, offset) in places.items()
            }
        )

    def context(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, known) of contexts."""
        return self.contexts.successor(hashes)

    def span(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, behind the last) of the followers of contexts."""
        first = self.pointers.get(rank).astype(np.int64)
        behind = np.full(len(rank), len(self.codes), np.int64)
        inner = rank + 1 < self.pointers.n
        behind[inner] = self.pointers.get(rank[inner] + 1).astype(np.int64)
        return first, behind

    def left_over(self, rank: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Code of the weight that a context leaves to the lower order, 0 if it is not known."""
        out = np.zeros(len(rank), np.uint8)
        out[known] = self.rest[rank[known]]
        return out

    def probability(self, rank: np.ndarray, known: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of the probability of a word after a context, 0 if it never followed it."""
        words, place = np.unique(word, return_inverse=True)
        at, found = self.words.successor(words)
        at, found = at[place], found[place] & known
        out = np.zeros(len(word), np.uint8)
        k = np.flatnonzero(found)
        relative = rank[k].astype(np.uint64) * np.uint64(max(1, self.words.n)) + at[k].astype(np.uint64)
        index, equal = self.followers.successor(relative)
        ranks, at = np.unique(rank[k], return_inverse=True)
        first, behind = self.span(ranks)
        equal &= (index >= first[at]) & (index < behind[at])
        out[k[equal]] = self.codes[index[equal]]
        return out
