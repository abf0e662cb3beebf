"""Word and shingle hashes of many texts at once, for Arrow batches inside tasks."""

from __future__ import annotations

import numpy as np

SLICE_BYTES = 4_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_blank = np.zeros(256, bool)
_blank[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * ODD + np.uint64(salt))


_powers = np.multiply.accumulate(np.full(64, BASE))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.multiply.accumulate(np.full(2 * n, BASE))
    return _powers


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z folded, in order, and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    hashes, starts = [], []
    at = 0
    while at < len(data):
        to = min(at + SLICE_BYTES, len(data))
        while to < len(data) and not _blank[data[to - 1]]:  # cut behind a blank
            more = np.flatnonzero(_blank[data[to : to + SLICE_BYTES]])
            to = to + int(more[0]) + 1 if len(more) else min(to + SLICE_BYTES, len(data))
        part = data[at:to]
        blank = _blank[part]
        letters = np.flatnonzero(~blank)
        if len(letters):
            first = np.ones(len(letters), bool)
            first[1:] = np.diff(letters) > 1
            heads = np.flatnonzero(first)
            sizes = np.diff(np.append(heads, len(letters)))
            place = np.arange(len(letters)) - np.repeat(heads, sizes)
            terms = (_lower[part[letters]].astype(np.uint64) + np.uint64(1)) * _powers_to(int(sizes.max()))[place]
            hashes.append(mix(np.add.reduceat(terms, heads) + sizes.astype(np.uint64) * ODD))
            starts.append(letters[heads] + at)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    upto = np.searchsorted(np.concatenate(starts), ends)
    return np.concatenate(hashes), np.diff(upto, prepend=0)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted different shingles of each text. A text with fewer words has one, of all its words."""
    words, counts = word_hashes(texts)
    keys = seeds(width, 77)
    n = len(words) - width + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        rolled += words[k : k + n] * keys[k]
    rolled = mix(rolled)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(rolled[at : at + c - width + 1]))
        elif c:
            out.append(mix(np.add.reduce(words[at : at + c] * keys[:c], keepdims=True) + np.uint64(c)))
        else:
            out.append(words[:0])
        at += c
    return out


def chunks(texts: list[str], chars: int = 1_000_000):
    """Ranges of rows with about so many characters, so that memory follows the chunk and not the batch."""
    start = held = 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(texts):
        yield start, len(texts)
