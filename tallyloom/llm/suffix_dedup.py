"""Repeated byte strings of a fixed length, by minimiser groups and refinement of their interleave.

This stands in place of a merge of the Burrows-Wheeler transforms of shards: no transform of
a shard is built, and no two are merged.

1. Every string of LENGTH bytes picks an anchor: the KMER bytes in it with the smallest
   hash. Equal strings pick the same anchor at the same offset, so anchors deal strings out
   to shards in which all their repeats meet. Neighbouring strings mostly share their
   anchor; they form one segment of text. Anchors are narrow rows, without text.
2. Segments with equal content collapse to the first of them, within a batch already and
   then within the shard: all strings of the others start earlier elsewhere. Anchors with
   one different segment only are done.
3. The text of the other segments is cut out and sent to the shard of its anchor. There
   all segments stand in one interleave, to begin with in order of their place in the
   corpus. Each iteration prepends one symbol, from the right end of the segments to the
   left: a stable partition of the interleave by that symbol, which is a step of the
   Burrows-Wheeler transform, refines it to the order of suffixes one symbol longer. The
   common prefix of two neighbours is one more than the least common prefix between them
   before the step. No suffix is ever sorted again. Once the suffixes start at or before
   the anchor, neighbours with LENGTH common symbols are intervals of repeated strings, and
   all but the first in the corpus are marked.
4. Marks are merged per document and taken out of its text.

A task holds the places of one shard of segments, then the text of GROUP_ROWS of them or of
one anchor, at most 2 * LENGTH bytes each, never whole documents of others. The number of
shards follows the bytes of text. Hot passages collapse before the shuffle, one row per batch
and content.

Defined results: a null text is empty; texts under LENGTH bytes lose nothing; rows with
one id are one document, so equal rows do not remove each other; documents without an id
come last, in order of a hash of their text; texts of any length are processed in slices;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import text_of
from tallyloom.llm.hashing import mix
from tallyloom.operators.hot import tasks_for
from tallyloom.sources.stage import stage

LENGTH = 100
KMER = 28
SPREAD = LENGTH - KMER  # offsets of an anchor in its string: 0 to SPREAD
SLICE = 1 << 20
BATCH_BYTES = 8_000_000  # of text whose segments collapse together before the shuffle
SHARD_BYTES = 32_000_000  # of text whose segments a shard has; there are no fewer shards than partitions
GROUP_ROWS = 16_384  # segments that are compared at a time, unless one anchor has more
PRIME = 0x9E3779B97F4A7C15 | 1
_inverse = pow(PRIME, -1, 2**64)

_power = np.ones(SLICE + 1, np.uint64)
np.multiply.accumulate(np.full(SLICE, PRIME, np.uint64), out=_power[1:])
_back = np.ones(SLICE + 1, np.uint64)
np.multiply.accumulate(np.full(SLICE, _inverse, np.uint64), out=_back[1:])


def _segments(data: np.ndarray, ends: np.ndarray):
    """(first, last, anchor, anchor hash, content hash) of the segments of texts that lie one behind the other."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power[:n], out=upto[1:])

    def content(a, b):
        return mix((upto[b] - upto[a]) * _back[a] + (b - a).astype(np.uint64))

    kmers = mix((upto[KMER:] - upto[:-KMER]) * _back[: n - KMER + 1])
    # hash above, place below: the smallest is the leftmost of the smallest hashes
    key = (kmers & ~np.uint64(2 * SLICE - 1)) | np.arange(len(kmers), dtype=np.uint64)
    width, need = 1, SPREAD + 1
    while 2 * width <= need:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < need:
        key = np.minimum(key[: len(key) - (need - width)], key[need - width :])
    anchor = (key & np.uint64(2 * SLICE - 1)).astype(np.int64)
    text = np.searchsorted(ends, np.arange(len(anchor)), "right")
    valid = np.arange(len(anchor)) + LENGTH <= ends[text]
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(valid & change)
    stop = np.ones(len(anchor), bool)
    stop[:-1] = change[1:] | ~valid[1:]
    last = np.flatnonzero(valid & stop)
    anchor = anchor[first]
    return first, last, anchor, kmers[anchor], mix(content(first, last + LENGTH) + (anchor - first).astype(np.uint64))


def _pieces(texts: list[bytes]):
    """Buffers of up to SLICE bytes with (text, offset) of their parts; long texts go in slices that overlap."""
    held, total = [], 0
    for k, raw in enumerate(texts):
        for at in range(0, max(1, len(raw) - LENGTH + 1), SLICE // 2):
            part = raw[at : at + SLICE // 2 + LENGTH - 1]
            if total + len(part) > SLICE:
                yield held
                held, total = [], 0
            held.append((k, at, part))
            total += len(part)
    if held:
        yield held


def _place(first: np.ndarray, anchor: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Start of the segment, offset of its anchor and number of its strings in one number."""
    return first << 16 | (anchor - first) << 8 | (last - first)


def _collapse(h, seg, doc, at):
    """Order by anchor, content and place; which rows are first of their content, and which repeat one before."""
    order = np.lexsort((at, doc, seg, h))
    h, seg, doc, at = h[order], seg[order], doc[order], at[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (seg[1:] != seg[:-1])
    head = np.flatnonzero(new)
    lead = np.repeat(head, np.diff(np.append(head, len(h))))
    repeat = (doc != doc[lead]) | (at != at[lead])
    return h, seg, doc, at, new, repeat


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _merged(doc, start, stop):
    """Overlapping spans of a document as one."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    new = np.append(True, doc[1:] != doc[:-1])
    apart = np.cumsum(new) * (int(stop.max()) + 1)  # so that the furthest stop counts within a document only
    reach = np.maximum.accumulate(stop + apart) - apart
    new[1:] |= start[1:] > reach[:-1]
    head = np.flatnonzero(new)
    return doc[head], start[head], np.maximum.reduceat(stop, head)


def _spans_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of whole segments."""
    first = at >> 16
    return first, first + (at & 255) + LENGTH


def _squeeze(columns) -> bytes:
    """Columns of 64-bit numbers as compressed byte planes, with their length and size in front."""
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), 8).T.tobytes() for c in columns)
    return np.array([len(columns[0])], np.int64).tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _unsqueeze(raw: bytes, n_columns: int) -> list[np.ndarray]:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    planes = np.frombuffer(pa.decompress(raw[8:], n * 8 * n_columns, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(x.T).view(np.int64).reshape(n) for x in planes.reshape(n_columns, 8, n)]


_ROWS = pa.schema([("shard", pa.int32()), ("blob", pa.binary()), ("doc", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _anchors(texts: DataFrame, shards: int) -> DataFrame:
    """Per batch and shard a blob of segments, and the spans of those known to repeat an earlier one."""

    def batch_rows(docs, raws):
        found = [[], [], [], []]
        for held in _pieces(raws):
            data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
            sizes = np.array([len(p) for _, _, p in held], np.int64)
            ends = np.cumsum(sizes)
            first, last, anchor, h, seg = _segments(data, ends)
            part = np.searchsorted(ends, first, "right")
            shift = (np.array([at for _, at, _ in held], np.int64) - (ends - sizes))[part]
            found[0].append(h.view(np.int64))
            found[1].append(seg.view(np.int64))
            found[2].append(docs[np.array([k for k, _, _ in held], np.int64)[part]])
            found[3].append(_place(first + shift, anchor + shift, last + shift))
        h, seg, doc, at, new, repeat = _collapse(*(np.concatenate(x) for x in found))
        gone, start, stop = _merged(doc[repeat], *_spans_of(at[repeat]))
        h, seg, doc, at = h[new], seg[new], doc[new], at[new]
        shard = (h.view(np.uint64) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((at, doc, shard))  # places in order compress well
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        used = np.flatnonzero(np.diff(cut))
        blobs = [_squeeze([c[order[cut[k] : cut[k + 1]]] for c in (h, seg, doc, at)]) for k in used.tolist()]
        none = lambda n, kind: pa.nulls(n, kind)
        n, m = len(used), len(gone)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary()), *[none(n, pa.int64())] * 3], schema=_ROWS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(gone % shards, pa.int32()), none(m, pa.binary()), pa.array(gone), pa.array(start), pa.array(stop)], schema=_ROWS
        )

    def run(batches):
        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
            texts = batch.column("text")
            begin = size = 0
            for k, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
                size += n
                if size >= BATCH_BYTES or k + 1 == len(docs):
                    raws = [t.encode("utf-8", "surrogatepass") for t in texts[begin : k + 1].to_pylist()]
                    yield from batch_rows(docs[begin : k + 1], raws)
                    begin, size = k + 1, 0

    return texts.mapInArrow(run, "shard int, blob binary, doc long, start long, stop long")


def _first_contents(anchors: DataFrame, shards: int) -> DataFrame:
    """Per shard: spans of segments that repeat an earlier one, and (h, doc, at) of those whose text must be compared.

    A task that several shards fall to keeps their blobs as they came and unpacks one shard at a time.
    """
    names = ["h", "doc", "at", "start", "stop"]

    def spans_of(doc, start, stop):
        none = pa.nulls(len(doc), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(doc), none, pa.array(start), pa.array(stop)], names)

    def run(batches):
        blobs = {}
        for batch in batches:
            blob = batch.column("blob")
            held = batch.filter(pa.compute.is_valid(blob))
            for shard, b in zip(held.column("shard").to_pylist(), held.column("blob").to_pylist()):
                blobs.setdefault(shard, []).append(b)
            rest = batch.filter(blob.is_null())
            if len(rest):
                yield spans_of(*_merged(*(rest.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc", "start", "stop"))))
        while blobs:
            _, parts = blobs.popitem()
            h, seg, doc, at, new, repeat = _collapse(*(np.concatenate(x) for x in zip(*(_unsqueeze(b, 4) for b in parts))))
            del parts, seg
            head = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            several = np.repeat(np.add.reduceat(new.astype(np.int64), head) > 1, np.diff(np.append(head, len(h))))
            yield spans_of(*_merged(doc[repeat], *_spans_of(at[repeat])))
            keep = new & several
            h, doc, at = h[keep], doc[keep], at[keep]
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(doc), pa.array(at), *[pa.nulls(len(h), pa.int64())] * 2], names)

    return anchors.repartition(shards, "shard").mapInArrow(run, "h long, doc long, at long, start long, stop long")


def repeated_strings(symbols: np.ndarray) -> np.ndarray:
    """marks[o, row]: the string that starts o bytes before the anchor of the row also stands in a row above.

    symbols[j, row] is the byte j - SPREAD places behind the anchor plus 1, and 0 outside
    the segment. Rows stand in order of their place in the corpus.
    """
    n = symbols.shape[1]
    marks = np.zeros((SPREAD + 1, n), bool)
    order = np.arange(n)
    common = np.zeros(n + 1, np.uint8)  # of each row of the interleave with the one above
    for j in range(symbols.shape[0] - 1, -1, -1):
        symbol = symbols[j][order]
        moved = np.argsort(symbol, kind="stable")
        symbol = symbol[moved]
        pair = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] > 0))
        refined = np.zeros(n + 1, np.uint8)
        if len(pair):
            between = np.empty(2 * len(pair), np.int64)
            between[0::2], between[1::2] = moved[pair] + 1, moved[pair + 1] + 1
            refined[pair + 1] = np.minimum.reduceat(common, between)[::2] + 1
        order, common = order[moved], refined
        if j <= SPREAD:
            equal = common[:n] >= LENGTH
            if equal.any():
                inside = equal | np.append(equal[1:], False)
                rows = order[inside]
                heads = np.flatnonzero(~equal[inside])
                lead = np.repeat(np.minimum.reduceat(rows, heads), np.diff(np.append(heads, len(rows))))
                marks[SPREAD - j, rows[rows != lead]] = True
    return marks


def _marked(doc: np.ndarray, at: np.ndarray, raws: list[bytes]):
    """(doc, start, stop) of the marked parts of segments of whole anchors."""
    anchor = (at >> 16) + (at >> 8 & 255)
    order = np.lexsort((at, anchor, doc))
    once = np.append(True, (np.diff(doc[order]) != 0) | (np.diff(at[order]) != 0))
    order = order[once]  # rows of one id hold the same segments
    doc, at, anchor, raws = doc[order], at[order], anchor[order], [raws[k] for k in order.tolist()]
    ahead = at >> 8 & 255
    symbols = np.zeros((SPREAD + LENGTH, len(raws)), np.uint8)
    for begin in range(0, len(raws), GROUP_ROWS):  # places of bytes take far more room than the bytes
        part = raws[begin : begin + GROUP_ROWS]
        size = np.array([len(r) for r in part])
        shift = np.cumsum(size) - size + ahead[begin : begin + len(part)] - SPREAD
        row = np.repeat(np.arange(len(part)), size)
        flat = np.frombuffer(b"".join(part), np.uint8)
        symbols[np.arange(len(flat)) - shift[row], begin + row] = flat + 1
    marks = repeated_strings(symbols)
    del symbols, raws
    edge = np.zeros((len(doc), SPREAD + 2), np.int8)
    edge[:, :-1] = marks.T
    del marks
    step = np.diff(edge, prepend=0, axis=1)
    r, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)
    return doc[r], anchor[r] - (high - 1), anchor[r] - low + LENGTH


def _compared(segments: DataFrame) -> DataFrame:
    """(doc, start, stop): marked parts of the segments of each anchor.

    Segments of different anchors have no string in common. They come in order of the
    anchor, so a task holds some of its anchors at a time, however many it has.
    """

    def run(batches):
        held, waiting = [], 0

        def marked(stop=None):
            """Of the held rows all, or those before the anchor that the rows of the next batch may go on with."""
            nonlocal held, waiting
            h, doc, at = (np.concatenate([x[k] for x in held]) for k in range(3))
            raws = [r for x in held for r in x[3]]
            end = len(h) if stop is None else int(np.searchsorted(h, stop))
            held = [(h[end:], doc[end:], at[end:], raws[end:])] if end < len(h) else []
            waiting = len(h) - end
            begin = 0
            heads = np.append(np.flatnonzero(np.append(True, h[1:end] != h[: end - 1])) if end else [], end).astype(np.int64)
            while begin < end:
                upto = int(heads[max(np.searchsorted(heads, begin + GROUP_ROWS, "right") - 1, np.searchsorted(heads, begin, "right"))])
                d, start, stop_ = _marked(doc[begin:upto], at[begin:upto], raws[begin:upto])
                yield _batch(doc=d, start=start, stop=stop_)
                begin = upto

        for b in batches:
            h, doc, at = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("h", "doc", "at"))
            if len(h):
                held.append((h, doc, at, b.column("bytes").to_pylist()))
                waiting += len(h)
                if waiting >= GROUP_ROWS and held[0][0][0] != h[-1]:
                    yield from marked(h[-1])
        if held:
            yield from marked()

    return segments.repartition("h").sortWithinPartitions("h").mapInArrow(run, "doc long, start long, stop long")


def _packed(keyed: DataFrame) -> DataFrame:
    """(doc, doc_id, size, data): texts as compressed UTF-8, for a shuffle that moves less."""

    def run(batches):
        for batch in batches:
            raws = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            data = [pa.compress(r, codec="zstd", asbytes=True) for r in raws]
            sizes = pa.array([len(r) for r in raws], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("doc_id"), sizes, pa.array(data, pa.binary())], ["doc", "doc_id", "size", "data"]
            )

    return keyed.mapInArrow(run, "doc long, doc_id long, size long, data binary")


def _texts_and(batch, column: str, *fields: str):
    """Raw text of each row with the entries of a list column of structs, as arrays."""
    lists = batch.column(column)
    inner = lists.flatten()
    arrays = [inner.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields]
    counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(counts)
    for k, (size, data) in enumerate(zip(batch.column("size").to_pylist(), batch.column("data").to_pylist())):
        raw = pa.decompress(data, size, codec="zstd", asbytes=True) if size else b""
        yield k, raw, [a[ends[k] - counts[k] : ends[k]] for a in arrays]


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(doc, start, stop) in bytes, overlapping, of all strings that start earlier too. keyed: (doc, doc_id, text)."""
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = tasks_for(keyed.sparkSession, size, SHARD_BYTES)
    firsts = stage(_first_contents(_anchors(keyed.select("doc", "text"), shards), shards))
    wanted = firsts.where("h is not null").groupBy("doc").agg(F.collect_list(F.struct("h", "at")).alias("wanted"))

    def cut(batches):
        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
            h, doc, at, parts = [], [], [], []
            for k, raw, (shard, place) in _texts_and(batch, "wanted", "h", "at"):
                h.append(shard)
                at.append(place)
                doc.append(np.full(len(place), docs[k]))
                parts += [raw[a:b] for a, b in zip(*(x.tolist() for x in _spans_of(place)))]
                if parts and (len(parts) >= GROUP_ROWS or k + 1 == len(docs)):
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(np.concatenate(x)) for x in (h, doc, at)], pa.array(parts, pa.binary())], ["h", "doc", "at", "bytes"]
                    )
                    h, doc, at, parts = [], [], [], []

    segments = _packed(keyed).join(wanted.hint("merge"), "doc").mapInArrow(cut, "h long, doc long, at long, bytes binary")
    whole = firsts.where("h is null").select("doc", "start", "stop")
    return whole.unionByName(_compared(segments))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    texts = text_of(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    unnamed = F.lit(2**62) + F.pmod(F.xxhash64("text"), F.lit(2**61))
    keyed = texts.select(F.coalesce("doc_id", unnamed).alias("doc"), "doc_id", "text")
    marked = repeated_spans(keyed).groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def strip(batches):
        for batch in batches:
            size, removed, runs, kept = [], [], [], []
            for _, raw, (start, stop) in _texts_and(batch, "spans", "start", "stop"):
                _, start, stop = _merged(np.zeros(len(start), np.int64), start, stop)
                size.append(len(raw))
                removed.append(int((stop - start).sum()))
                runs.append(len(start))
                kept.append(b"".join(raw[a:b] for a, b in zip([0, *stop.tolist()], [*start.tolist(), len(raw)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (size, removed, runs)], pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return _packed(keyed).join(marked.hint("merge"), "doc", "left").select("doc_id", "size", "data", "spans").mapInArrow(
        strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = remove_repeats(docs, id_col, text_col)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
