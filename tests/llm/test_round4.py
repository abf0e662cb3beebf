"""Repeated strings in groups of bounded size."""

import random
from collections import Counter

import brute
import pyarrow as pa
from brute import docs_table

from tallyloom.llm import suffix_dedup


class Held:
    """Stands for a table: keeps the function that its tasks would run."""

    def repartition(self, *_):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, run, _):
        return run


def _segment_rows():
    """(h, doc, at, bytes) of segments of 40 anchors, some of them equal, one anchor with many."""
    draw, out = random.Random(4), []
    for h in range(40):
        text = bytes(draw.randrange(97, 101) for _ in range(172))
        for k in range(60 if h == 7 else draw.randrange(2, 9)):
            body = bytearray(text)
            body[draw.choice([0, 20, 60, 110, 130, 171])] = 120
            first = 1000 * h
            out.append((h, draw.randrange(50) * 100 + k, first << 16 | 72 << 8 | 72, bytes(body)))
    return out


def _spans(rows, monkeypatch, most):
    widths, refine = [], suffix_dedup.repeated_strings

    def watched(symbols):
        widths.append(symbols.shape[1])
        return refine(symbols)

    monkeypatch.setattr(suffix_dedup, "repeated_strings", watched)
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", most, raising=False)
    table = pa.table(dict(zip(["h", "doc", "at", "bytes"], map(list, zip(*rows)))))
    run = suffix_dedup._compared(Held())
    found = Counter()
    for b in run(iter(table.to_batches(max_chunksize=7))):
        found.update(zip(*(b.column(c).to_pylist() for c in ("doc", "start", "stop"))))
    monkeypatch.setattr(suffix_dedup, "repeated_strings", refine)
    return found, widths


def test_a_task_compares_a_bounded_number_of_segments(monkeypatch):
    """anchors are compared some at a time, with the same result; only an anchor alone may have more."""
    rows = _segment_rows()
    sizes = Counter(r[0] for r in rows)
    whole, one = _spans(rows, monkeypatch, 10**6)
    parts, widths = _spans(rows, monkeypatch, 16)
    assert parts == whole and sum(whole.values()) > 100
    assert len(one) == 1 and sum(widths) == one[0]
    assert sorted(w for w in widths if w > 16) == [len({r[1:3] for r in rows if r[0] == 7})] and sizes[7] == 60


def test_shards_follow_the_bytes_of_text(spark, monkeypatch):
    """a shard has a bounded share of the text, and the bytes removed are the same."""
    draw = random.Random(5)
    base = ["".join(draw.choice("abcd ") for _ in range(400)) for _ in range(6)]
    rows = [(k, base[k % 6][k % 90 :] + str(k) + base[(k * 5 + 1) % 6][: 300 - k]) for k in range(80)] + [(90, None), (91, "")]
    asked, plain = [], suffix_dedup._first_contents

    def watched(anchors, shards=None):
        asked.append(shards)
        return plain(anchors, shards)

    monkeypatch.setattr(suffix_dedup, "_first_contents", watched)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2_000, raising=False)
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 8, raising=False)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_digests(docs_table(spark, rows)).collect()}
    size = sum(len(t or "") for _, t in rows)
    assert asked == [-(-size // 2_000)] and asked[0] > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert got == brute.repeated_bytes(rows) and sum(v[1] for v in got.values()) > 0
