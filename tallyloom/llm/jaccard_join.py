"""N-gram Jaccard join by chosen paths, with an exact check.

Documents with the same set of word shingles form a class, and one of each class is
joined. A class is known by a MinHash vector. In every run a class follows one or two
coordinates drawn by the path so far, 1 / similarity of them on average, and the values it
has there name its buckets. Buckets within the limit are compared pair by pair on one byte
a coordinate; larger ones are split again on further coordinates. Runs are repeated until
a pair at the least similarity shares a bucket with the target recall. What the deepest
level still leaves large is compared as pairs of blocks, so nothing is dropped.

Buckets give candidate links as a star each, not all pairs. Within each component of
candidates the shingle sets themselves are then compared, again as pairs of blocks of
bounded size, which makes links and their number exact, also between pairs that no bucket
held. Blocks send a sum and one link per document.

Defined results: a null or empty text has no shingles and no links; a text of one to four
words has one shingle; rows with one id count as one document; rows without an id are
joined by their texts and get a made-up negative number as class, unless a row with an
id is in it; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keep_rows, same, text_of
from tallyloom.llm.components import components
from tallyloom.llm.hashing import chunks, mix, seeds, shingle_sets
from tallyloom.sources.stage import stage

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
COORDINATES = 64
LEVELS = 4
# Rows of a bucket that are compared pair by pair; larger buckets are split.
BUCKET = 512
# Coordinates that agree in a candidate pair, well below the least similarity.
LEAST_AGREE = 0.6
# Documents and shingles of a block in the exact check.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 1_000_000


def runs_needed(similarity: float, recall: float, levels: int) -> int:
    """Runs after which a pair of the least similarity has met at the deepest level."""
    two = 1 / similarity - 1  # chance of a second coordinate
    met = 1.0
    for _ in range(levels):
        both = similarity * met
        met = (1 - two) * both + two * (1 - (1 - both) ** 2)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def sketches(texts: DataFrame) -> DataFrame:
    """(doc_id, text_hash, c1, c2, shingles, sketch): the class as two hashes of the set, and its MinHash vector."""
    keys, salts = seeds(COORDINATES, 1) | np.uint64(1), seeds(COORDINATES, 2)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], WORDS)
                sizes = np.array([len(s) for s in sets])
                some = np.flatnonzero(sizes)
                c1, c2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                vectors = np.zeros((len(some), COORDINATES), np.uint32)
                if len(some):
                    flat = np.concatenate([sets[k] for k in some])
                    heads = np.cumsum(sizes[some]) - sizes[some]
                    c1[some] = np.add.reduceat(mix(flat), heads)
                    c2[some] = np.bitwise_xor.reduceat(mix(flat + np.uint64(1)), heads)
                    for k in range(COORDINATES):
                        vectors[:, k] = np.minimum.reduceat(((flat ^ salts[k]) * keys[k]) >> np.uint64(32), heads)
                packed: list[bytes | None] = [None] * len(sets)
                for k, row in zip(some.tolist(), vectors):
                    packed[k] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[a:b], batch.column("text_hash")[a:b],
                        pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), pa.array(sizes.astype(np.int64)),
                        pa.array(packed, pa.binary()),
                    ],
                    ["doc_id", "text_hash", "c1", "c2", "shingles", "sketch"],
                )

    hashed = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return hashed.mapInArrow(run, "doc_id long, text_hash long, c1 long, c2 long, shingles long, sketch binary")


def _vectors(batch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _children(paths: np.ndarray, vectors: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path): one coordinate drawn by the path, and a second with chance 1 / similarity - 1."""
    rows, out = [], []
    draw = mix(paths + np.uint64(5))
    first = (draw % np.uint64(COORDINATES)).astype(np.int64)
    more = (mix(draw) >> np.uint64(11)).astype(np.float64) / 2.0**53 < 1 / similarity - 1
    step = 1 + (mix(draw + np.uint64(9)) % np.uint64(COORDINATES - 1)).astype(np.int64)
    for pick, coordinate in ((np.ones(len(paths), bool), first), (more, (first + step) % COORDINATES)):
        k = np.flatnonzero(pick)
        value = vectors[k, coordinate[k]].astype(np.uint64) | coordinate[k].astype(np.uint64) << np.uint64(32)
        rows.append(k)
        out.append(mix(paths[k] ^ mix(value)))
    return np.concatenate(rows), np.concatenate(out)


def _paths_batch(path: np.ndarray, node) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), node], ["path", "node"])


def _first_paths(classes: DataFrame, runs: int, similarity: float) -> DataFrame:
    roots = seeds(runs, 3)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, node = _vectors(batch), batch.column("node")
            for root in roots:
                rows, path = _children(np.full(len(vectors), root), vectors, similarity)
                yield _paths_batch(path, node.take(pa.array(rows)))

    return classes.select("node", "sketch").mapInArrow(run, "path long, node long")


def _next_paths(rows: DataFrame, similarity: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            paths = batch.column("path").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            rows, path = _children(paths, _vectors(batch), similarity)
            yield _paths_batch(path, batch.column("node").take(pa.array(rows)))

    return rows.select("path", "node", "sketch").mapInArrow(run, "path long, node long")


def block_pairs(node: Column, blocks: Column) -> Column:
    """Structs (i, j, block) of the pairs of blocks that a row goes to: its own with every other, and with itself."""
    own = F.pmod(F.xxhash64(node), blocks).cast("int")
    return F.transform(
        F.sequence(F.lit(0), blocks.cast("int") - 1),
        lambda x: F.struct(F.least(own, x).alias("i"), F.greatest(own, x).alias("j"), own.alias("block")),
    )


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row of the component of each row, from links between rows."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _bucket_links(rows: DataFrame) -> DataFrame:
    """(a, b): links to the first row of each local component of every bucket."""
    least = math.ceil(LEAST_AGREE * COORDINATES)

    def linked(keys: np.ndarray, node: np.ndarray, small: np.ndarray) -> pa.RecordBatch:
        n, at, a, b = len(node), np.arange(len(node)), [], []
        group = np.cumsum(np.append(0, (keys[1:] != keys[:-1]).any(axis=1)))
        for k in range(1, n):
            at = at[at + k < n]
            at = at[group[at] == group[at + k]]
            if not len(at):
                break
            for s in range(0, len(at), 50_000):
                x = at[s : s + 50_000]
                hit = x[(small[x] == small[x + k]).sum(axis=1) >= least]
                a.append(hit)
                b.append(hit + k)
        a, b = (np.concatenate(x) if x else at[:0] for x in (a, b))
        label = local_labels(n, a, b)
        moved = np.flatnonzero(node[label] != node)
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("path", "i", "j")], axis=1)
            node = batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64)
            small = (_vectors(batch) & np.uint32(255)).astype(np.uint8)
            if held is not None:
                keys, node, small = (np.concatenate(x) for x in zip(held, (keys, node, small)))
            last = int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1  # the last bucket may go on
            if last:
                yield linked(keys[:last], node[:last], small[:last])
            held = keys[last:], node[last:], small[last:]
        if held is not None:
            yield linked(*held)

    dealt = rows.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j", "node")
    return dealt.mapInArrow(run, "a long, b long")


def candidate_links(classes: DataFrame, similarity: float, recall: float) -> DataFrame:
    """(a, b) between classes that some bucket holds and whose vectors agree."""
    vectors = classes.select("node", "sketch")
    level = _first_paths(classes, runs_needed(similarity, recall, LEVELS), similarity)
    links = None
    for depth in range(1, LEVELS + 1):
        paths = stage(level)
        counts = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        live = stage(paths.join(counts, "path"))
        last = depth == LEVELS
        ready = live if last else live.where(F.col("n") <= BUCKET)
        blocks = F.ceil(F.col("n") / BUCKET)
        dealt = ready.select("path", "node", F.explode(block_pairs(F.col("node"), blocks)).alias("p"))
        dealt = dealt.join(vectors, "node").select("path", "p.i", "p.j", "node", "sketch")
        found = _bucket_links(dealt)
        links = found if links is None else links.unionByName(found)
        large = live.where(F.col("n") > BUCKET)
        if last or large.isEmpty():
            break
        level = _next_paths(large.join(vectors, "node"), similarity)
    return stage(links.distinct())


def exact_links(texts: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """(node, links, label): weight of the linked documents, and one link each, per pair of blocks.

    members: (node, text_hash, component, weight, shingles) of the classes to compare.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("total"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_DOCS, F.col("total") / BLOCK_SHINGLES))
    sized = members.join(sizes, "component").select(
        F.col("node").alias("_node"), F.col("text_hash").alias("_hash"), "component", "weight", blocks.alias("blocks"), "_id"
    )
    hashed = texts.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # a broadcast of the members has no bound, so they are sorted and merged whatever their size
    read = hashed.join(sized.hint("merge"), same(hashed, sized, [("doc_id", "_id"), ("text_hash", "_hash")]))
    read = read.select(F.col("_node").alias("node"), "component", "weight", "blocks", "text")

    def sets(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts):
                packed = [s.tobytes() for s in shingle_sets(texts[a:b], WORDS)]
                columns = [batch.column(c)[a:b] for c in ("node", "component", "weight", "blocks")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], ["node", "component", "weight", "blocks", "set"])

    shingled = read.mapInArrow(sets, "node long, component long, weight long, blocks long, set binary")
    # repeated rows carry the same set; one of each is compared
    once = shingled.dropDuplicates(["node", "component"])
    dealt = once.select("component", "node", "weight", "set", F.explode(block_pairs(F.col("node"), F.col("blocks"))).alias("p"))
    dealt = dealt.select("component", "p.i", "p.j", "p.block", "node", "weight", "set")

    def compared(key, rows):
        node = np.array([r[0] for r in rows], np.int64)
        weight = np.array([r[1] for r in rows], np.int64)
        block = np.array([r[2] for r in rows])
        found = [np.frombuffer(r[3], np.uint64) for r in rows]
        size = np.array([len(s) for s in found], np.int64)
        if len(rows) == 2:
            shared = np.zeros((2, 2), np.int64)
            shared[0, 1] = shared[1, 0] = len(np.intersect1d(found[0], found[1], assume_unique=True))
        else:
            tokens, place = np.unique(np.concatenate(found), return_inverse=True)
            owner = np.repeat(np.arange(len(rows)), size)
            order = np.argsort(place, kind="stable")
            owner, place = owner[order], place[order]
            shared = np.zeros((len(rows), len(rows)), np.int64)
            for low in range(0, len(tokens), 16_384):
                a, b = np.searchsorted(place, [low, low + 16_384])
                held = np.zeros((len(rows), min(16_384, len(tokens) - low)), np.float32)
                held[owner[a:b], place[a:b] - low] = 1
                shared += (held @ held.T).astype(np.int64)
        union = size[:, None] + size[None, :] - shared
        close = shared >= similarity * union - 1e-9
        np.fill_diagonal(close, False)
        if key[1] != key[2]:
            close &= block[:, None] != block[None, :]
        a, b = np.nonzero(close)
        label = local_labels(len(rows), a, b)
        return node, close @ weight, node[label]

    def run(batches):
        def table(parts):
            columns = [np.concatenate(x) for x in zip(*parts)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "links", "label"])

        key, rows, done = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("component", "i", "j", "node", "weight", "block", "set")]
            for c, i, j, node, weight, block, packed in zip(*columns):
                if (c, i, j) != key:
                    if len(rows) > 1:
                        done.append(compared(key, rows))
                    key, rows = (c, i, j), []
                rows.append((node, weight, block, packed))
            if done:
                yield table(done)
                done = []
        if len(rows) > 1:
            yield table([compared(key, rows)])

    ordered = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
    return ordered.mapInArrow(run, "node long, links long, label long").where("links > 0")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_links, text_hash.

    class_id is the smallest id among documents connected by links of at least the
    similarity; n_links counts the documents linked to this one, copies included.
    """
    texts = text_of(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = stage(sketches(texts))
    some = rows.where("shingles > 0")
    made_up = -2 - F.pmod(F.col("c1"), F.lit(2**62))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_hash")).alias("one")
    classes = stage(
        some.groupBy("c1", "c2", "shingles", "sketch")
        .agg(one, F.count(F.lit(1)).alias("weight"))
        .select(
            F.coalesce("one.doc_id", made_up).alias("node"), F.col("one.doc_id").alias("_id"),
            F.col("one.text_hash").alias("text_hash"), "c1", "c2", "shingles", "weight", "sketch",
        )
    )
    candidates = components(candidate_links(classes, similarity, recall))
    members = stage(candidates.join(classes.drop("sketch", "c1", "c2"), "node"))
    checked = stage(exact_links(texts, members, similarity))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(checked.select(F.col("node").alias("a"), F.col("label").alias("b")))
    found = classes.select("node", "c1", "c2", "weight").join(links, "node", "left").join(groups, "node", "left")
    found = found.select(
        "c1", "c2", F.coalesce("component", "node").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    own = rows.where("shingles = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "text_hash"
    )
    return some.join(found, ["c1", "c2"]).select("doc_id", "class_id", "n_links", "text_hash").unionByName(own)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one document of each class, the one with the smallest id; all columns as they were."""
    found = near_duplicates(docs, id_col, text_col, **options)
    lead = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_hash")
    kept = found.groupBy("class_id").agg(F.min(lead).alias("lead"), F.count(F.lit(1)).alias("n"))
    grouped = kept.where(F.col("class_id").isNotNull()).select(
        F.col("lead.doc_id").alias("doc_id"), F.col("lead.text_hash").alias("text_hash"), (F.col("n") > 1).alias("one")
    )
    loose = found.where(F.col("class_id").isNull()).select("doc_id", "text_hash", F.lit(False).alias("one"))
    return keep_rows(docs, grouped.unionByName(loose), id_col, text_col)
