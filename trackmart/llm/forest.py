"""N-gram Jaccard join with MinHash banding and exact verification.

Documents are sets of hashed five-word shingles. Documents with one and the same set are copies
and stand for one *node*. Each of 24 trees gives a node a path of minimum hashes, of which a prefix
is used as one hash: nodes with the same prefix in a tree are candidates. The length of the prefix is
worked out beforehand from the threshold and the target recall (5 of 8 here) and is the same in all
trees; it is not adapted to what is found, and no sorted order of paths is kept. In every group of
candidates all nodes are linked to the smallest, never to each other, and connected components
of these links hold all candidate pairs. Within a component every pair is verified exactly, by
products of 0/1 matrices over shared shingles. Small components are verified several a task; a
large one is dealt by set size and hash into blocks that meet pairwise, where blocks whose sizes
rule out the threshold never meet. Only counts and one link per node leave a task.

Contract: words are runs without ASCII white space, ASCII letters in lower case; a text of one
to four words is one shingle; texts without words (null, empty) have no links, and each is a
class of its own; repeated rows are copies; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import drop_encoders, texts, written
from trackmart.llm.graph import connected_components
from trackmart.llm.repeats import Filter, Hashes

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
TREES, DEPTH = 24, 8
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 20
AT_ONCE = 1 << 20  # bytes whose shingles are hashed at once


def prefix_length(trees: int, depth: int, threshold: float, recall: float) -> int:
    """The longest prefix at which pairs at the threshold meet with the target recall."""
    for length in range(depth, 1, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    return 1


def _shingles(batch: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        if not held:
            return
        raw = np.frombuffer(b"\n".join([*held, b""]), dtype=np.uint8)
        hashes = Hashes(raw)
        stops = np.flatnonzero((raw == 32) | (raw == 10))  # ends of words
        starts = np.append(0, stops[:-1] + 1)
        text_ends = np.flatnonzero(raw[stops] == 10) + 1  # words up to the end of each text
        every = hashes.at(starts[: max(0, len(stops) - words + 1)], stops[words - 1 :])
        at = 0
        for end in text_ends.tolist():
            n = end - at
            if stops[at] == starts[at]:  # a text without words
                out.append(np.zeros(0, dtype=np.uint64))
            elif n < words:
                out.append(hashes.at(starts[at : at + 1], stops[end - 1 : end]))
            else:
                out.append(np.unique(every[at : end - words + 1]))
            at = end
        held.clear()

    for text in batch:
        plain = b" ".join(text.encode().lower().split())
        held.append(plain)
        size += len(plain)
        if size > AT_ONCE:
            flush()
            size = 0
    flush()
    return out


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()


def _low(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _paths(sets: list[np.ndarray], trees: int, length: int, seed: int = 6) -> np.ndarray:
    """A hash of the path prefix of each (non-empty) set in each tree."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**63, (trees, length), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 2**63, (trees, length), dtype=np.uint64)
    joined = np.concatenate(sets)
    first = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.zeros((len(sets), trees), dtype=np.uint64)
    for t in range(trees):
        for j in range(length):
            least = np.minimum.reduceat((joined ^ offsets[t, j]) * factors[t, j], first)
            out[:, t] = (out[:, t] ^ least ^ (least >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            out[:, t] ^= out[:, t] >> np.uint64(32)
    return out


MEMBER = "doc_id long, set_key binary, low long, size int, paths array<long>"


def members(source: DataFrame, words: int = WORDS, trees: int = TREES, length: int = 5) -> DataFrame:
    """Each document with its set and the set's paths; without words both are null."""
    list_type = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = _shingles(batch.column("text").to_pylist(), words)
                full = [s for s in sets if len(s)]
                paths = iter(_paths(full, trees, length).view(np.int64)) if full else iter(())
                keys = [set_key(s) if len(s) else None for s in sets]
                columns = [
                    batch.column("doc_id"),
                    pa.array(keys, pa.binary()),
                    pa.array([_low(k) if k else None for k in keys], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([next(paths) if len(s) else None for s in sets], list_type),
                ]
                yield pa.record_batch(columns, names=["doc_id", "set_key", "low", "size", "paths"])

    return source.mapInArrow(run, MEMBER)


def candidate_components(nodes: DataFrame) -> DataFrame:
    """``node, component`` of all nodes that share a path prefix with another."""
    places = nodes.select("node", F.posexplode("paths").alias("tree", "path"))
    groups = places.groupBy("tree", "path").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1")
    links = places.join(groups.drop("n"), ["tree", "path"]).filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    return connected_components(links.distinct()).withColumnRenamed("label", "component")


def shingle_sets(source: DataFrame, wanted: Filter, words: int = WORDS) -> DataFrame:
    """``set_key, shingles`` of the texts whose sets may be wanted, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        sent: set[bytes] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                keys, values = [], []
                for s in _shingles(whole.slice(at, 500).column("text").to_pylist(), words):
                    key = set_key(s)
                    if len(s) and key not in sent and wanted(np.frombuffer(key[:8], dtype="<u8"))[0]:
                        sent.add(key)
                        keys.append(key)
                        values.append(s.astype("<u8").tobytes())
                if keys:
                    yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(values, pa.binary())], names=["set_key", "shingles"])

    return source.select("text").mapInArrow(run, "set_key binary, shingles binary")


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold, exactly, as a matrix."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    owner = np.repeat(np.arange(n), sizes.astype(np.int64))
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    owner, column = owner[shared], column[shared]
    everywhere = int((counts == n).sum())
    if everywhere:  # needs no columns
        partly = counts[column] < n
        owner, column = owner[partly], column[partly]
    common = np.full((n, n), float(everywhere))
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = max(64, (1 << 22) // n)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [low, low + step])
        dense = np.zeros((n, min(step, int(column[-1]) + 1 - low)), dtype=np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        common += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - common
    out = common >= threshold * union - 1e-9
    np.fill_diagonal(out, False)
    return out


def _least_connected(adjacent: np.ndarray) -> np.ndarray:
    """For each place the least one it is connected to."""
    label = np.arange(len(adjacent))
    while True:
        new = np.minimum(label, np.where(adjacent, label[None, :], len(adjacent)).min(1, initial=len(adjacent)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


VERIFIED = "node long, links long, label long"


def _verify(group: pa.Table, threshold: float) -> pa.Table:
    """Links per node, weighted by copies, and the least node each is connected to here."""
    columns = {c: group.column(c).to_numpy() for c in ("node", "copies", "component", "bucket", "block", "b1", "i1", "b2", "i2")}
    sets = [np.frombuffer(s, dtype="<u8") for s in group.column("shingles").to_pylist()]
    out: list[list[np.ndarray]] = [[], [], []]
    for component in np.unique(columns["component"]):
        mine = np.flatnonzero(columns["component"] == component)
        adjacent = similar([sets[i] for i in mine], threshold)
        if columns["b1"][0] >= 0 and (columns["b1"][0], columns["i1"][0]) != (columns["b2"][0], columns["i2"][0]):
            left = (columns["bucket"][mine] == columns["b1"][0]) & (columns["block"][mine] == columns["i1"][0])
            adjacent &= left[:, None] != left[None, :]  # pairs within a block are another group's
        node = columns["node"][mine]
        out[0].append(node)
        out[1].append(adjacent @ columns["copies"][mine])
        out[2].append(node[_least_connected(adjacent)])
    return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["node", "links", "label"])


def verified(sets: DataFrame, threshold: float = THRESHOLD, block_nodes: int = BLOCK_NODES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``node, links, label`` from each place where a node was verified. ``sets`` is a stored
    table of ``node, copies, size, component, shingles``."""
    # sets that reach the threshold lie in one bucket or in neighbouring ones
    bucket = F.floor(F.log("size") / F.log(F.lit(1 / threshold)) + F.lit(1e-9)).cast("int")
    nodes = sets.withColumn("bucket", bucket)
    parts = nodes.groupBy("component", "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    blocks = F.ceil(F.greatest(F.col("n") / block_nodes, F.col("s") / block_shingles)).cast("int")
    shape = parts.groupBy("component").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.map_from_entries(F.collect_list(F.struct("bucket", blocks.alias("blocks")))).alias("blocks")
    )
    small = (F.col("n") <= block_nodes) & (F.col("s") <= block_shingles)
    total = nodes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s"), F.count("*").alias("n")).first()
    shards = max(1, -(-total["s"] // block_shingles), -(-total["n"] // (4 * block_nodes)))
    placed = nodes.join(shape.select("component", "blocks", small.alias("small")), "component")

    def count(b):
        return F.coalesce(F.col("blocks")[b], F.lit(0))

    b, i = F.col("bucket"), F.col("block")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), count(b)).cast("int"))

    def pairs(other, make):
        some = F.when(count(other) > 0, F.sequence(F.lit(0), count(other) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(some, lambda j: F.struct(*[x.cast("int").alias(n) for x, n in zip(make(j), ("b1", "i1", "b2", "i2"), strict=True)]))

    meetings = F.concat(
        pairs(b, lambda j: (b, F.least(i, j), b, F.greatest(i, j))),
        pairs(b + 1, lambda j: (b, i, b + 1, j)),
        pairs(b - 1, lambda j: (b - 1, j, b, i)),
    )
    alone = F.array(F.struct(*[F.lit(-1).alias(n) for n in ("b1", "i1", "b2", "i2")]))
    met = placed.withColumn("met", F.explode(F.when(F.col("small"), alone).otherwise(meetings)))
    shard = F.when(F.col("small"), F.pmod(F.xxhash64("component"), F.lit(shards))).otherwise(F.col("component"))
    rows = met.select(shard.alias("shard"), "met.*", "node", "copies", "component", "bucket", "block", "shingles")

    def run(group: pa.Table) -> pa.Table:
        drop_encoders()
        return _verify(group, threshold)

    return rows.groupBy("shard", "b1", "i1", "b2", "i2").applyInArrow(run, VERIFIED)


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """``doc_id, class_id, n_copies, n_links``: the least id of all documents connected by links,
    how many documents have the same shingles, and how many others reach the threshold."""
    source = texts(docs)
    every = written(members(source, words, trees, prefix_length(trees, depth, threshold, recall)), "members")
    known = every.filter("set_key IS NOT NULL").groupBy("set_key")
    grouped = known.agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.first("low").alias("low"), F.first("size").alias("size"), F.first("paths").alias("paths"))
    nodes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    candidates = written(nodes.drop("paths").join(candidate_components(nodes), "node"), "candidates")

    wanted = Filter(candidates, "low", candidates.count())
    sets = shingle_sets(source, wanted, words).dropDuplicates(["set_key"])
    checked = written(verified(written(candidates.drop("first_doc", "low").join(sets, "set_key").drop("set_key"), "sets"), threshold), "verified")

    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(checked.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")).distinct())
    labelled = nodes.select("set_key", "node", "first_doc", "copies").join(joined, "node", "left").join(links, "node", "left")
    # both stored, so that the join is between plain tables and a hot class can be split
    labelled = written(labelled.withColumn("label", F.coalesce("label", "node")), "labelled")
    classes = written(labelled.groupBy("label").agg(F.min("first_doc").alias("class_id")), "classes")
    of_set = labelled.join(classes, "label").select("set_key", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    return every.select("doc_id", "set_key").join(of_set, "set_key", "left").select(
        "doc_id",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
    )


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document of each class: the one whose id is the class's. Of rows that
    repeat it, one stays; documents without an id stay."""
    chosen = jaccard_join(docs, **settings).filter("doc_id = class_id").select("doc_id").distinct()
    kept = docs.join(chosen, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)
