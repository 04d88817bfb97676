"""Exact top-k search by inner product, with pivot-table elimination.

Vectors are turned into integers, component by component. An added component brings all
candidates to one length, so that the largest inner product is the smallest distance. Distances
of every candidate to many pivots are computed once and stored with it; for a query with its own
pivot distances, the largest difference is a lower bound of the distance, hence an upper bound of
the score. Within a block, candidates are evaluated in the order of their bounds until the next
bound cannot reach the k-th score found. Products are exact integers; bounds carry a margin for
rounding. Queries and candidates meet block by block: every block of candidates goes to one cell,
every block of queries to all cells, and each cell reports its best k per query. Vectors whose
products might not fit 64 bits are *wide*: they travel in blocks of their own, as they came, and
meet all others in Python's integers, without pivots.

Contract: vectors that are null or hold null or non-finite components take no part, nor do rows
without an id; vectors of different lengths do not meet; a score beyond 64 bits is null, at its
right rank; equal scores go to the smaller id; every repeated row counts, and a repeated query row gives its
own result; rows with the query's id are never its result; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmart.llm.common import written

BLOCK, QUERY_BLOCK, WIDE_BLOCK = 4096, 1024, 256
PIVOTS, SAMPLE, FIRST = 32, 4096, 64
LARGEST = 1 << 31  # length of a vector of equal components whose products surely fit 64 bits


def finite_rows(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, values``: the rows that take part."""
    values = F.transform(F.col(vector), lambda c: c.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("values"))
    finite = F.forall("values", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("values").isNotNull() & finite)


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) of each value, of any size, as Python's integers."""
    places = [math.floor(scale * v) if math.isfinite(scale * v) else scale * int(v) for v in values.ravel().tolist()]
    return np.array([*places, None], dtype=object)[:-1].reshape(values.shape)


def blocks(rows: DataFrame, size: int, scale: int = 256) -> DataFrame:
    """``block, dim, wide, ids, data``: up to ``size`` rows of one task and one dimension each, as
    64-bit integers floor(scale * value), or wide vectors as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, vectors = batch.column("vec_id").to_numpy(), batch.column("values")
            lengths = vectors.value_lengths().to_numpy()
            for dim in np.unique(lengths).tolist():
                of_dim = np.flatnonzero(lengths == dim)
                every = vectors.take(pa.array(of_dim)).flatten().to_numpy(zero_copy_only=False).reshape(len(of_dim), dim)
                with np.errstate(over="ignore"):
                    beyond = (np.abs(every * scale) > LARGEST / math.sqrt(max(dim, 1))).any(axis=1)
                for wide in (False, True):
                    mine, data = of_dim[beyond == wide], every[beyond == wide]
                    data = data.astype("<f8") if wide else np.floor(data * scale).astype("<i8")
                    rows_each = min(size, WIDE_BLOCK) if wide else size
                    for at in range(0, len(mine), rows_each):
                        part = slice(at, at + rows_each)
                        columns = [[block], [dim], [wide], [ids[mine[part]].tobytes()], [data[part].tobytes()]]
                        types = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["block", "dim", "wide", "ids", "data"])
                        block += 1

    return rows.mapInArrow(run, "block long, dim int, wide boolean, ids binary, data binary")


def choose_pivots(sample: np.ndarray, reach: float, n: int = PIVOTS) -> np.ndarray:
    """Far apart members of the sample, each with its added component."""
    if not len(sample):
        return np.zeros((0, sample.shape[1] + 1))
    points = extended(sample, reach)
    chosen = [0]
    nearest = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(points)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def extended(x: np.ndarray, reach: float) -> np.ndarray:
    """Candidates brought to the length whose square is ``reach``."""
    x = x.astype(float)
    return np.column_stack([x, np.sqrt(np.maximum(reach - (x**2).sum(1), 0))])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def search_block(query_ids, queries, query_table, ids, vectors, table, reach: float, k: int) -> tuple[np.ndarray, ...]:
    """The best k of one block for each query, as (query place, id, score), and how many were evaluated."""
    n, found = len(ids), [[] for _ in range(3)]
    upper = np.zeros((len(queries), n))
    for p in range(table.shape[1]):
        np.maximum(upper, np.abs(query_table[:, p, None] - table[None, :, p]), out=upper)
    square = (queries.astype(float) ** 2).sum(1)[:, None] + reach
    margin = 1e-6 * np.maximum(square, 1)
    upper = (square - np.maximum(upper - 1e-6 * np.sqrt(square), 0) ** 2) / 2 + margin
    evaluated = 0
    # cheap first look: the most promising candidates of all queries at once
    first = min(n, FIRST)
    order = np.argpartition(-upper, first - 1, axis=1)[:, :first] if first < n else np.tile(np.arange(n), (len(queries), 1))
    for q in range(len(queries)):
        take = order[q]
        scores = vectors[take] @ queries[q]
        evaluated += len(take)
        own = ids[take] == query_ids[q]
        valid = scores[~own]
        worst = np.partition(valid, len(valid) - k)[len(valid) - k] if len(valid) >= k else None
        rest = np.ones(n, dtype=bool)
        rest[take] = False
        remaining = np.flatnonzero(rest if worst is None else rest & (upper[q] >= worst))
        remaining = remaining[np.argsort(-upper[q, remaining], kind="stable")]
        at, step = 0, FIRST
        while at < len(remaining) and (worst is None or upper[q, remaining[at]] >= worst):
            more = remaining[at : at + step]
            at, step, evaluated = at + len(more), step * 2, evaluated + len(more)
            take, scores = np.concatenate([take, more]), np.concatenate([scores, vectors[more] @ queries[q]])
            valid = scores[ids[take] != query_ids[q]]
            if len(valid) >= k:
                worst = np.partition(valid, len(valid) - k)[len(valid) - k]
        keep = ids[take] != query_ids[q]
        take, scores = take[keep], scores[keep]
        best = np.lexsort((ids[take], -scores))[:k]
        found[0].append(np.full(len(best), q))
        found[1].append(ids[take[best]])
        found[2].append(scores[best])
    return (*(np.concatenate(f) if f else np.zeros(0, dtype=np.int64) for f in found), evaluated)


def search_wide(query_ids, queries, ids, vectors, k: int) -> tuple[list[int], list[int], list[int]]:
    """The best k of one block for each query, as (query place, id, score), all pairs in Python's integers."""
    found: tuple[list[int], list[int], list[int]] = ([], [], [])
    for q, (query_id, x) in enumerate(zip(query_ids.tolist(), queries, strict=True)):
        scored = [(-sum(map(int.__mul__, x, v)), i) for i, v in zip(ids.tolist(), vectors, strict=True) if i != query_id]
        for score, i in heapq.nsmallest(k, scored):
            found[0].append(q)
            found[1].append(i)
            found[2].append(-score)
    return found


def order_key(score: int) -> bytes:
    """Bytes that order scores beyond 64 bits among all; one and the same for all others."""
    if -(1 << 63) <= score < 1 << 63:
        return b"\x01"
    size = (abs(score).bit_length() + 7) // 8
    raw = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\x02" + raw if score > 0 else b"\x00" + bytes(255 - b for b in raw)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row with ``is_query`` (on ``vec_id``)."""
    rows = finite_rows(vectors, vector)
    queries = written(blocks(rows.filter(is_query), QUERY_BLOCK, scale), "query-blocks")
    candidates = written(blocks(rows, BLOCK, scale), "vector-blocks")
    spark = vectors.sparkSession

    ordinary = candidates.filter("NOT wide")

    # per dimension: the largest length, and pivots from a bounded sample of blocks
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [float((np.frombuffer(r["data"], dtype="<i8").reshape(-1, r["dim"]).astype(float) ** 2).sum(1).max()) if r["dim"] else 0.0 for r in batch.select(["dim", "data"]).to_pylist()]
            yield pa.record_batch([batch.column("dim"), pa.array(out, pa.float64())], names=["dim", "reach"])

    reach = {r["dim"]: r["reach"] for r in ordinary.mapInArrow(lengths, "dim int, reach double").groupBy("dim").agg(F.max("reach").alias("reach")).collect()}
    pivots = {}
    for dim, most in reach.items():
        sample = ordinary.filter(F.col("dim") == dim).orderBy("block").limit(max(1, SAMPLE // BLOCK)).collect()
        parts = [np.frombuffer(r["data"], dtype="<i8").reshape(len(r["ids"]) // 8, dim) for r in sample]
        pivots[dim] = choose_pivots(np.concatenate(parts), most)

    cells = max(1, min(spark.sparkContext.defaultParallelism * 4, candidates.count()))
    held = candidates.withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)).cast("int"))
    sent = queries.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    named = sent.select("cell", "dim", F.col("wide").alias("q_wide"), F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    met = held.drop("block").join(named, ["cell", "dim"])

    names = ["q_block", "place", "query_id", "vec_id", "score", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, table = None, None
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                ids, x = np.frombuffer(r["ids"], dtype="<i8"), np.frombuffer(r["data"], dtype="<f8" if r["wide"] else "<i8")
                q_ids, q = np.frombuffer(r["q_ids"], dtype="<i8"), np.frombuffer(r["q_data"], dtype="<f8" if r["q_wide"] else "<i8")
                x, q = x.reshape(len(ids), dim), q.reshape(len(q_ids), dim)
                if r["wide"] or r["q_wide"]:
                    x, q = (_whole(m, scale).tolist() if wide else m.tolist() for m, wide in ((x, r["wide"]), (q, r["q_wide"])))
                    place, got, scores = search_wide(q_ids, q, ids, x, k)
                    keys = [order_key(s) for s in scores]
                    made = [[r["q_block"]] * len(place), place, [int(q_ids[p]) for p in place], got, [s if key == b"\x01" else None for s, key in zip(scores, keys, strict=True)]]
                    yield pa.record_batch([*(pa.array(m, pa.int64()) for m in made), pa.array(keys, pa.binary())], names=names)
                    continue
                if last != r["ids"] or table is None:
                    last, table = r["ids"], distances(extended(x, reach[dim]), pivots[dim])
                q_table = distances(np.column_stack([q.astype(float), np.zeros(len(q))]), pivots[dim])
                place, got, scores, _ = search_block(q_ids, q, q_table, ids, x, table, reach[dim], k)
                made = [np.full(len(place), r["q_block"]), place.astype(np.int64), q_ids[place], got, scores]
                yield pa.record_batch([*(pa.array(m) for m in made), pa.array([b"\x01"] * len(place), pa.binary())], names=names)

    best = met.mapInArrow(run, "q_block long, place long, query_id long, vec_id long, score long, key binary")
    order = W.partitionBy("q_block", "place").orderBy(F.desc("key"), F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
