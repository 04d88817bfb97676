"""Exact ranked retrieval with the Best Position Algorithm.

Every document is read once and leaves its length and the counts of those terms that an item
asks for. From them come the corpus statistics and, per shard of documents, one impact list per
term: documents by descending contribution to a score, with direct access to the contribution and
place of any document. For an item the algorithm goes down the lists of its terms together. Each
document met is looked up in all other lists, which completes its score and marks its place there
as seen. The best position of a list is the last one up to which all places are seen, whether by
going down or by look-up; the contributions there bound the score of every document not met yet,
and more tightly than those at the last places read. The search of a shard ends once that bound
lies strictly below the k-th score found, so that equal scores are all met. Within a task the
k-th score is carried from shard to shard. Tasks report their best k of each item, and windows,
first over parts of an item's rows and then over what is left, choose among them.

Items are taken in blocks whose terms fit ``BLOCK_BYTES``; only such a block is sent to the
tasks, so any number of items can be asked. Memory is bounded by the block and by ``SHARD_POSTINGS``.

Contract: null and empty texts have no terms and do not count as documents with terms; every row
is a document of its own, a repeated row too; among equal scores the smaller ``doc_id`` comes
first, a null id last; an item repeated as a whole counts once, two texts under one ``item_id``
are ranked each for itself; items without terms, or whose terms occur nowhere, have no rows; an
empty table gives no rows; only ``doc_id``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmart.llm.common import slices, texts, written
from trackmart.runtime import measured_bytes

BLOCK_BYTES = 16 << 20  # terms of the items that are asked for at a time
SHARD_POSTINGS = 1 << 20
PARTS = 64  # of the rows of one item, where tasks' results meet
FIRST_STEP = 8

# A-Z in lower case; all other ASCII but letters and digits separates terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, whose longer characters have no byte below 128."""
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``m`` of each document length."""
    if not n_terms:
        return np.full(len(n), 25, dtype=np.int64)
    if len(n) and 75 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([25 + 75 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
    return 25 + 75 * n * n_docs // n_terms


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Shard:
    """Impact lists of some documents, term by term, with direct access by document."""

    def __init__(self, n_docs: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.n_docs, self.doc, self.impact = n_docs, doc[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))
        key = term[order] * n_docs + self.doc
        self.by_doc = np.argsort(key, kind="stable")
        self.key = key[self.by_doc]

    def look_up(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the lists of every (term, document), and whether the document is there."""
        wanted = terms[:, None] * self.n_docs + docs
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return self.by_doc[at], self.key[at] == wanted

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of at least the best ``k`` above 0 and not below ``floor``, and
        how many documents were scored."""
        here = self.first[terms + 1] > self.first[terms]
        terms, times = terms[here], times[here]
        begin, end = self.first[terms], self.first[terms + 1]
        seen = {t: np.zeros(e - b, dtype=bool) for t, b, e in zip(range(len(terms)), begin, end)}
        position = np.zeros(len(terms), dtype=np.int64)  # places seen without a gap
        met = np.zeros(self.n_docs, dtype=bool)
        found, scores, kth = [], [], floor
        depth, step = 0, FIRST_STEP
        while len(terms):
            due = np.unique(np.concatenate([self.doc[b + depth : min(b + depth + step, e)] for b, e in zip(begin, end)]))
            new = due[~met[due]]
            depth, step = depth + step, step * 2
            if len(new):
                met[new] = True
                places, there = self.look_up(terms, new)
                score = (times[:, None] * np.where(there, self.impact[places], 0)).sum(0)
                for i, (row, held) in enumerate(zip(places, there)):
                    seen[i][row[held] - begin[i]] = True
                found.append(new)
                scores.append(score)
                every = np.concatenate(scores)
                if len(every) >= k:
                    kth = max(floor, int(np.partition(every, len(every) - k)[len(every) - k]))
            for i, flags in seen.items():
                gap = flags[position[i] :].argmin() if position[i] < len(flags) else 0
                whole = position[i] < len(flags) and flags[position[i] + gap]
                position[i] = len(flags) if whole else position[i] + gap
            on = position < end - begin
            if not on.any():
                break
            last = begin + np.maximum(position - 1, 0)
            bound = int((times * np.where(on, self.impact[last], 0)).sum())
            if bound < kth or not bound:
                break
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0
        docs, every = np.concatenate(found), np.concatenate(scores)
        keep = (every > 0) & (every >= kth)
        return docs[keep], every[keep], len(docs)


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tf``: length of every document, and its counts of the given terms."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    fields = [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in slices(batches):
            lengths, terms, times = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = terms_of(text)
                counts = Counter(map(number, words))
                counts.pop(None, None)
                lengths.append(len(words))
                terms.append(list(counts))
                times.append(list(counts.values()))
            columns = [batch.column("doc_id"), lengths, terms, times]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, fields)], schema=pa.schema(fields))

    return texts(docs).mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


def asked_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term, times``: the terms of every distinct item, with repeats counted."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, terms, times = [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                for term, n in Counter(terms_of(text)).items():
                    at.append(row)
                    terms.append(term)
                    times.append(n)
            kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("item", "item_id")]
            yield pa.record_batch([*kept, pa.array(terms, pa.binary()), pa.array(times, pa.int64())], names=["item", "item_id", "term", "times"])

    named = rows.withColumn("item", F.md5(F.concat_ws("\t", F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")))
    return named.mapInArrow(run, "item string, item_id long, term binary, times long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``k`` documents of every item."""
    asked = written(asked_terms(items), "asked-terms")
    n_blocks = max(1, -(-measured_bytes(asked) // block_bytes))
    parts = []
    for block in range(n_blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in mine}))}
        counted = written(_counted(docs, vocabulary), "term-counts")
        queries: dict[tuple, list] = {}
        for r in mine:
            queries.setdefault((r["item"], r["item_id"]), []).append((vocabulary[bytes(r["term"])], r["times"]))
        parts.append(_ranked(counted, queries, len(vocabulary), k, shard_postings))
    best = reduce(DataFrame.unionByName, parts)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    within = best.withColumn("place", F.row_number().over(W.partitionBy("item", "part").orderBy(*order))).filter(F.col("place") <= k)
    ranked = within.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _ranked(counted: DataFrame, queries: dict[tuple, list], n_terms: int, k: int, shard_postings: int) -> DataFrame:
    """``item, part, item_id, doc_id, score``: the best ``k`` of each task for each item."""
    spark = counted.sparkSession
    totals = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    weights = np.zeros(n_terms, dtype=np.int64)
    for r in holding:
        weights[r["term"]] = weight(totals["docs"], r["df"])
    asked = [(item, item_id, *map(np.array, zip(*terms))) for (item, item_id), terms in queries.items()]
    sent = spark.sparkContext.broadcast((asked, weights))
    n_docs, all_terms = totals["docs"], totals["terms"]
    fields = [("item", pa.string()), ("part", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        asked, weights = sent.value
        # per item the best documents of the shards so far: (-score, id is null, id)
        best: list[list[tuple]] = [[] for _ in asked]

        def search(shard_rows: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(shard_rows).combine_chunks()
            ids, n = table["doc_id"].to_pylist(), table["n"].to_numpy()
            lists = table["terms"].combine_chunks()
            doc = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = table["tf"].combine_chunks().flatten().to_numpy()
            impact = impacts(weights[term], tf, length_factor(n, n_docs, all_terms)[doc])
            some = impact > 0
            if not some.any():
                return
            shard = Shard(len(ids), term[some], doc[some], impact[some], n_terms)
            for i, (_, _, terms, times) in enumerate(asked):
                floor = -best[i][-1][0] if len(best[i]) >= k else 0
                docs, scores, _ = shard.best(terms, times, k, floor)
                if len(docs):
                    met = [(-s, ids[d] is None, ids[d] or 0) for d, s in zip(docs.tolist(), scores.tolist())]
                    best[i] = sorted(best[i] + met)[:k]

        held, size = [], 0
        for batch in slices(batches):
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= shard_postings:
                search(held)
                held, size = [], 0
        if held:
            search(held)
        part = TaskContext.get().partitionId() % PARTS
        for start in range(0, len(asked), 1000):
            rows = [(item, part, item_id, None if null else doc, -s) for (item, item_id, _, _), found in zip(asked[start : start + 1000], best[start : start + 1000]) for s, null, doc in found]
            yield pa.record_batch([pa.array([r[c] for r in rows], t) for c, (_, t) in enumerate(fields)], schema=pa.schema(fields))

    kinds = "item string, part int, item_id long, doc_id long, score long"
    return counted.select("doc_id", "n", "terms", "tf").mapInArrow(run, kinds)
