"""Packing documents into token sequences: dominance reduction, then best fit.

Lengths are integers up to the capacity, so the instance is its histogram: how many pieces there
are of each length. That table has at most ``capacity`` rows whatever the corpus, and is all the
driver sees. On it, a Martello-Toth reduction fixes every set of pieces that provably dominates
all other ways to fill a sequence with its largest piece; best fit in descending order places
the rest. Both work on counts: a *pattern* is a filling with a multiplicity. Pieces are then
numbered within their length and look up their place among the patterns' slots. Pieces as long as
a sequence need no number: each is a sequence of its own.

Contract: null and empty texts hold the end id only; repeated rows are packed each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmart.llm.common import encoded_rows, record_batch, texts, tokenizer_encoder, written

CAPACITY = 4096
SALTS, ROWS_PER_SALT = 64, 50_000

Pattern = tuple[list[tuple[int, int]], int]  # [(length, how often in one sequence)], multiplicity


def cut_documents(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]``: every document's ids and the end id,
    cut into pieces of ``capacity`` ids; only longer documents have more than one."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * with_ids)
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizer_encoder(tokenizer_file), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text_ids in encoded_rows(batch, encode):
                ids = text_ids + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), *([part] * with_ids)))
            if rows:
                yield record_batch(schema, *zip(*rows, strict=True))

    columns = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return texts(docs).mapInArrow(run, columns)


def _most_of_two(lengths: list[int], counts: dict[int, int], room: int) -> int:
    """Largest sum of two pieces within ``room``; 0 if there is none."""
    best, low, high = 0, 0, len(lengths) - 1
    while low <= high:
        total = lengths[low] + lengths[high]
        if total > room or (low == high and counts[lengths[low]] < 2):
            high -= 1
        else:
            best = max(best, total)
            low += 1
    return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fillings that some best packing contains, and the counts that remain.

    For the largest piece not yet looked at, a filling is fixed if it dominates every other:
    nothing else fits; one other piece fills the rest exactly; only one more piece fits, then the
    largest; at most two more fit, and the largest single one is no smaller than any two.
    """
    counts, fixed = dict(counts), []
    lengths = sorted(counts)  # those that remain, ascending
    done: set[int] = set()

    def fix(filling: list[tuple[int, int]], times: int) -> None:
        fixed.append((filling, times))
        for length, each in filling:
            counts[length] -= each * times
            if not counts[length]:
                lengths.remove(length)

    def smallest(k: int, without: int) -> int:
        """Sum of the k smallest pieces besides one of ``without``; beyond capacity if fewer."""
        total = 0
        for length in lengths:
            n = min(k, counts[length] - (length == without))
            total, k = total + n * length, k - n
            if not k:
                return total
        return capacity + 1

    while open_lengths := [x for x in lengths if x not in done]:
        largest = open_lengths[-1]
        room = capacity - largest
        if smallest(1, largest) > room:
            fix([(largest, 1)], counts[largest])
            continue
        if largest == room:
            if counts[largest] >= 2:
                fix([(largest, 2)], counts[largest] // 2)
                continue
        elif room in counts and counts[room]:
            fix([(largest, 1), (room, 1)], min(counts[largest], counts[room]))
            continue
        fitting = bisect_left(lengths, room + 1) - 1
        single = lengths[fitting]
        if single == largest and counts[largest] < 2:
            single = lengths[fitting - 1] if fitting else 0
        only_one = smallest(2, largest) > room
        at_most_two = only_one or smallest(3, largest) > room
        if single and (only_one or (at_most_two and single >= _most_of_two(lengths, counts, room))):
            # taking these pieces away only makes other fillings rarer, so it holds for all of them
            if single == largest:
                fix([(largest, 2)], counts[largest] // 2)
            else:
                fix([(largest, 1), (single, 1)], min(counts[largest], counts[single]))
            continue
        done.add(largest)
    return fixed, {k: v for k, v in counts.items() if v}


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit in descending order; equal sequences are one pattern with a multiplicity."""
    groups: dict[int, list[Pattern]] = defaultdict(list)  # by free room
    rooms: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append(pattern)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, left)
                times = left // each
                put(capacity - each * length, ([(length, each)], times))
                left -= each * times
                continue
            room = rooms[at]
            filling, times = groups[room].pop()
            if not groups[room]:
                rooms.pop(at)
            each = min(room // length, left)
            used = min(times, left // each)
            if used < times:
                put(room, (filling, times - used))
            put(room - each * length, ([*filling, (length, each)], used))
            left -= each * used
    return [pattern for same in groups.values() for pattern in same]


def slots(patterns: list[Pattern]) -> pd.DataFrame:
    """Where the pieces of each length go: numbers from ``first`` on, ``times`` sequences from
    ``sequence`` on, each with its pieces of that length from ``offset`` on."""
    rows, numbered, sequence = [], defaultdict(int), 0
    for filling, times in patterns:
        offset = 0
        for length, each in filling:
            rows.append((length, numbered[length], times, sequence, offset))
            numbered[length] += each * times
            offset += each * length
        sequence += times
    out = pd.DataFrame(rows, columns=["length", "first", "times", "sequence", "offset"], dtype="int64")
    return out.sort_values(["length", "first"], ignore_index=True)


def numbered(pieces: DataFrame, salts: int = SALTS) -> DataFrame:
    """Adds ``number``: 0, 1, … within each length. A length may be most of the table, so it is
    numbered in ``salts`` parts that are put one behind the other."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("salt")
    offsets = parts.select("length", "salt", (F.sum("n").over(before) - F.col("n")).alias("before"))
    within = W.partitionBy("length", "salt").orderBy("doc_id", "piece")
    placed = salted.withColumn("within", F.row_number().over(within) - 1)
    return placed.join(offsets, ["length", "salt"]).withColumn("number", F.col("before") + F.col("within")).drop("salt", "within", "before")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces``, which must be a stored table with
    ``doc_id``, ``piece`` and ``length``, the latter from 1 to ``capacity``."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    alone = histogram.pop(capacity, 0)
    salts = max(SALTS, max(histogram.values(), default=0) // ROWS_PER_SALT)
    fixed, rest = reduce_by_dominance(histogram, capacity)
    places = slots(fixed + best_fit(rest, capacity))
    length, first, times, sequence, offset = (places[c].to_numpy() for c in places.columns)
    keys = length << 48 | first
    source = numbered(pieces.where(F.col("length") < capacity) if alone else pieces, salts)
    names = [c for c in source.columns if c != "number"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            slot = np.searchsorted(keys, size << 48 | number, side="right") - 1
            within = number - first[slot]
            added = [sequence[slot] + within % times[slot], offset[slot] + within // times[slot] * size]
            yield pa.record_batch([batch.column(c) for c in names] + [pa.array(a) for a in added], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {t}" for n, t in source.dtypes if n != "number")
    packed = source.mapInArrow(run, f"{schema}, sequence_id long, offset long")
    if not alone:
        return packed
    used = F.lit(int((sequence + times).max()) if len(places) else 0).cast("long")
    full = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": used + F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Cuts and packs; the cut pieces are stored once, as lengths or with their ids."""
    return pack(written(cut_documents(docs, tokenizer_file, end_id, capacity, with_ids), "pieces"), capacity)
