"""Token ids in Simple-8b files.

A file set is a folder of Parquet files that serve as containers. Each row holds a run of whole
documents: their ids and lengths, and all their token ids as Simple-8b words. Ids are coded in
blocks of 1024; ``word_offsets`` has the first word of each block, so that blocks can be decoded
on their own and many at once. In a word the top four bits select how many ids of which width
follow, lowest bits first; selector 0 is an escape: the next word is one id, as it is. A block's
last word is padded with zeros, which the known number of ids cuts off.

Contract: null and empty texts hold the end id only; documents are in ascending order of
``doc_id``, a null id first; repeated rows are written each; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmart.llm.common import encoded_rows, record_batch, texts, tokenizer_encoder

BLOCK = 1024
ROW_IDS = 1 << 20
# Fixed values of the format: ids per word and bits per id, by selector from 1 on.
LAYOUT = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
_COUNTS = np.array([1, *(n for n, _ in LAYOUT), 0], dtype=np.int64)  # by selector; 15 occurs in raw words only
_WIDTHS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)  # bits of small ids

FILE_SCHEMA = "shard int, part long, start long, doc_ids array<long>, lengths array<long>, n_ids long, word_offsets binary, words binary"


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place of each padded block the selector of a word that begins there."""
    widest = {1: bits}

    def reach(n: int) -> np.ndarray:
        """Largest width among the n ids from each place on."""
        if n not in widest:
            a = n // 2 + n % 2
            left, right = reach(a), reach(n - a)
            out = left.copy()
            out[:, : bits.shape[1] - a] = np.maximum(left[:, : bits.shape[1] - a], right[:, a:])
            widest[n] = out
        return widest[n]

    best = np.zeros(bits.shape, dtype=np.uint8)
    for selector in range(len(LAYOUT), 0, -1):
        n, width = LAYOUT[selector - 1]
        np.copyto(best, selector, where=reach(n) <= width)
    return best


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the first word of each block of 1024 ids."""
    ids = ids.astype(np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, dtype="<u8"), np.zeros(0, dtype="<u4")
    padded = np.zeros((blocks, BLOCK + 60), dtype=np.uint64)
    flat = np.zeros(blocks * BLOCK, dtype=np.uint64)
    flat[: len(ids)] = ids
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    if int(ids.max()) < len(_WIDTHS):
        bits = _WIDTHS[padded]
    else:
        high, low = (padded >> np.uint64(32)).astype(np.float64), (padded & np.uint64(0xFFFFFFFF)).astype(np.float64)
        bits = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)
    selectors = _selectors(bits)
    size = np.full(blocks, BLOCK, dtype=np.int64)
    size[-1] = len(ids) - (blocks - 1) * BLOCK
    # every block goes on by one word a step
    rows, place = np.arange(blocks), np.zeros(blocks, dtype=np.int64)
    taken_rows, taken_places = [], []
    while len(rows):
        taken_rows.append(rows)
        taken_places.append(place)
        place = place + _COUNTS[selectors[rows, place]]
        on = place < size[rows]
        rows, place = rows[on], place[on]
    rows, place = np.concatenate(taken_rows), np.concatenate(taken_places)
    order = np.argsort(rows.astype(np.uint16) if blocks < 1 << 16 else rows, kind="stable")
    rows, place = rows[order], place[order]
    chosen = selectors[rows, place]
    at = np.arange(len(rows)) + np.cumsum(chosen == 0) - (chosen == 0)  # an escape takes two words
    words = np.zeros(len(rows) + int((chosen == 0).sum()), dtype=np.uint64)
    words[at[chosen == 0] + 1] = padded[rows[chosen == 0], place[chosen == 0]]
    for selector, (n, width) in enumerate(LAYOUT, 1):
        mine = np.flatnonzero(chosen == selector)
        if len(mine):
            word = np.full(len(mine), selector << 60, dtype=np.uint64)
            for j in range(n):
                word |= padded[rows[mine], place[mine] + j] << np.uint64(j * width)
            words[at[mine]] = word
    return words.astype("<u8"), at[np.searchsorted(rows, np.arange(blocks))].astype("<u4")


def unpack(words: np.ndarray, offsets: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of all blocks, as unsigned 64-bit integers."""
    out = np.zeros(len(offsets) * BLOCK, dtype=np.uint64)
    if not n_ids:
        return out[:0]
    words = words.astype(np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    # a raw word may look like an escape itself; runs of such words are followed in order
    for i in np.flatnonzero(selector == 0):
        if not raw[i]:
            raw[i + 1] = True
    counts = np.where(raw, 0, _COUNTS[selector])
    place = np.cumsum(counts) - counts
    block = np.searchsorted(offsets, np.arange(len(words)), side="right") - 1
    place = place - place[offsets.astype(np.int64)][block] + block * BLOCK
    limit = (block + 1) * BLOCK
    for s, (n, width) in enumerate(LAYOUT, 1):
        mine = np.flatnonzero((selector == s) & ~raw)
        mask = np.uint64((1 << width) - 1)
        for j in range(n if len(mine) else 0):
            to, value = place[mine] + j, (words[mine] >> np.uint64(j * width)) & mask
            fits = to < limit[mine]
            out[to[fits]] = value[fits]
    escapes = np.flatnonzero((selector == 0) & ~raw)
    out[place[escapes]] = words[escapes + 1]
    return out[:n_ids]


def write_tokens(docs: DataFrame, tokenizer_file: str, end_id: int, path: str) -> None:
    """Encodes every text, appends ``end_id`` and writes the ids to ``path`` by ``doc_id``."""
    names = ["shard", "part", "start", "doc_ids", "lengths", "n_ids", "word_offsets", "words"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizer_encoder(tokenizer_file), np.array([end_id], dtype="<u4").tobytes()
        shard, part, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, held, size = [], [], 0

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            words, offsets = pack(ids)
            return record_batch(schema, [shard], [part], [start], [doc_ids], [[len(x) // 4 for x in held]], [len(ids)], [offsets.tobytes()], [words.tobytes()])

        for batch in batches:
            for doc_id, text_ids in encoded_rows(batch, encode):
                coded = text_ids + end
                doc_ids.append(doc_id)
                held.append(coded)
                size += len(coded) // 4
                if size >= ROW_IDS:
                    yield row()
                    start, part = start + size, part + 1
                    doc_ids, held, size = [], [], 0
        if held:
            yield row()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32[, ids]``: how many ids there are before each document
    and in it, and the checksum of its ids as little-endian unsigned 32-bit integers."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # one row per written shard, of which there are as many as tasks
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = shards.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("base"))
    fields = [("shard", pa.int32()), ("doc_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["words"], dtype="<u8"), np.frombuffer(row["word_offsets"], dtype="<u4"), row["n_ids"])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                raw = memoryview(ids.astype("<u4").tobytes())
                parts = [raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist(), strict=True)]
                columns = [[row["shard"]] * len(parts), row["doc_ids"], (starts + row["start"]).tolist(), row["lengths"], [zlib.crc32(p) for p in parts]]
                yield record_batch(schema, *columns, *([[bytes(p) for p in parts]] * with_ids))

    rows = files.select("shard", "start", "doc_ids", "lengths", "n_ids", "word_offsets", "words")
    decoded = rows.mapInArrow(run, "shard int, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    start = (F.col("base") + F.col("within")).alias("start")
    return decoded.join(F.broadcast(bases), "shard").select("doc_id", start, "n_tokens", "ids_crc32", *(["ids"] * with_ids))
