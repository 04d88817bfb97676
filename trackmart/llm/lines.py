"""Removal of lines that many documents share.

Texts are split at line ends. A line's key is the line without white space at both ends, its
letters A-Z in lower case; it travels as 128 bits of hash. Lines are exploded into (document,
line) pairs, the distinct documents of each key are counted, and keys of at least ``min_documents``
documents lose all their lines. Which positions a text loses depends on the text alone, so they
are gathered per distinct text, not per row, and every text is put together again, by position,
where it is read: texts move only if the positions are too many to be broadcast.

A key that a third of all lines share leaves each task as one row of the count; where frequent
keys are too many to be broadcast, adaptive execution splits such a key's side of the join.

Contract: a null text is an empty one, which is one empty line; a key that is empty, or shorter
than ``min_chars`` code points, is kept wherever it is; documents are told apart by ``doc_id``,
so repeated rows count once, and rows without an id count as one document; every row has its own
result; very long texts are treated whole; an empty table gives no rows; only the two named
columns are read, others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import slices, texts, written
from trackmart.runtime import broadcast_if_small

BLANKS = b" \t\n\x0b\x0c\r"
_TEXT, _LINE = ["text_1", "text_2"], ["line_1", "line_2"]


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line. Bytes are put into lower case by ASCII alone, as UTF-8 allows."""
    return [line.strip(BLANKS).lower() for line in text.split(b"\n")]


def _code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


def _hashed(docs: DataFrame, min_chars: int, with_places: bool) -> DataFrame:
    """Hashes of the keys that count: ``doc_id, line_1, line_2`` once per row and key, or with
    the text's hash and the position, ``text_1, text_2, place, line_1, line_2``."""
    names = ([*_TEXT, "place"] if with_places else ["doc_id"]) + _LINE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, places, digests = [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                known = set()
                for place, key in enumerate(line_keys(text)):
                    if key and (min_chars <= 1 or _code_points(key) >= min_chars) and (with_places or key not in known):
                        known.add(key)
                        rows.append(row)
                        places.append(place)
                        digests.append(xxhash.xxh3_128_digest(key))
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            lines = [pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            at = pa.array(rows, pa.int64())
            kept = [batch.column(c).take(at) for c in (_TEXT if with_places else ["doc_id"])]
            yield pa.record_batch([*kept, *([pa.array(places, pa.int32())] if with_places else []), *lines], names=names)

    kinds = {"place": "int"}
    source = texts(docs)
    if with_places:
        source = _with_text_hash(source).drop("doc_id")
    return source.mapInArrow(run, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names))


def _with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"text_1": F.xxhash64("text"), "text_2": F.xxhash64(F.lit(1), F.col("text"))})


def frequent_lines(docs: DataFrame, min_documents: int = 10, min_chars: int = 1) -> DataFrame:
    """``line_1, line_2, documents``: keys that at least so many distinct documents hold."""
    pairs = _hashed(docs, min_chars, with_places=False).distinct()
    counted = pairs.groupBy(*_LINE).agg(F.count("*").alias("documents"))
    return counted.filter(F.col("documents") >= min_documents)


def drop_frequent_lines(
    docs: DataFrame, min_documents: int = 10, min_chars: int = 1, broadcast_bytes: int | None = None
) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` for every row: what is left of its text, and how many
    lines it had and lost. ``broadcast_bytes`` bounds what a join may broadcast."""
    frequent = written(frequent_lines(docs, min_documents, min_chars).select(*_LINE), "frequent-lines")
    found = _hashed(docs, min_chars, with_places=True).join(broadcast_if_small(frequent, broadcast_bytes), _LINE, "left_semi")
    # copies of a text name the same positions
    places = written(found.select(*_TEXT, "place").distinct(), "dropped-places")
    small = broadcast_if_small(places, broadcast_bytes) is not places
    dropped = places.groupBy(*_TEXT).agg(F.sort_array(F.collect_list("place")).alias("dropped"))
    met = _with_text_hash(texts(docs)).join(F.broadcast(dropped) if small else dropped, _TEXT, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            left, n_lines, n_dropped = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
                lines = text.split("\n")
                n_lines.append(len(lines))
                n_dropped.append(len(gone or ()))
                for place in reversed(gone or ()):
                    lines[place] = None
                left.append("\n".join(line for line in lines if line is not None))
            counts = [pa.array(n, pa.int64()) for n in (n_lines, n_dropped)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(left, pa.string()), *counts], names=["doc_id", "text", "n_lines", "n_dropped"])

    return met.select("doc_id", "text", "dropped").mapInArrow(run, "doc_id long, text string, n_lines long, n_dropped long")
