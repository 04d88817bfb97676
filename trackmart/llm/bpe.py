"""Byte-level BPE with a local rank file: encoding to ids and decoding to raw bytes.

Contract: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded
each on its own; an empty table gives an empty result; columns other than the named ones are
not read. Ids travel as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import long_cuts, record_batch, texts

# Texts beyond this many characters are encoded in parts, which bounds the encoder's memory.
PART_CHARS = 1 << 16


def read_ranks(rank_file: str) -> dict[bytes, int]:
    with open(rank_file, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def encode(docs: DataFrame, rank_file: str, pattern: str, part_chars: int = PART_CHARS) -> DataFrame:
    """``doc_id, ids``: every text's ids by the ranks in ``rank_file``, without special tokens.

    Long texts are cut where no match of ``pattern`` can reach across: in front of ASCII white
    space that follows a visible ASCII character. ``rank_file`` must be at the same place on
    every executor.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        core = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=read_ranks(rank_file), special_tokens={})
        for batch in batches:
            ids = [
                b"".join(core.encode_to_numpy(part, disallowed_special=()).astype("<u4").tobytes() for part in long_cuts(text, part_chars))
                for text in batch.column("text").to_pylist()
            ]
            yield record_batch(schema, batch.column("doc_id"), ids)

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids``, which need not be valid UTF-8."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tokens = {rank: token for token, rank in read_ranks(rank_file).items()}
        for batch in batches:
            decoded = [
                b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", dtype="<u4").tolist()))
                for ids in batch.column("ids").to_pylist()
            ]
            yield record_batch(schema, batch.column("doc_id"), batch.column("ids"), decoded)

    return encoded.select(F.col("doc_id"), F.col("ids")).mapInArrow(run, "doc_id long, ids binary, decoded binary")
