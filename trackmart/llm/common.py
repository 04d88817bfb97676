"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.runtime import scratch_path

_CUT = re.compile("(?<=[!-~])(?=[\t-\r ])")
# Kinds of bytes. Those of longer characters are told apart by the first one.
_DIGIT_OR_LETTER, _SIGN, _BREAK, _SPACE, _FIRST = 1, 2, 3, 4, 5
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[33:127] = _SIGN
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _DIGIT_OR_LETTER
_KINDS[9:14], _KINDS[32], _KINDS[0xC2:0xF5] = _BREAK, _SPACE, _FIRST
_LOWER = np.arange(256, dtype=np.uint8)  # and white space as spaces
_LOWER[65:91], _LOWER[9:14] = np.arange(97, 123), 32
# First bytes, or two, of all characters among which there is white space.
_UNSURE_1, _UNSURE_2 = [0xC2], [0xE19A, 0xE1A0, 0xE280, 0xE281, 0xE380]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as an empty one; other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that nothing before it is ever replayed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, which bounds what a task holds as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def long_cuts(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut in front of white space only."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _edges(data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks first and last bytes of characters that surely are not white space, and last bytes of
    such as surely are letters or digits."""
    word = kind == _DIGIT_OR_LETTER
    begins = word | (kind == _SIGN)
    ends = begins.copy()
    first = np.flatnonzero(kind == _FIRST)
    if len(first):
        lead, second = data[first], data[first + 1]
        sure = ~(np.isin(lead, _UNSURE_1) | np.isin(lead.astype(np.int32) << 8 | second, _UNSURE_2))
        last = first + 1 + (lead >= 0xE0) + (lead >= 0xF0)
        begins[first[sure]], ends[last[sure]] = True, True
        signs = (lead == 0xC3) & ((second == 0x97) | (second == 0xB7))  # times and divided
        signs |= (lead == 0xC4) & (second == 0xB0)  # a dotted I ends in a mark when it is in lower case
        word[last[(lead >= 0xC3) & (lead <= 0xC5) & ~signs]] = True  # U+00C0 to U+017F
    return begins, ends, word


def _safe_cuts(data: np.ndarray) -> np.ndarray:
    """Marks the bytes in front of which UTF-8 text may be cut and its parts be encoded one by one.

    The split patterns of the vocabularies have matches of letters, of digits or of signs, with a
    space before them at most, matches of white space, and those that begin with an apostrophe. So
    none goes from a visible character on into white space, or from a letter or digit on into a
    sign; and a single break between visible characters is a match of its own.
    """
    kind = _KINDS[data]
    begins, ends, word = _edges(data, kind)
    lone = kind == _BREAK
    cuts = np.zeros(len(data), dtype=bool)
    cuts[1:] = (lone | (kind == _SPACE))[1:] & ends[:-1] | (kind == _SIGN)[1:] & word[:-1]
    cuts[2:] |= lone[1:-1] & begins[2:] & ends[:-2]
    return cuts


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one behind the other, and where each begins and the last ends."""
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int32)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[first:last] if last > first else np.zeros(0, dtype=np.uint8)
    return data, offsets - first


def _counts(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    return np.diff(np.concatenate([[0], np.cumsum(marked, dtype=np.int32)])[offsets])


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i for some in ids for i in some], dtype=np.uint32), np.array([len(some) for some in ids], dtype=np.int64)


def portions(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``size`` bytes of text together, or single longer ones."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        due = (ends[start - 1] if start else 0) + size
        end = max(start + 1, int(np.searchsorted(ends, due, side="right")))
        yield batch.slice(start, end - start)
        start = end


class WordEncoder:
    """Encodes texts in parts, about words, and remembers the ids of parts seen before.

    Texts are cut where no match of the tokenizers' split patterns goes across (``_safe_cuts``), so
    the ids of a text are those of its parts. All parts of a batch are told apart by Arrow; new ones
    are encoded many at a time and told apart by the bytes that their tokens stand for. A full
    memory gives up the half that was not used for longest; it only saves time.
    """

    TOGETHER = 200
    LONG = 64  # bytes of parts that are not remembered
    BATCH = 1 << 23  # bytes of the texts encoded at a time

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.keeps_space = not suffix  # byte-level vocabularies drop nothing
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token.removesuffix(suffix))
        self.limit = limit
        self.known = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.uint32()))  # of the known parts
        self.used = np.zeros(0, dtype=np.int64)  # when they were last
        self.now = 0

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def together(self, parts: list[str], sizes: np.ndarray, lead: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of all parts, encoded as one text with ``lead`` before each of them, and how many each
        has; None if they cannot be told apart. Parts have no white space at their ends, but for one
        space in front of each if there is no ``lead``."""
        ids = np.array(self.encode([lead + lead.join(parts)])[0], dtype=np.uint32)
        due = np.cumsum(sizes + (len(lead) if self.keeps_space else 0))
        read = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        begins, ends = (np.searchsorted(read, x, side="right") - 1 for x in (due - sizes, due))
        if ends[-1] != len(ids) or (read[begins] != due - sizes).any() or (read[ends] != due).any():
            return None
        if lead and self.keeps_space:  # without the ids of ``lead``
            inside = np.zeros(len(ids) + 1, dtype=np.int8)
            np.add.at(inside, begins, 1)
            np.add.at(inside, ends, -1)
            ids = ids[np.cumsum(inside[:-1]) > 0]
        return ids, ends - begins

    def learn(self, parts: pa.Array) -> pa.ListArray:
        """Ids of each part."""
        texts = parts.to_pylist()
        data, offsets = _bytes_of(parts)
        kind = _KINDS[data]
        begins, ends, _ = _edges(data, kind)
        spaced = kind[offsets[:-1]] == _SPACE
        joint = begins[np.minimum(offsets[:-1] + spaced, len(data) - 1)] & ends[offsets[1:] - 1]
        for i in np.flatnonzero(~joint).tolist():
            body = texts[i].removeprefix(" ")
            joint[i] = bool(body) and not body[0].isspace() and not body[-1].isspace()
        sizes = np.diff(offsets)
        if not self.keeps_space:  # only parts whose bytes keep their number are told apart by it
            sizes = _counts((kind != _SPACE) & (kind != _BREAK), offsets)
            odd = (data >= 0xC6) | (data == 0xC2) | (kind == 0) & ((data < 0x80) | (data >= 0xC0))
            odd[1:] |= (data[:-1] == 0xC4) & (data[1:] == 0xB0)  # grows in lower case
            joint &= _counts(odd, offsets) == 0
        order, ids, lengths = [], [], []
        for some, lead in ((joint & spaced, ""), (joint & ~spaced, "\n" if self.keeps_space else " ")):
            rows = np.flatnonzero(some)
            for start in range(0, len(rows), self.TOGETHER):
                group = rows[start : start + self.TOGETHER]
                chosen = [texts[i] for i in group.tolist()]
                order.append(group)
                for got, to in zip(self.together(chosen, sizes[group], lead) or _flat(self.encode(chosen)), (ids, lengths), strict=True):
                    to.append(got)
        rows = np.flatnonzero(~joint)
        order.append(rows)
        for got, to in zip(_flat(self.encode([texts[i] for i in rows.tolist()])), (ids, lengths), strict=True):
            to.append(got)
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int32)
        place = np.empty(len(texts), dtype=np.int64)
        place[np.concatenate(order)] = np.arange(len(texts))
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids))).take(pa.array(place))

    def remember(self, parts: pa.Array, ids: pa.Array) -> None:
        short = pc.less_equal(pc.binary_length(parts), self.LONG)
        parts, ids = parts.filter(short), ids.filter(short)
        self.known, self.ids = pa.concat_arrays([self.known, parts]), pa.concat_arrays([self.ids, ids])
        self.used = np.concatenate([self.used, np.full(len(parts), self.now)])
        if len(self.known) > self.limit:
            kept = np.sort(np.argsort(self.used, kind="stable")[-(self.limit // 2) :])
            self.known, self.ids, self.used = self.known.take(pa.array(kept)), self.ids.take(pa.array(kept)), self.used[kept]

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and where each text's begin and the last's end."""
        data, offsets = _bytes_of(texts.cast(pa.string()))
        if not len(data):
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        if not self.keeps_space:  # vocabularies with word ends are in lower case
            # characters from U+0180 on, such as marks, may change what a letter's lower case is joined with
            plain = _counts(data >= 0xC6, offsets) == 0
            data = _LOWER[data] if plain.all() else np.where(np.repeat(plain, np.diff(offsets)), _LOWER[data], data)
        cuts = _safe_cuts(data)
        cuts[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.append(np.flatnonzero(cuts), len(data)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data)).dictionary_encode()
        self.now += 1
        number = pc.index_in(parts.dictionary, self.known)
        new = pc.is_null(number)
        number = number.fill_null(-1).to_numpy().copy()
        self.used[number[number >= 0]] = self.now
        fresh = parts.dictionary.filter(new)
        learned = self.learn(fresh) if len(fresh) else self.ids[:0]
        number[number < 0] = len(self.known) + np.arange(len(fresh))
        ids = pa.concat_arrays([self.ids, learned]).take(pa.array(number[parts.indices.to_numpy()]))
        if len(fresh):
            self.remember(fresh, learned)
        at = ids.offsets.to_numpy()[np.searchsorted(starts, offsets)]
        return ids.values.to_numpy().astype("<u4", copy=False), at

    def __call__(self, batch: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, at = self.coded(batch if isinstance(batch, pa.Array) else pa.array(batch, pa.string()))
        raw, at = ids.tobytes(), (4 * at.astype(np.int64)).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]


def encoded_rows(batch: pa.RecordBatch, encode: WordEncoder) -> Iterator[tuple[int | None, bytes]]:
    """``doc_id`` and ids of every row, encoding some thousand texts at once."""
    for part in portions(batch, encode.BATCH):
        yield from zip(part.column("doc_id").to_pylist(), encode(part.column("text")), strict=True)


def _worker_state() -> dict[str, WordEncoder]:
    return sys.modules.setdefault("trackmart_worker_state", ModuleType("trackmart_worker_state")).__dict__.setdefault("encoders", {})


def drop_encoders() -> None:
    _worker_state().clear()


def tokenizer_encoder(path: str) -> WordEncoder:
    """Encoder for a vocabulary file of the tokenizers library; special strings are text.

    A worker process keeps it, with the words it knows, from task to task; other operators'
    tasks that need the memory call ``drop_encoders``.
    """
    kept = _worker_state()
    if path not in kept:
        kept.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept[path] = WordEncoder(path)
    return kept[path]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
