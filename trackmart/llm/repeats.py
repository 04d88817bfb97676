"""Removal of long repeated byte strings with suffix arrays.

A string of 200 bytes is judged by whether it starts anywhere else in the corpus. Each such
string belongs to one *anchor*: of the 50-byte grams in it, the one with the smallest hash. Equal
strings have equal anchors at equal places, so neighbouring strings with one anchor form a
*piece* of text, and only pieces whose anchors are equal can share a string. Anchors that occur
once are ruled out by counting. The other pieces, each distinct one once, are gathered by anchor
into shards of a few megabytes. A shard builds its suffix array by Larsson-Sadakane refinement:
suffixes are sorted by their first symbols, then groups that are still equal are refined by the
ranks twice as far on. Kasai's method gives the common prefixes of neighbours; a string repeats
if one of them reaches 200. An anchor with very many distinct pieces is dealt to several shards;
these merge by exchanging the hashes of their distinct strings, as sorted arrays, one a shard and
range of hashes, and looking up by binary search which of them other shards hold too. An anchor
has the more ranges the more pieces it has, so that a range fits one task. Pieces that occur twice as a whole repeat throughout.

Contract: null and empty texts and those under 200 bytes lose nothing; repeated rows are copies
of each other; an empty table gives an empty result; matches never cross documents; only
``doc_id`` and ``text`` are read. Texts are told apart by 128-bit hashes, pieces of one anchor by
64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import drop_encoders, slices, texts, written

LENGTH, GRAM = 200, 50
PART = 1 << 19  # bytes that are hashed at once
SHARD_BYTES = 1 << 19
SHARDS_PER_TASK = 8
SPLIT = 2000  # distinct pieces of one anchor in one shard
RANGE_PIECES = 8192  # pieces of one anchor whose hashes one range holds
FILTER_BITS = 28  # the filter of repeated anchors has at most 2**28 bits
FILTER_BLOCK = 1 << 18  # bits of it that one group of a task puts together

_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        powers = np.full(n, base, dtype=np.uint64)
        powers[:1] = 1
        _POWERS[base] = np.multiply.accumulate(powers)
    return _POWERS[base][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of all substrings of a byte array."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * _powers(_BASE, len(raw)), out=self.sums[1:])
        self.inverse = _powers(_INVERSE, len(raw) + 1)

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:-length]) * self.inverse[:n])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """Smallest value in each window."""
    n = len(values) - window + 1
    padded = np.full(-(-len(values) // window) * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, window)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[window - 1 : window - 1 + n])


def pieces(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, piece hash, first and last string of every piece. ``ends`` cut the texts."""
    none = tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    if len(raw) < LENGTH:
        return none
    hashes = Hashes(raw)
    grams = hashes.all(GRAM)
    places = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    anchor = (_least((grams & ~low) | places, LENGTH - GRAM + 1) & low).astype(np.int64)
    valid = np.ones(len(anchor), dtype=bool)
    for k in range(len(ends) - 1):  # strings that would cross the end of a text
        valid[max(0, ends[k] - LENGTH + 1) : ends[k]] = False
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    return grams[anchor[start]], hashes.at(start, end + LENGTH), start, end


def _parts(batch: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts put together to some size; of a longer text, overlapping parts. Gives the bytes, the
    ends of the texts, their numbers in the batch and where in the text each begins."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for number, text in enumerate(batch):
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, PART):
            part = text[at : at + PART + LENGTH - 1]
            if held and size + len(part) > PART + LENGTH:
                yield _joined(held)
                held, size = [], 0
            held.append((number, at, part))
            size += len(part)
    if held:
        yield _joined(held)


def _joined(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(b"".join(p for _, _, p in held), dtype=np.uint8)
    numbers, begins = (np.array([h[j] for h in held], dtype=np.int64) for j in (0, 1))
    return raw, np.cumsum([len(p) for _, _, p in held]), numbers, begins


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _text_bytes(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """``anchor, several``: anchors that occur twice or more, and whether in different pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        for batch in slices(batches, 2000):
            found = [pieces(raw, ends)[:2] for raw, ends, _, _ in _parts(_text_bytes(batch))]
            if found:
                anchor, piece = (np.concatenate(x) for x in zip(*found, strict=True))
                piece = piece.view(np.int64)
                order = np.argsort(anchor, kind="stable")
                anchor, piece = anchor[order], piece[order]
                first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
                n = np.diff(np.append(first, len(anchor)))
                columns = [_signed(anchor[first]), pa.array(n), pa.array(np.minimum.reduceat(piece, first)), pa.array(np.maximum.reduceat(piece, first))]
                yield pa.record_batch(columns, names=["anchor", "n", "low", "high"])

    partial = docs.select("text").mapInArrow(run, "anchor long, n long, low long, high long")
    sums = partial.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return sums.filter("n >= 2").select("anchor", (F.col("low") != F.col("high")).alias("several"))


class Filter:
    """A set of hashes as bits; may hold more than was put in. Its size has a fixed bound. Tasks put
    the bits together by the block, the driver only joins the blocks and hands them on as a
    broadcast, of which a worker holds one copy."""

    def __init__(self, hashes: DataFrame, column: str, count: int):
        self.bits = min(FILTER_BITS, max(16, int(16 * count).bit_length()))
        h, mask, size = F.col(column), (1 << self.bits) - 1, min(FILTER_BLOCK, 1 << self.bits)
        places = F.explode(F.array(h.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(h, 34).bitwiseAND(F.lit(mask)))).alias("place")

        def packed(group: pa.Table) -> pa.Table:
            place = group.column("place").to_numpy()
            flags = np.zeros(size, dtype=bool)
            flags[place % size] = True
            bits = np.packbits(flags, bitorder="little").tobytes()
            return pa.table([pa.array([place[0] // size], pa.int64()), pa.array([bits], pa.binary())], names=["block", "bits"])

        blocks = hashes.select(places).groupBy(F.floor(F.col("place") / size)).applyInArrow(packed, "block long, bits binary")
        words = np.zeros(1 << (self.bits - 6), dtype="<u8")
        raw, step = words.view(np.uint8), size // 8
        for block, bits in written(blocks, "filter").toLocalIterator():
            raw[block * step : (block + 1) * step] = np.frombuffer(bits, dtype=np.uint8)
        self.words = hashes.sparkSession.sparkContext.broadcast(words)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out, mask, words = np.ones(len(h), dtype=bool), np.uint64((1 << self.bits) - 1), self.words.value
        for place in (h & mask, (h >> np.uint64(34)) & mask):
            out &= (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return out


OCCURRENCE = "anchor long, piece long, text_key binary, firsts array<int>, strings int, content binary"


def occurrences(docs: DataFrame, repeated: Filter, several: Filter) -> DataFrame:
    """Pieces with possibly repeated anchors: in which text, where, how many strings; the bytes
    come along once a task where pieces of one anchor may differ. A piece that a text holds many
    times is one row. Copies of a text give one row a batch, with a second one to mark that there
    are more."""
    names = [f.split()[0] for f in OCCURRENCE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        sent: set[tuple[int, int]] = set()
        for batch in slices(batches, 2000):
            every = _text_bytes(batch)
            keys = [hashlib.md5(t).digest() for t in every]
            seen: dict[bytes, int] = {}
            some = []
            for i, key in enumerate(keys):
                seen[key] = seen.get(key, 0) + 1
                if seen[key] <= 2:
                    some.append(i)
            chosen, keys = [every[i] for i in some], [keys[i] for i in some]
            for raw, ends, numbers, begins in _parts(chosen):
                anchor, piece, first, last = pieces(raw, ends)
                kept = np.flatnonzero(repeated(anchor))
                if not len(kept):
                    continue
                part = np.searchsorted(ends, first, side="right")
                kept = kept[np.lexsort((first[kept], piece[kept], anchor[kept], part[kept]))]
                anchor, piece, first, last, part = (x[kept] for x in (anchor, piece, first, last, part))
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]) | (part[1:] != part[:-1]))
                head = np.flatnonzero(new)
                contents: list[bytes | None] = [None] * len(head)
                for k in np.flatnonzero(several(anchor[head])).tolist():
                    i = head[k]
                    name = (int(anchor[i]), int(piece[i]))
                    if name not in sent:
                        sent.add(name)
                        contents[k] = raw[first[i] : last[i] + LENGTH].tobytes()
                within = (first - np.append(0, ends[:-1])[part] + begins[part]).astype(np.int32)
                offsets = np.append(head, len(anchor)).astype(np.int32)
                columns = [
                    _signed(anchor[head]),
                    _signed(piece[head]),
                    pa.array([keys[n] for n in numbers[part[head]]], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(within)),
                    pa.array((last - first + 1)[head].astype(np.int32)),
                    pa.array(contents, pa.binary()),
                ]
                yield pa.record_batch(columns, names=names)

    return docs.select("text").mapInArrow(run, OCCURRENCE)


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes and the place of each in it; equal ones are in order of their starts.

    ``ends[i]`` is where the text at place i ends; beyond it come blanks smaller than any symbol.
    """
    n = len(symbols)
    key = np.zeros(n, dtype=np.uint64)
    wide = np.concatenate([symbols.astype(np.uint64) + np.uint64(1), np.zeros(8, dtype=np.uint64)])
    left = ends - np.arange(n)
    for j in range(7):  # nine bits for each of the first seven symbols
        key <<= np.uint64(9)
        key |= wide[j : j + n] * (left > j)
    order = np.argsort(key)
    key = key[order]
    change = np.append(True, key[1:] != key[:-1])
    rank = np.full(n + 1, -1, dtype=np.int64)  # a group's rank is the place of its first member
    rank[order] = np.maximum.accumulate(np.where(change, np.arange(n), 0))
    bits = max(1, n.bit_length())
    mask = (1 << bits) - 1
    reach, longest = 7, left.max(initial=0)
    while True:
        # members of groups of several suffixes, refined by the ranks ``reach`` further on
        alone = change & np.append(change[1:], True)
        open_places = np.flatnonzero(~alone)
        if not len(open_places):
            break
        members = order[open_places]
        group = rank[members]
        onward = np.where(left[members] > reach, rank[np.minimum(members + reach, n)], -1) + 1
        if 3 * bits < 64:  # all in one word: the last bits are the suffix itself
            packed = (group << (2 * bits)) | (onward << bits) | members
            packed.sort()
            members = packed & mask
            packed >>= bits
            new = np.append(True, packed[1:] != packed[:-1])
        else:
            inner = np.lexsort((members, onward, group))
            members, group, onward = members[inner], group[inner], onward[inner]
            new = np.append(True, (group[1:] != group[:-1]) | (onward[1:] != onward[:-1]))
        order[open_places] = members
        change[open_places] = new
        rank[members] = np.maximum.accumulate(np.where(new, open_places, 0))
        if reach >= longest:
            break
        reach *= 2
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, place: np.ndarray, most: int = LENGTH, least: int = 1) -> np.ndarray:
    """Kasai's method, for all texts side by side: for each place of the order, how many symbols
    its suffix shares with the one before, up to ``most``. ``starts`` are those of the texts.
    Suffixes of less than ``least`` symbols are not looked at and have 0."""
    n = len(symbols)
    out = np.zeros(n, dtype=np.int64)
    at, h = starts.copy(), np.zeros(len(starts), dtype=np.int64)
    stop = ends[starts] - least + 1
    on = at < stop
    at, h, stop = at[on], h[on], stop[on]
    while len(at):
        mine = place[at]
        other = np.where(mine > 0, order[mine - 1], at)
        limit = np.where(mine > 0, np.minimum(np.minimum(ends[at] - at, ends[other] - other), most), 0)
        h = np.minimum(h, limit)
        going = np.flatnonzero(h < limit)
        while len(going):
            equal = symbols[at[going] + h[going]] == symbols[other[going] + h[going]]
            going = going[equal]
            h[going] += 1
            going = going[h[going] < limit[going]]
        out[mine] = h
        at, h = at + 1, np.maximum(h - 1, 0)
        on = at < stop
        at, h, stop = at[on], h[on], stop[on]
    return out


def repeated_strings(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places where a string starts that also starts elsewhere in these pieces, as flags over
    their bytes put together; where each piece starts; and the bytes."""
    symbols = np.frombuffer(b"".join(contents), dtype=np.uint8)
    sizes = np.array([len(c) for c in contents], dtype=np.int64)
    stops = np.cumsum(sizes)
    ends = np.repeat(stops, sizes)
    order, place = suffix_array(symbols, ends)
    shared = common_prefixes(symbols, stops - sizes, ends, order, place, least=LENGTH)
    reach = np.maximum(shared, np.append(shared[1:], 0)) >= LENGTH
    flags = np.zeros(len(symbols), dtype=bool)
    flags[order[reach]] = True
    return flags, stops - sizes, symbols


def _ranges(flags: np.ndarray) -> list[dict[str, int]]:
    """Runs of true flags as first and last."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]


RANGES = "array<struct<first:int,last:int>>"
_RANGE_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _shard_flags(contents: list[bytes]) -> list[np.ndarray]:
    """For each piece of a shard which of its strings occur elsewhere in the shard."""
    flags, starts, _ = repeated_strings(contents)
    return [flags[s : s + len(c) - LENGTH + 1] for s, c in zip(starts, contents, strict=True)]


def _shard_strings(contents: list[bytes]) -> list[np.ndarray]:
    """For each piece of a shard the hashes of its strings."""
    raw = np.frombuffer(b"".join(contents), dtype=np.uint8)
    hashes, stops = Hashes(raw).all(LENGTH), np.cumsum([len(c) for c in contents])
    return [hashes[stop - len(c) : stop - LENGTH + 1] for stop, c in zip(stops, contents, strict=True)]


def shared_ranges(content: DataFrame, tasks: int) -> DataFrame:
    """``anchor, piece, ranges``: strings that other pieces hold too. ``content`` has distinct
    pieces with ``shard``, ``split``, true where an anchor has several shards, and ``bits``, which
    tell the ranges of an anchor's hashes apart; they are dealt to ``tasks`` tasks."""

    def within(group: pa.Table) -> pa.Table:
        flags = _shard_flags(group.column("content").to_pylist())
        return pa.table([group.column("anchor"), group.column("piece"), pa.array([_ranges(f) for f in flags], _RANGE_TYPE)], names=["anchor", "piece", "ranges"])

    def strings(group: pa.Table) -> pa.Table:
        """The distinct strings of a shard by hash, in order, cut at the first bits."""
        found = np.unique(np.concatenate(_shard_strings(group.column("content").to_pylist())))
        bits = group.column("bits")[0].as_py()
        ranges = found >> np.uint64(64 - bits) if bits else np.zeros(len(found), dtype=np.uint64)
        first = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
        parts = [part.tobytes() for part in np.split(found, first[1:])]
        heads = [group.column(c).slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(first), dtype=np.int64))) for c in ("anchor", "shard")]
        return pa.table([*heads, _signed(ranges[first]), pa.array(parts, pa.binary())], names=["anchor", "shard", "range", "hashes"])

    def common(group: pa.Table) -> pa.Table:
        """Of each shard's strings in a range those that another shard holds too."""
        parts = [np.frombuffer(h, dtype=np.uint64) for h in group.column("hashes").to_pylist()]
        every, times = np.unique(np.concatenate(parts), return_counts=True)
        shared = every[times > 1]
        held = [np.intersect1d(part, shared, assume_unique=True).tobytes() for part in parts]
        out = pa.table([group.column("shard"), pa.array(held, pa.binary())], names=["shard", "hashes"])
        return out.filter(pa.array([bool(h) for h in held], pa.bool_()))

    def across(group: pa.Table, others: pa.Table) -> pa.Table:
        """Flags from the shard itself and from the strings that other shards hold too."""
        if not group.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), _RANGE_TYPE)], names=["anchor", "piece", "ranges"])
        contents = group.column("content").to_pylist()
        held = np.sort(np.frombuffer(b"".join(others.column("hashes").to_pylist()), dtype=np.uint64))
        out = []
        for flag, gram in zip(_shard_flags(contents), _shard_strings(contents), strict=True):
            at = np.searchsorted(held, gram)
            out.append(_ranges(flag | (held[np.minimum(at, len(held) - 1)] == gram) if len(held) else flag))
        return pa.table([group.column("anchor"), group.column("piece"), pa.array(out, _RANGE_TYPE)], names=["anchor", "piece", "ranges"])

    schema = f"anchor long, piece long, ranges {RANGES}"
    whole = content.filter("NOT split").repartition(tasks, "shard").groupBy("shard").applyInArrow(within, schema)
    divided = content.filter("split")
    exported = divided.groupBy("shard").applyInArrow(strings, "anchor long, shard long, range long, hashes binary")
    held = exported.groupBy("anchor", "range").applyInArrow(common, "shard long, hashes binary")
    merged = divided.groupBy("shard").cogroup(held.groupBy("shard")).applyInArrow(across, schema)
    return whole.unionByName(merged)


def repeated_spans(source: DataFrame) -> DataFrame:
    """``text_key, spans``: for every text that holds repeats, the bytes covered by them, as
    strings' first and last starting places. ``source`` has ``text``."""
    anchors = written(repeated_anchors(source), "anchors")
    sizes = anchors.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("several").cast("long")), F.lit(0)).alias("several")).first()
    repeated = Filter(anchors, "anchor", sizes["n"])
    several = Filter(anchors.filter("several"), "anchor", sizes["several"])
    found = written(occurrences(source, repeated, several), "occurrences")

    counts = found.groupBy("anchor", "piece").agg(F.sum(F.size("firsts")).alias("n"))
    # an anchor matters if it has several pieces, some of them only once
    per_anchor = counts.groupBy("anchor").agg(F.count("*").alias("pieces"), F.min("n").alias("least"))
    wanted = written(per_anchor.filter("pieces > 1 AND least = 1").drop("least"), "contested-anchors")
    bytes_ = found.filter("content IS NOT NULL").select("anchor", "piece", "content").dropDuplicates(["anchor", "piece"])
    contested = written(bytes_.join(wanted, "anchor"), "contested")
    volume = contested.agg(F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("size")).first()["size"]
    shards = max(1, -(-volume // SHARD_BYTES))
    parts = F.ceil(F.col("pieces") / SPLIT)
    salt = F.pmod(F.xxhash64("piece"), parts)
    split = parts > 1
    # a part of a split anchor is a shard by itself; other anchors share shards
    shard = F.when(split, F.xxhash64("anchor", salt)).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("pieces") / RANGE_PIECES))).cast("int")
    dealt = contested.select("anchor", "piece", "content", shard.alias("shard"), split.alias("split"), bits.alias("bits"))
    ranges = shared_ranges(dealt, max(1, shards // SHARDS_PER_TASK)).filter(F.size("ranges") > 0)

    # stored, so that the join below is between two plain tables and hot pieces can be split
    whole = F.array(F.struct(F.lit(0).alias("first"), F.lit(-1).alias("last")))  # up to the piece's last string
    copies = counts.filter("n > 1").select("anchor", "piece", whole.alias("ranges"))
    status = written(copies.unionByName(ranges), "status")
    marked = found.select("anchor", "piece", "text_key", "firsts", "strings").join(status, ["anchor", "piece"])

    def placed(first):
        last = lambda r: F.when(r["last"] < 0, F.col("strings") - 1).otherwise(r["last"])
        return F.transform("ranges", lambda r: F.struct((first + r["first"]).alias("first"), (first + last(r)).alias("last")))

    spans = marked.select("text_key", F.flatten(F.transform("firsts", placed)).alias("spans")).distinct()
    return spans.groupBy("text_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def covered(spans: list[dict[str, int]], size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes within the strings that start in ``spans``."""
    out: list[tuple[int, int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans):
        end = min(size, last + LENGTH)
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in runs:
        kept.append(raw[at:start])
        at = end
    return b"".join([*kept, raw[at:]])


def _with_spans(docs: DataFrame, source: DataFrame) -> DataFrame:
    keyed = docs.withColumn("repeats_key_", F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))))
    spans = repeated_spans(source).withColumnsRenamed({"text_key": "repeats_key_", "spans": "repeats_spans_"})
    return keyed.join(spans, "repeats_key_", "left").drop("repeats_key_")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, runs, kept``: the removed runs of bytes, and what is left."""
    source = texts(docs)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raws, runs = _text_bytes(batch), []
            for raw, spans in zip(raws, batch.column("repeats_spans_").to_pylist(), strict=True):
                runs.append(covered(spans or [], len(raw)))
            columns = [
                batch.column("doc_id"),
                pa.array([len(r) for r in raws], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in x] for x in runs], run_type),
                pa.array([without(r, x) for r, x in zip(raws, runs, strict=True)], pa.binary()),
            ]
            yield pa.record_batch(columns, names=["doc_id", "n_bytes", "runs", "kept"])

    joined = _with_spans(source, source)
    return joined.mapInArrow(run, "doc_id long, n_bytes long, runs array<struct<start:long,end:long>>, kept binary")


def strip_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of the texts. Characters that are removed in part
    stay; a null text stays null."""
    joined = _with_spans(docs, texts(docs))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("repeats_spans_").to_pylist(), strict=True):
                if text is not None and spans:
                    raw, runs = text.encode(), []
                    for start, end in covered(spans, len(raw)):
                        while start < end and raw[start] & 0xC0 == 0x80:
                            start += 1
                        while end < len(raw) and end > start and raw[end] & 0xC0 == 0x80:
                            end -= 1
                        runs.append((start, end))
                    text = without(raw, runs).decode()
                kept.append(text)
            plain = batch.select(docs_columns)
            yield plain.set_column(place, plain.schema.field(place), pa.array(kept, type=plain.schema.field(place).type))

    docs_columns = docs.columns
    return joined.select(*docs.columns, "repeats_spans_").mapInArrow(run, docs.schema)
