"""Alignment of the tokens of two tokenizers by the bytes they stand for.

Every text is encoded by both tokenizers. Token ids are flattened with the index of their parent
document; token lengths, summed up within each document, give the byte at which a token ends. An
Acero hash join of both sides on (document, end) finds the places where tokens of both end; those
cut the tokens into groups, numbered by a running sum over the cuts. Within a group every A token
is linked with every B token; the links are kept as distinct id pairs of a document with their
number, never one by one. Partial counts of the documents that hold a pair come from
``Table.group_by`` in every task; Spark adds them up.

To look the counts up again, the pairs held by most documents, as many as fit ``HOT_PAIRS``, are
sent to all tasks, together with the highest count of every A id, of which there are no more than
the vocabulary has. Links of all other pairs are rare by construction; they meet their counts in a
shuffle join, per distinct text, where no pair has more rows than the chosen count.

A document's pairs are stored in rows of at most some ``LINK_ROWS`` links before equal ones are
joined, cut between A ids, so that also a text that never aligns is handled within bounded memory.

Contract: texts that are null or empty, or whose tokens do not give back a space and the text, have
no tokens: all figures are 0 and the list of groups is ''. Every row is a document of its own, a
repeated row too; null ids are kept; very long texts are treated whole; an empty table gives no
rows; only ``doc_id`` and ``text`` are read, other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import WordEncoder, drop_encoders, portions, slices, texts, tokenizer_encoder, written
from trackmart.runtime import broadcast_if_small

HOT_PAIRS = 1 << 20
LINK_ROWS = 1 << 18  # of the documents aligned at a time, and of a stored row
KNOWN_WORDS = 600_000  # parts of texts of which an encoder remembers the ids
PARTIAL_ROWS = 1 << 20  # of the partial counts of a task
TEXT_CHARS = 1 << 18  # characters of the texts aligned at a time
ENCODED_BYTES = 1 << 22  # of the texts that are encoded by A at a time
ID_BITS = 26  # of a token id, where a document's place and two ids are one key
ID_MASK = (1 << ID_BITS) - 1

_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_ROW = [("doc_id", pa.int64()), ("text_1", pa.int64()), ("text_2", pa.int64()), ("chunk", pa.int32())]
_ROW += [(c, pa.int64()) for c in _COUNTS] + [("groups", pa.string())]
_ROW += [("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]
_ROW_DDL = (
    "doc_id long, text_1 long, text_2 long, chunk int, n_a long, n_b long, n_groups long, n_links long, "
    "groups string, a array<int>, b array<int>, n array<int>"
)
_KEY = ["text_1", "text_2"]


def byte_level_tokens(tokenizer) -> pa.Array:
    """The bytes of every id of a byte-level vocabulary of the tokenizers library."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    places = {chr(b): b for b in shown}
    places |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocabulary = tokenizer.get_vocab()
    out: list[bytes | None] = [None] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        out[number] = bytes(places[c] for c in token) if all(c in places for c in token) else token.encode()
    return pa.array(out, pa.binary())


def piece_tokens(processor) -> pa.Array:
    """The bytes of every piece of a sentencepiece model."""
    pieces = [processor.id_to_piece(i) for i in range(processor.vocab_size())]
    byte = re.compile("<0x([0-9A-F]{2})>")
    return pa.array([bytes([int(byte.fullmatch(p)[1], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], pa.binary())


class Side:
    """Tokens of some documents by one tokenizer: ids with their parents and their last bytes."""

    def __init__(self, ids: pa.ListArray, tokens: pa.Array):
        self.ids, self.parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
        spelled = tokens.take(self.ids)
        lengths = pc.binary_length(spelled).cast(pa.int64())
        total = pc.cumulative_sum(lengths).to_numpy() if len(lengths) else np.zeros(0, dtype=np.int64)
        offsets = ids.offsets.to_numpy()
        before = np.concatenate([[0], total])
        self.starts = before[offsets - offsets[0]]  # of every document, and the end of the last one
        self.end = total - self.starts[self.parent.to_numpy()]
        self.spelled = spelled.buffers()[2]

    def texts(self) -> list[bytes]:
        """What the tokens of every document spell; bytes, as views are compared one byte at a time."""
        spelled, starts = memoryview(self.spelled or b"").cast("B"), self.starts.tolist()
        return [spelled[a:b].tobytes() for a, b in zip(starts, starts[1:])]

    def ends(self, name: str) -> pa.Table:
        """Document and end of every token as one key, with the token's place."""
        return pa.table({"document_end": (self.parent.to_numpy() << 32) + self.end, name: np.arange(len(self.ids))})


def lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _joined(values: pa.Array, sizes: np.ndarray, by: str) -> pa.Array:
    """Runs of texts put together, ``sizes`` of them each."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), by)


def align(raw: list[str], a_ids: list[np.ndarray], b_ids: list[np.ndarray], a_tokens: pa.Array, b_tokens: pa.Array, link_rows: int = LINK_ROWS):
    """Figures of every document, its list of groups, and its links in chunks.

    Returns the four counts and the groups, each by document, and an iterator over tables
    ``doc, a, b, n`` that hold the distinct links, ascending by document, no pair in two tables.
    """
    sides = Side(lists(a_ids), a_tokens), Side(lists(b_ids), b_tokens)
    whole = [bool(t) and x == y == b" " + t.encode() for t, x, y in zip(raw, *[s.texts() for s in sides], strict=True)]
    if not all(whole):
        sides = tuple(Side(lists([x if w else x[:0] for x, w in zip(ids, whole)]), t) for ids, t in ((a_ids, a_tokens), (b_ids, b_tokens)))
    a, b = sides
    cuts = a.ends("place_a").join(b.ends("place_b"), "document_end", join_type="inner", use_threads=False)
    groups = []
    for side, place in ((a, "place_a"), (b, "place_b")):
        cut = np.zeros(len(side.ids), dtype=np.int64)
        cut[cuts[place].to_numpy()] = 1
        groups.append(pc.cumulative_sum(pa.array(cut)).to_numpy() - cut if len(cut) else cut)
    n_groups = np.bincount(cuts["document_end"].to_numpy() >> 32, minlength=len(raw))
    all_groups = int(n_groups.sum())
    group_doc = np.repeat(np.arange(len(raw)), n_groups)
    n_of = [np.bincount(g, minlength=all_groups) for g in groups]
    before = np.concatenate([[0], np.cumsum(n_of[0] * n_of[1])])
    n_links = np.diff(before[np.concatenate([[0], np.cumsum(n_groups)])])
    named = pc.binary_join_element_wise(*[_joined(s.ids.cast(pa.string()), n, ",") for s, n in zip(sides, n_of)], "|")
    listed = _joined(named, n_groups, ";").to_pylist()
    counts = [np.bincount(s.parent.to_numpy(), minlength=len(raw)) for s in sides]
    return [*counts, n_groups, n_links], listed, _links(a, b, groups, group_doc, n_of, link_rows)


def _links(a: Side, b: Side, groups: list[np.ndarray], group_doc: np.ndarray, n_of: list[np.ndarray], link_rows: int) -> Iterator[pa.Table]:
    """Groups of one token each give a link as they are. Of all others the distinct ids of both
    sides, with their numbers, meet in a join on the group."""
    pairs = (n_of[0] == 1) & (n_of[1] == 1)
    alone = [s.ids.to_numpy()[pairs[g]] for s, g in ((a, groups[0]), (b, groups[1]))]
    per_a, per_b = (
        pa.table({"key": (g[~pairs[g]] << 32) + s.ids.to_numpy()[~pairs[g]]}).group_by("key", use_threads=False).aggregate([([], "count_all")])
        for s, g in ((a, groups[0]), (b, groups[1]))
    )
    group = [t["key"].to_numpy() >> 32 for t in (per_a, per_b)]
    ids_a, ids_b = (t["key"].to_numpy() & 0xFFFFFFFF for t in (per_a, per_b))
    per_b = pa.table({"group": group[1], "b": ids_b, "n_b": per_b["count_all"]})
    # rows of A: single links, and ids that grow by the distinct B ids of their group
    doc = np.concatenate([group_doc[pairs], group_doc[group[0]]])
    ids = np.concatenate([alone[0], ids_a])
    grown = np.concatenate([np.ones(len(alone[0]), dtype=np.int64), np.bincount(group[1], minlength=len(pairs))[group[0]]])
    n_a, single = per_a["count_all"].to_numpy(), len(alone[0])

    def links(rows: np.ndarray) -> pa.Table:
        one, more = rows[rows < single], rows[rows >= single] - single
        grouped = pa.table({"group": group[0][more], "head": (group_doc[group[0][more]] << 2 * ID_BITS) + (ids_a[more] << ID_BITS), "n_a": n_a[more]})
        met = grouped.join(per_b, "group", join_type="inner", use_threads=False)
        key = np.concatenate([(doc[one] << 2 * ID_BITS) + (ids[one].astype(np.int64) << ID_BITS) + alone[1][one], met["head"].to_numpy() + met["b"].to_numpy()])
        n = np.concatenate([np.ones(len(one), dtype=np.int64), met["n_a"].to_numpy() * met["n_b"].to_numpy()])
        order = np.argsort(key)
        key, n = key[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, n = key[first], np.add.reduceat(n, first)
        return pa.table({"doc": key >> 2 * ID_BITS, "a": key >> ID_BITS & ID_MASK, "b": key & ID_MASK, "n": n})

    if not len(doc):
        return
    if grown.sum() <= link_rows:
        yield links(np.arange(len(doc)))
        return
    # rows of one document and A id stay together; a document is cut by itself, so that copies are cut alike
    order = np.lexsort((ids, doc))
    doc_of, id_of, grown = doc[order], ids[order], grown[order]
    begins = np.flatnonzero(np.concatenate([[True], (doc_of[1:] != doc_of[:-1]) | (id_of[1:] != id_of[:-1])]))
    sizes, of = np.add.reduceat(grown, begins), doc_of[begins]
    before = np.cumsum(sizes) - sizes
    cut = (before - before[np.searchsorted(of, of)]) // link_rows
    units = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (cut[1:] != cut[:-1])]))
    starts, unit_doc, unit_size = begins[units], of[units], np.add.reduceat(sizes, units)
    start, size = 0, 0
    for at, d, last, more in zip([*starts[1:].tolist(), len(doc)], [*unit_doc[1:].tolist(), -1], unit_doc.tolist(), unit_size.tolist()):
        size += more
        if d != last and d >= 0 and size < link_rows:
            continue
        yield links(order[start:at])
        start, size = at, 0


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``TEXT_CHARS`` characters together, or single longer ones."""
    for batch in slices(batches):
        lengths = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy())
        start = 0
        while start < batch.num_rows:
            due = (lengths[start - 1] if start else 0) + TEXT_CHARS
            end = max(start + 1, int(np.searchsorted(lengths, due, side="right")))
            yield batch.slice(start, end - start)
            start = end


def _encoded_portions(batches: Iterator[pa.RecordBatch], encode: WordEncoder) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Portions with the ids of a space and each text; many portions are encoded at once."""
    for batch in batches:
        for whole in portions(batch, ENCODED_BYTES):
            ids, at = encode.coded(pc.binary_join_element_wise("", whole.column("text"), " "))
            split = iter(np.split(ids, at[1:-1]))
            for part in _portions(iter([whole])):
                yield part, list(islice(split, part.num_rows))


def aligned(docs: DataFrame, a_file: str, b_file: str, link_rows: int = LINK_ROWS) -> DataFrame:
    """Per document its figures, groups as a text digest, and distinct links, in ``chunk`` 0 and
    further rows if there are many; equal texts have equal rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        encode = tokenizer_encoder(a_file)
        encode.limit = KNOWN_WORDS
        pieces = sentencepiece.SentencePieceProcessor(model_file=b_file)
        a_tokens, b_tokens = byte_level_tokens(encode.tokenizer), piece_tokens(pieces)
        for batch, a_ids in _encoded_portions(batches, encode):
            raw = batch.column("text").to_pylist()
            b_ids = [np.frombuffer(array("i", x), dtype=np.int32) for x in pieces.encode(raw, num_threads=1)]
            counts, listed, links = align(raw, a_ids, b_ids, a_tokens, b_tokens, link_rows)
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in listed]
            chunk = np.zeros(len(raw), dtype=np.int32)

            def rows(docs: np.ndarray, table: pa.Table | None) -> pa.RecordBatch:
                at = pa.array(docs)
                heads = [batch.column(c).take(at) for c in ("doc_id", *_KEY)] + [pa.array(chunk[docs], pa.int32())]
                figures = [pa.array(c[docs], pa.int64()) for c in counts] + [pa.array([digests[d] for d in docs], pa.string())]
                if table is None:
                    ends = pa.array(np.zeros(len(docs) + 1, dtype=np.int32))
                    parts = [pa.ListArray.from_arrays(ends, pa.array([], t.value_type)) for _, t in _ROW[-3:]]
                else:
                    ends = pa.array(np.append(np.searchsorted(table["doc"].to_numpy(), docs), table.num_rows).astype(np.int32))
                    parts = [pa.ListArray.from_arrays(ends, table[c].combine_chunks().cast(t.value_type)) for c, t in _ROW[-3:]]
                return pa.record_batch([*heads, *figures, *parts], schema=pa.schema(_ROW))

            for table in links:
                table = table.combine_chunks()
                mine = np.unique(table["doc"].to_numpy())
                yield rows(mine, table)
                chunk[mine] += 1
            without = np.flatnonzero(chunk == 0)
            if len(without):
                yield rows(without, None)
            pa.default_memory_pool().release_unused()

    source = texts(docs).withColumns({"text_1": F.xxhash64("text"), "text_2": F.xxhash64(F.lit(1), F.col("text"))})
    return source.mapInArrow(run, _ROW_DDL)


def _flat_links(batch: pa.RecordBatch) -> pa.Table:
    """``row, a, b, n`` of every link."""
    links = {c: pc.list_flatten(batch.column(c)) for c in ("a", "b")}
    links["n"] = pc.list_flatten(batch.column("n")).cast(pa.int64())
    return pa.table({"row": pc.list_parent_indices(batch.column("a")), **links})


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a, b, docs``: how many documents hold each linked pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        held, size = [], 0

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([("docs", "sum")]).rename_columns(["a", "b", "docs"])

        for batch in slices(batches, 1000):
            links = _flat_links(batch)
            some = links.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "docs"])
            held.append(some)
            size += some.num_rows
            if size > 2 * PARTIAL_ROWS:
                held[:] = [merged()]
                size = held[0].num_rows
                if size > PARTIAL_ROWS:
                    yield from held.pop().to_batches()
                    size = 0
        if held:
            yield from merged().to_batches()

    partial = rows.select("a", "b", "n").mapInArrow(run, "a int, b int, docs long")
    return partial.groupBy("a", "b").agg(F.sum("docs").alias("docs"))


def _hot_count(pairs: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` pairs reach; 1 if all are as few."""
    sizes = pairs.groupBy(F.floor(F.log2("docs")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()
    total = 0
    for row in sorted(sizes, key=lambda r: -r["power"]):
        total += row["n"]
        if total > most:
            return 2 ** (row["power"] + 1)
    return 1


def align_tokens(
    docs: DataFrame, a_file: str, b_file: str, hot_pairs: int = HOT_PAIRS, link_rows: int = LINK_ROWS, broadcast_bytes: int | None = None
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row."""
    rows = written(aligned(docs, a_file, b_file, link_rows), "aligned")
    pairs = written(pair_counts(rows), "pair-counts")
    least = _hot_count(pairs, hot_pairs)
    best = pairs.groupBy("a").agg(F.max("docs").alias("best"))
    sent = rows.sparkSession.sparkContext.broadcast((pairs.filter(F.col("docs") >= least).toArrow(), best.toArrow()))

    def met(batch: pa.RecordBatch) -> pa.Table:
        return _flat_links(batch).join(sent.value[0], ["a", "b"], join_type="left outer", use_threads=False)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        for batch in slices(batches, 1000):
            links = met(batch).filter(pc.field("docs").is_valid()).join(sent.value[1], "a", join_type="inner", use_threads=False)
            is_best = pc.if_else(pc.equal(links["docs"], links["best"]), links["n"], 0)
            summed = pa.table({"row": links["row"], "n_best": is_best, "count_sum": pc.multiply(links["n"], links["docs"])})
            summed = summed.group_by("row", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
            sums = []
            for name in ("n_best_sum", "count_sum_sum"):
                out = np.zeros(batch.num_rows, dtype=np.int64)
                out[summed["row"].to_numpy()] = summed[name].to_numpy()
                sums.append(pa.array(out))
            columns = [batch.column(c) for c in ("doc_id", *_KEY, "chunk", *_COUNTS, "groups")]
            yield pa.record_batch([*columns, *sums], names=["doc_id", *_KEY, "chunk", *_COUNTS, "groups", "n_best", "count_sum"])

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            links = met(batch).filter(pc.field("docs").is_null()).combine_chunks()
            keys = [batch.column(c).take(links["row"].combine_chunks()) for c in _KEY]
            yield pa.record_batch([*keys, *(links[c].combine_chunks() for c in ("a", "b", "n"))], names=[*_KEY, "a", "b", "n"])

    kept = "doc_id long, text_1 long, text_2 long, chunk int, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    scored = rows.mapInArrow(known, kept)
    heads = scored.filter("chunk = 0")
    # what is known of further chunks and of rare pairs, per distinct text
    rest = scored.filter("chunk > 0").select(*_KEY, "chunk", "n_best", "count_sum").distinct().drop("chunk")
    if least > 1:
        cold = rows.select(*_KEY, "a", "b", "n").mapInArrow(unknown, "text_1 long, text_2 long, a int, b int, n long").distinct()
        found = cold.join(pairs.filter(F.col("docs") < least), ["a", "b"]).join(broadcast_if_small(best, broadcast_bytes), "a")
        is_best = F.when(F.col("docs") == F.col("best"), F.col("n")).otherwise(0)
        rest = rest.unionByName(found.select(*_KEY, is_best.alias("n_best"), (F.col("n") * F.col("docs")).alias("count_sum")))
    more = written(rest.groupBy(*_KEY).agg(F.sum("n_best").alias("more_best"), F.sum("count_sum").alias("more_sum")), "further-sums")
    total = [(F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    whole = heads.join(broadcast_if_small(more, broadcast_bytes), _KEY, "left")
    return whole.select("doc_id", *_COUNTS, *total, F.col("groups").alias("groups_sha256"))
