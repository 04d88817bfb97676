import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trackmart.llm import bpe, packing, tokenfile
from trackmart.llm.common import WordEncoder, written
from trackmart.runtime import scratch_path

from .cases import documents, empty, rows_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def uint32(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def reference(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("part_chars", [7, 1 << 16])
def test_bpe_equals_the_library_and_decodes_to_the_text(spark, part_chars):
    docs = documents(spark)
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, part_chars), RANKS).collect()
    expected = [(i, uint32(encoding.encode_ordinary(t)), t.encode()) for i, t in rows_of(docs)]
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got) == Counter(expected)


def test_decoding_gives_raw_bytes(spark):
    half = uint32([bpe.read_ranks(RANKS)[b"\xc3"]])
    coded = spark.createDataFrame([(1, half), (2, None)], "doc_id long, ids binary")
    assert {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(coded, RANKS).collect()} == {1: b"\xc3", 2: b""}


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60_000) | st.just(0) | st.integers(2**60, 2**64 - 1), max_size=3000))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(ids):
    words, offsets = tokenfile.pack(np.array(ids, dtype=np.uint64))
    assert tokenfile.unpack(words, offsets, len(ids)).tolist() == ids
    for k, start in enumerate(offsets):  # blocks stand on their own
        end = offsets[k + 1] if k + 1 < len(offsets) else len(words)
        block = ids[k * tokenfile.BLOCK : (k + 1) * tokenfile.BLOCK]
        assert tokenfile.unpack(words[start:end], np.zeros(1, dtype="<u4"), len(block)).tolist() == block


def test_token_files(spark, monkeypatch):
    docs = documents(spark)
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(docs.repartition(5), BYTE_BPE, 0, path)
    got = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in tokenfile.read_tokens(spark, path).collect()]
    encode = reference(BYTE_BPE)
    expected = Counter((i, uint32([*encode(t), 0])) for i, t in rows_of(docs))
    assert Counter((i, ids) for i, _, ids in got) == expected
    start = 0
    for doc_id, at, ids in sorted(got, key=lambda r: r[1]):
        assert at == start
        start += len(ids) // 4
    in_order = [i for i, _, _ in sorted(got, key=lambda r: r[1])]
    assert in_order == sorted(in_order, key=lambda i: -1 if i is None else i)


def test_token_files_of_nothing(spark):
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(empty(spark), BYTE_BPE, 0, path)
    assert tokenfile.read_tokens(spark, path).collect() == []


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing_of_documents(spark, capacity):
    docs = documents(spark)
    encode = reference(WORD_BPE)
    expected = Counter()
    for doc_id, text in rows_of(docs):
        ids = [*encode(text), 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            expected[doc_id, k, at, uint32(ids[at : at + capacity])] += 1
    got = packing.pack_documents(docs, WORD_BPE, 1, capacity, with_ids=True).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in got) == expected
    assert packing.pack_documents(empty(spark), WORD_BPE, 1).collect() == []
    check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], capacity)


def check_sequences(rows, capacity):
    sequences = defaultdict(list)
    for sequence, offset, length in rows:
        sequences[sequence].append((offset, length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def optimum(lengths, capacity):
    """Fewest sequences, by trying everything."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[k]}:
            left = list(rooms)
            left.remove(room)
            place(k + 1, [*left, room - lengths[k]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=300, deadline=None)
def test_reduction_keeps_an_optimal_packing(lengths):
    capacity = 20
    fixed, rest = packing.reduce_by_dominance(dict(Counter(lengths)), capacity)
    placed = Counter()
    for filling, times in fixed:
        assert sum(length * each for length, each in filling) <= capacity
        for length, each in filling:
            placed[length] += each * times
    assert placed + Counter(rest) == Counter(lengths)
    remaining = list(Counter(rest).elements())
    assert sum(t for _, t in fixed) + (optimum(remaining, capacity) if remaining else 0) == optimum(lengths, capacity)


@given(st.lists(st.integers(1, 50), min_size=1, max_size=200))
@settings(max_examples=200, deadline=None)
def test_slots_hold_every_piece_once(lengths):
    counts, capacity = Counter(lengths), 50
    fixed, rest = packing.reduce_by_dominance(dict(counts), capacity)
    places = packing.slots(fixed + packing.best_fit(rest, capacity))
    rows, seen = [], Counter()
    for _, group in places.groupby("length"):
        ends = list(group["first"])[1:] + [counts[int(group["length"].iloc[0])]]
        for (_, slot), end in zip(group.iterrows(), ends, strict=True):
            for within in range(end - slot["first"]):
                seen[int(slot["length"])] += 1
                rows.append((slot["sequence"] + within % slot["times"], slot["offset"] + within // slot["times"] * slot["length"], slot["length"]))
    assert seen == counts
    check_sequences(rows, capacity)


@pytest.mark.parametrize("counts", [{1999: 10**9}, {2000: 10**9, 1000: 10**9}, {3000: 10**9 + 1, 1000: 10**9, 50: 3}])
def test_reduction_takes_equal_pieces_in_one_step(counts):
    began = time.process_time()
    fixed, rest = packing.reduce_by_dominance(counts, 4096)
    assert time.process_time() - began < 0.1 and len(fixed) <= 2 * len(counts)
    placed = {length: rest.get(length, 0) + sum(each * times for filling, times in fixed for n, each in filling if n == length) for length in counts}
    assert placed == counts


def test_full_pieces_have_a_sequence_each(spark):
    rows = [(i, p, 10 * p, 10, 0) for i in range(40) for p in range(2)] + [(i, 2, 20, 1 + i % 9, 0) for i in range(40)]
    stored = written(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    for pieces in (stored, written(stored.where("length = 10"), "pieces"), written(stored.where("length < 10"), "pieces")):
        got = packing.pack(pieces, 10).collect()
        assert sorted(tuple(r[c] for c in pieces.columns) for r in got) == sorted(tuple(r) for r in pieces.collect())
        taken = [(r.sequence_id, t) for r in got for t in range(r.offset, r.offset + r.length)]
        assert len(taken) == len(set(taken)) and all(t < 10 for _, t in taken)
        full = [r.sequence_id for r in got if r.length == 10]
        assert len(full) == len(set(full)) and not set(full) & {r.sequence_id for r in got if r.length < 10}


def test_a_length_that_is_most_of_the_table_is_numbered_in_parts(spark):
    pieces = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "CAST(IF(id % 10 = 0, 7, 1000) AS LONG) AS length")
    got = packing.numbered(pieces).collect()
    for length, n in ((7, 500), (1000, 4500)):
        assert sorted(r["number"] for r in got if r["length"] == length) == list(range(n))


ATOMS = [*" \n\t\r\x0b\x1c\x85\xa0\u2009\u3000\u200b", "  ", "\n\n", "'s", "'ll", "'", "\u2019", *".,$_-=~\x00\x7f", "***", "The", "word", "don't", "12", "\xb2"]
ATOMS += [*"aé\u0301\u0331\u0307\u0130ßſŉΣǄŸ×÷ªµ\u212a\u212b中😀", "H\u0331", "слово", "\u1100\u1161", "<|endoftext|>", "<|startoftext|>"]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encoding_in_parts_equals_the_library(path):
    encoder, encode = WordEncoder(path, limit=300), reference(path)

    @given(st.lists(st.lists(st.sampled_from(ATOMS), max_size=12).map("".join), max_size=20))
    @settings(max_examples=300, deadline=None)
    def check(texts):
        assert encoder(texts) == [uint32(encode(t)) for t in texts]

    check()
    assert len(encoder.known) <= 300


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_known_words_with_other_signs_and_lines_are_not_encoded_again(path, monkeypatch):
    words = ["stone", "rivér", "Quarrel", "thanstle"]
    encoder, encode = WordEncoder(path), reference(path)
    encoder(["x. " + " ".join(words), "\n".join(["x", *words]), "x, x; x*** x"])
    given_away = []
    monkeypatch.setattr(encoder, "encode", lambda parts: given_away.extend(parts) or [encode(p) for p in parts])
    text = "x " + " ".join(w + s for w in words for s in (".", ",", ";", "***")) + "\n" + ".\n".join(words)
    assert encoder([text]) == [uint32(encode(text))]
    assert given_away == []
