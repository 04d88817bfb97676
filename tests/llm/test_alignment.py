import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.cases import TEXTS, documents, empty, rows_of
from trackmart.llm import alignment, queries
from trackmart.llm.common import WordEncoder

FILES = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
MORE = ["▁odd", "a  b   c", " lead", "tail  ", "été ﬁ ＡＢ", "<s> x </s>", "́a‍👩‍👩‍👧", "日本語" * 50, "xyz" * 700, "1234567890" * 30]


def brute(rows):
    a_model, b_model = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a_model.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    docs, holders = [], Counter()
    for doc_id, text in rows:
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        a_bytes = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        groups = []
        if text and b"".join(a_bytes) == whole == b"".join(b_bytes):
            ends = [np.cumsum([len(t) for t in tokens]).tolist() for tokens in (a_bytes, b_bytes)]
            cuts = sorted(set(ends[0]) & set(ends[1]))
            at = [0, 0]
            for cut in cuts:
                group = []
                for side, ids in enumerate((a, b)):
                    start = at[side]
                    while at[side] < len(ids) and ends[side][at[side]] <= cut:
                        at[side] += 1
                    group.append(ids[start : at[side]])
                groups.append(group)
        links = Counter()
        for ga, gb in groups:
            for x in ga:
                for y in gb:
                    links[x, y] += 1
        holders.update(links.keys())
        docs.append((doc_id, groups, links))
    best = defaultdict(int)
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, groups, links in docs:
        listed = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        n_best = sum(n for pair, n in links.items() if holders[pair] == best[pair[0]])
        count_sum = sum(n * holders[pair] for pair, n in links.items())
        digest = hashlib.sha256(listed.encode()).hexdigest() if groups else ""
        out.append((doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), links.total(), n_best, count_sum, digest))
    return sorted(out, key=str)


def found(docs, **options):
    return sorted(map(tuple, alignment.align_tokens(docs, *FILES, **options).collect()), key=str)


@pytest.fixture(scope="module")
def awkward(spark):
    docs = documents(spark, [*TEXTS[:-1], *MORE, *MORE[:3]])
    return docs, brute(rows_of(docs))


@pytest.mark.parametrize("options", [{}, {"hot_pairs": 20}, {"hot_pairs": 0, "broadcast_bytes": 0}])
def test_equals_brute_force(awkward, options):
    docs, expected = awkward
    assert found(docs, **options) == expected
    assert sum(r[1] == 0 for r in expected) > 3 and max(r[4] for r in expected) > 500


@pytest.mark.parametrize("hot_pairs", [1 << 20, 50])
def test_long_documents_in_chunks(spark, hot_pairs):
    text = " ".join(f"w{i * 7919 % 4001} straße 日本語{i % 13}" for i in range(1500))
    docs = spark.createDataFrame([(1, text), (2, "short one"), (3, text)], "doc_id long, text string").repartition(1)
    assert found(docs, hot_pairs=hot_pairs, link_rows=300) == brute(rows_of(docs))
    chunks = alignment.aligned(docs, *FILES, link_rows=300).groupBy("doc_id").count().collect()
    assert max(r["count"] for r in chunks) > 3


def test_links_come_in_chunks_without_repeats():
    tokens = alignment.pa.array([b"ab", b"a", b"b", b" "])
    raw = ["abab abab", "ab"]
    a_ids = [np.array([3, 0, 0, 3, 1, 2, 0]), np.array([3, 0])]
    b_ids = [np.array([3, 1, 2, 0, 3, 0, 1, 2]), np.array([3, 1, 2])]
    counts, listed, links = alignment.align(raw, a_ids, b_ids, tokens, tokens, link_rows=5)
    tables = list(links)
    assert [c.tolist() for c in counts] == [[7, 2], [8, 3], [6, 2], [9, 3]]
    assert listed == ["3|3;0|1,2;0|0;3|3;1,2|0;0|1,2", "3|3;0|1,2"]
    rows = [tuple(r.values()) for t in tables for r in t.to_pylist()]
    assert len(tables) > 1 and len(rows) == len({r[:3] for r in rows})
    assert sorted(rows) == sorted([(0, 3, 3, 2), (0, 0, 1, 2), (0, 0, 2, 2), (0, 0, 0, 1), (0, 1, 0, 1), (0, 2, 0, 1), (1, 3, 3, 1), (1, 0, 1, 1), (1, 0, 2, 1)])


def test_empty_table_and_query_columns(spark):
    assert found(empty(spark)) == []
    assert "op13_token_alignment" in queries.QUERIES


def test_tokens_spell_their_documents_as_bytes():
    tokens = pa.array([b" a", b"b", "é".encode()], pa.binary())
    side = alignment.Side(alignment.lists([np.array([0, 1]), np.array([], dtype=int), np.array([2, 2])]), tokens)
    assert side.texts() == [b" ab", b"", "éé".encode()]
    assert all(type(t) is bytes for t in side.texts())


def test_many_portions_are_encoded_at_once(monkeypatch):
    raw = [f"word {i} of{'f' * (i % 7)} x." * (i % 40) for i in range(1300)]
    encode, whole = WordEncoder(FILES[0]), []
    monkeypatch.setattr(encode, "coded", lambda texts, coded=encode.coded: whole.append(len(texts)) or coded(texts))
    got = list(alignment._encoded_portions(iter([pa.record_batch({"text": raw})]), encode))
    assert whole == [1300] and len(got) > 2
    assert [t for batch, _ in got for t in batch.column("text").to_pylist()] == raw
    tokenizer = Tokenizer.from_file(FILES[0])
    assert [x.tolist() for _, ids in got for x in ids] == [tokenizer.encode(" " + t, add_special_tokens=False).ids for t in raw]
