import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.serializers import CloudPickleSerializer

from trackmart.llm import forest, repeats
from trackmart.llm.graph import connected_components

from .cases import PROSE, TEXTS, documents, empty, rows_of

RNG = np.random.default_rng(7)
WORDS = [f"w{i}" for i in range(3000)]


def sentence(n):
    return " ".join(RNG.choice(WORDS, n))


def near(text, changes):
    words = text.split()
    for i in RNG.choice(len(words), changes, replace=False):
        words[i] = "changed" + str(i)
    return " ".join(words)


def family_texts():
    a, b, c = sentence(200), sentence(60), sentence(400)
    out = [a, a, a.upper(), near(a, 1), near(a, 2), near(a, 3), near(near(a, 3), 3), b, near(b, 1), c]
    out += [near(c, k) for k in range(1, 12)] + [sentence(100) for _ in range(20)]
    hot = sentence(150)
    return out + [near(hot, 1) for _ in range(60)] + ["only three words", "only three  words", "four words are here"]


def sets_of(rows):
    out = []
    for doc_id, text in rows:
        words = text.encode().lower().split()
        out.append((doc_id, frozenset([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else []))))
    return out


def brute_force(rows):
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i in range(len(sets)):
        groups[find(i)].append(sets[i][0])
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return Counter((d, least[find(i)], links[i]) for i, (d, _) in enumerate(sets))


@pytest.mark.parametrize("block", [512, 4])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block):
    verified = forest.verified
    monkeypatch.setattr(forest, "verified", lambda sets, threshold: verified(sets, threshold, block, 1 << 20))
    docs = documents(spark, TEXTS + family_texts())
    got = forest.jaccard_join(docs).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute_force(rows_of(docs))


def test_one_of_each_class_stays(spark):
    docs = documents(spark, [PROSE * 3, PROSE * 3, near(PROSE * 3, 1), "", None, sentence(50)])
    kept = forest.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 9, 12, 15]
    assert forest.one_of_each(empty(spark)).collect() == []
    assert forest.jaccard_join(empty(spark)).collect() == []


def test_prefixes_are_shortened_until_the_recall_is_reached():
    length = forest.prefix_length(24, 8, 0.8, 0.9999)
    assert 1 - (1 - 0.8**length) ** 24 >= 0.9999 > 1 - (1 - 0.8 ** (length + 1)) ** 24


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=5, deadline=None)
def test_components(spark, pairs):
    edges = spark.createDataFrame(pairs, "a long, b long")
    parent = {x: x for p in pairs if p[0] != p[1] for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {r["node"]: r["label"] for r in connected_components(edges).collect()} == {x: find(x) for x in parent}


def repeats_by_brute_force(rows):
    raws = [(i, t.encode()) for i, t in rows]
    counts = Counter(r[p : p + 200] for _, r in raws for p in range(len(r) - 199))
    out = Counter()
    for doc_id, r in raws:
        gone = np.zeros(len(r), dtype=bool)
        for p in range(len(r) - 199):
            if counts[r[p : p + 200]] > 1:
                gone[p : p + 200] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out[doc_id, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def passages():
    shared, short, cut = sentence(60), sentence(20)[:199], sentence(45)
    out = [f"{sentence(n)} {shared} {sentence(n + 3)}" for n in (5, 20, 40)] + [shared]
    out += [f"{sentence(12)} {short} {sentence(9)}" for _ in range(3)]  # too short to repeat
    out += [cut + " x " + sentence(5), "y " + cut[3:], sentence(30) + cut[:-1], cut[1:]]
    out += ["ab" * 400, "é" * 150 + "a", "é" * 150 + "b", "naïve " * 60 + sentence(30), sentence(80) + " naïve" * 50]
    return out + [f"{i} {sentence(4)} {shared[:230]} {sentence(4)}" for i in range(25)]


@pytest.mark.parametrize("split", [2000, 3])
@pytest.mark.parametrize("part", [1 << 20, 150])
def test_repeats_equal_brute_force(spark, monkeypatch, split, part):
    monkeypatch.setattr(repeats, "SPLIT", split)
    monkeypatch.setattr(repeats, "RANGE_PIECES", split)
    monkeypatch.setattr(repeats, "PART", part)
    chosen = [t for t in TEXTS if not t or len(t) < 10_000]
    docs = documents(spark, chosen + passages()).repartition(5)
    got = repeats.remove_repeats(docs).collect()
    found = Counter((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["runs"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got)
    assert found == repeats_by_brute_force(rows_of(docs))


def test_stripped_texts_stay_text(spark):
    docs = documents(spark, [None, "", "x" + "é" * 150, "é" * 150 + "y", sentence(80)])
    got = repeats.strip_repeats(docs)
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"] is not None and r["doc_id"] < 9} == {0: None, 3: "", 6: "x"}
    assert repeats.strip_repeats(empty(spark)).collect() == []
    assert repeats.remove_repeats(empty(spark)).collect() == []


@given(st.lists(st.binary(min_size=1, max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_suffix_array_and_common_prefixes(contents):
    symbols = np.frombuffer(b"".join(contents), dtype=np.uint8)
    sizes = np.array([len(c) for c in contents])
    stops = np.cumsum(sizes)
    ends = np.repeat(stops, sizes)
    order, place = repeats.suffix_array(symbols, ends)
    suffixes = [symbols[i : ends[i]].tobytes() for i in range(len(symbols))]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    shared = repeats.common_prefixes(symbols, stops - sizes, ends, order, place)
    for k in range(1, len(order)):
        a, b = suffixes[order[k - 1]], suffixes[order[k]]
        common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == min(common, 200)


@pytest.mark.parametrize("count", [300, 1 << 24])
def test_a_filter_travels_as_a_broadcast(spark, count):
    """Neither the driver's closures nor what it gathers hold the bits by the row."""
    hashes = RNG.integers(-(2**63), 2**63 - 1, 300)
    known = repeats.Filter(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h", count)
    assert known(hashes.view(np.uint64)).all()
    others = RNG.integers(0, 2**63, 20000).astype(np.uint64)
    assert known(others).mean() < 0.05
    assert len(CloudPickleSerializer().dumps(lambda: known)) < 10_000
    rows = spark.createDataFrame([(int(h),) for h in hashes[:50]], "h long").repartition(3)

    def found(batches):
        for batch in batches:
            yield batch.filter(pa.array(known(batch.column("h").to_numpy().view(np.uint64))))

    assert rows.mapInArrow(found, "h long").count() == 50
