import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import DATA, duck, multiset, spark_rows
from tests.llm.cases import documents, empty, rows_of
from trackmart.llm import queries
from trackmart.llm.lexical import Shard, rank_documents, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(rows, items, k):
    docs = [(d, Counter(terms(t))) for d, t in rows]
    n, total = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in dict.fromkeys((i, t or "") for i, t in items):
        scored = []
        for doc_id, counts in docs:
            size, score = sum(counts.values()), 0
            for term in terms(text):
                tf = counts[term]
                if tf:
                    m = 100 - 75 + 75 * size * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if null else d, -s) for rank, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "The miller counts flour, FLOUR flour"), (2, "漢字かな交じり文 w7919 é"), (3, None), (4, "  "), (5, "nowhere"), (1, "two words"), (6, "mill"), (6, "mill"), (None, "x a line two")]


def ranked(spark, docs, items=ITEMS, **options):
    asked = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, rank_documents(docs, asked, **options).collect()), key=str)


@given(st.text())
@settings(max_examples=200)
def test_terms(text):
    assert [t.decode() for t in terms_of(text.encode())] == terms(text)


@pytest.mark.parametrize("options", [{}, {"k": 2}, {"block_bytes": 100}, {"shard_postings": 1}])
def test_equals_brute_force(spark, options):
    docs = documents(spark)
    assert ranked(spark, docs, **options) == brute(rows_of(docs), ITEMS, options.get("k", 10))


def test_ties_copies_and_empty_tables(spark):
    rows = [(i, "flour and mill " + "x " * (i % 3)) for i in range(200, 0, -1)] + [(7, "flour"), (7, "flour"), (None, "flour")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert ranked(spark, docs, k=5, shard_postings=50) == brute(rows, ITEMS, 5)
    assert ranked(spark, empty(spark)) == []
    assert ranked(spark, docs, items=[]) == []
    assert ranked(spark, spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")) == []


def random_shard(rng, n_docs=2000, n_terms=12):
    term, doc, impact = [], [], []
    for t in range(n_terms):
        mine = rng.choice(n_docs, size=rng.integers(1, n_docs), replace=False)
        term.append(np.full(len(mine), t))
        doc.append(mine)
        impact.append(np.sort((rng.pareto(1.2, len(mine)) * 100).astype(np.int64) + 1))
    return Shard(n_docs, *map(np.concatenate, (term, doc, impact)), n_terms), (np.concatenate(term), np.concatenate(doc), np.concatenate(impact))


def test_search_stops_early_and_misses_nothing():
    rng = np.random.default_rng(5)
    evaluated = 0
    for _ in range(20):
        shard, (term, doc, impact) = random_shard(rng)
        asked = rng.choice(12, size=4, replace=False)
        times = rng.integers(1, 4, size=4)
        score = np.zeros(2000, dtype=np.int64)
        for t, n in zip(asked, times):
            np.add.at(score, doc[term == t], n * impact[term == t])
        docs, scores, looked_at = shard.best(asked, times, 10)
        kth = np.sort(score)[-10]
        assert set(docs.tolist()) == set(np.flatnonzero(score >= kth).tolist())
        assert (score[docs] == scores).all()
        evaluated += looked_at
    assert evaluated < 20 * 2000 * 0.5


def test_best_position_goes_beyond_the_last_place_read():
    # documents met through the first list are all places of the second one
    term = np.repeat([0, 1], 100)
    doc = np.concatenate([np.arange(100), np.arange(100)])
    impact = np.concatenate([np.arange(1000, 900, -1), np.arange(500, 400, -1)])
    shard = Shard(100, term, doc, impact, 2)
    _, _, looked_at = shard.best(np.array([0, 1]), np.array([1, 1]), 1)
    assert looked_at == 8


def test_registered_query_equals_sql(spark):
    sf_dir = f"{DATA}/sf0.001"
    result = duck(sf_dir).execute(queries.ORACLES["op11_best_position"])
    columns, rows = spark_rows(queries.QUERIES["op11_best_position"](spark, sf_dir))
    assert multiset(columns, rows) == multiset([c[0] for c in result.description], result.fetchall())
