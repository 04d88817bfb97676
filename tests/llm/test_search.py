import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmart.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, x int, ids int, score int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in vectors], SCHEMA)


def brute_force(vectors, k):
    usable = [(i, v) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in usable]
    out = []
    for q, a in whole:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("blocks", [(4096, 1024), (60, 2)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "BLOCK", blocks[0])
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[1])
    monkeypatch.setattr(topk, "FIRST", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (6, 8))
    vectors = [(i, (centres[i % 6] + rng.normal(0, 0.1, 8)).astype(np.float32).tolist()) for i in range(600)]
    vectors += [(700, None), (750, [float("nan")] + [0.0] * 7), (800, [None] * 8), (850, [float("inf")] * 8), (None, [1.0] * 8)]
    vectors += [(900, [1.0, 2.0]), (901, [1.0, 2.0]), (902, [3.0, 2.0])]  # other length, ties
    vectors += [(950 + j, vectors[0][1]) for j in range(7)] + [(150, vectors[150][1]), (151, vectors[151][1])]  # copies, repeated rows
    assert rows(topk.top_k(table(spark, vectors), F.col("vec_id") % 50 == 0)) == brute_force(vectors, 5)


def test_few_and_none(spark):
    some = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    assert rows(topk.top_k(table(spark, some), F.col("vec_id") % 50 == 0)) == [(0, 1, 1, 128 * 256)]
    assert rows(topk.top_k(table(spark, some[1:]), F.col("vec_id") % 50 == 0)) == []
    assert rows(topk.top_k(table(spark, []), F.col("vec_id") % 50 == 0)) == []


@pytest.mark.parametrize("large", [1e5, 3e6, 1e9, 1e37])
def test_large_components_cost_no_result(spark, large):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(200)]
    vectors += [(i, [large * x for x in v]) for i, v in vectors[:3]] + [(250, [-large] * 8), (251, [large] * 8), (252, [large] * 8), (251, [large] * 8)]
    expected = [(q, rank, i, s if -(2**63) <= s < 2**63 else None) for q, rank, i, s in brute_force(vectors, 5)]
    got = topk.top_k(table(spark, vectors), F.col("vec_id") % 50 == 0)
    by_rank = [sorted(e, key=lambda r: (*r[:3], str(r[3]))) for e in ([tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()], expected)]
    assert by_rank[0] == by_rank[1]


def test_bounds_spare_most_candidates():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (20, 16))
    x = np.floor(centres[np.arange(4000) % 20] + rng.normal(0, 10, (4000, 16))).astype(np.int64)
    reach = float((x**2).sum(1).max())
    pivots = topk.choose_pivots(x, reach)
    table_, queries = topk.distances(topk.extended(x, reach), pivots), x[:40]
    q_table = topk.distances(np.column_stack([queries.astype(float), np.zeros(40)]), pivots)
    place, ids, scores, evaluated = topk.search_block(np.arange(40), queries, q_table, np.arange(4000), x, table_, reach, 5)
    assert evaluated < 0.5 * 40 * 4000
    every = queries @ x.T
    every[np.arange(40), np.arange(40)] = -(10**9)
    assert (np.sort(every, axis=1)[:, ::-1][:, :5].ravel() == scores).all()
