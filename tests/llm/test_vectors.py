import math

import numpy as np
import pytest

from snapmart.llm import forest, impact, queries
from tests.conftest import SF001

SF01 = "/root/testdata/sf0.1"
NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_recall_of_the_forest(spark, sf):
    rows = queries.op9_projection_forest(spark, sf).collect()
    vecs = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, data = np.array([v.vec_id for v in vecs]), np.array([v.embedding for v in vecs], float)
    found, hits, asked = {}, 0, 0
    for r in rows:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in ids[ids % 100 == 0].tolist():
        dist = np.sqrt(((data - data[ids == q]) ** 2).sum(axis=1))
        dist[ids == q] = INF
        best = set(ids[np.lexsort((ids, dist))[:10]].tolist())
        ranked = sorted(found[q])
        assert [k for k, _, _ in ranked] == list(range(1, 11)) and [(s, v) for _, v, s in ranked] == sorted((s, v) for _, v, s in ranked)
        assert all(abs(dist[ids == v][0] - s) < 1e-12 for _, v, s in ranked)
        hits, asked = hits + len(best & {v for _, v, _ in ranked}), asked + 10
    assert hits >= 0.9 * asked


EDGE = [(100, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [NAN, 1.0]), (5, [INF, 0.0]), (6, [None, 1.0]), (7, []),
        (8, [0.0, 0.0]), (9, [1.0, 1.0, 1.0]), (200, [-1.0, -0.25]), (None, [1.0, 1.0]), (300, [0.0, 0.0]), (2, [0.5, 0.5]), (0, None)]


def edge(spark):
    return spark.createDataFrame(EDGE, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS score", "1 AS rank", "'y' AS v", "2 AS lane")


def usable(zero_too):
    return [(i, v) for i, v in EDGE if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero_too or any(v))]


def test_edges_of_the_exact_search(spark):
    rows = usable(True)
    want = []
    for q, x in rows:
        if q % 100 == 0:
            best = sorted((-sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(x, y, strict=True)), v)
                          for v, y in rows if v != q and len(y) == len(x))[:10]
            want += [(q, k, v, -s) for k, (s, v) in enumerate(best, 1)]
    assert sorted(map(tuple, impact.top_k(edge(spark)).collect())) == sorted(want)
    assert impact.top_k(edge(spark).limit(0)).collect() == []


def test_edges_of_the_forest(spark):
    rows = [(i, v) for i, v in usable(False) if len(v) == 2]
    want = []
    for q, x in rows:
        if q % 100 == 0:
            want += [(q, k, v, s) for k, (s, v) in enumerate(sorted((math.dist(x, y), v) for v, y in rows if v != q)[:10], 1)]
    got = sorted(map(tuple, forest.nearest(edge(spark)).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)] and all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, sorted(want), strict=True))
    assert forest.nearest(edge(spark).limit(0)).collect() == []


def test_exact_search_with_ties_and_signs():
    rnd = np.random.default_rng(1)
    for _ in range(40):
        n, dim = int(rnd.integers(1, 300)), int(rnd.integers(1, 9))
        data = rnd.integers(-3, 4, (n, dim)) * int(rnd.choice([1, 50]))
        ids = rnd.permutation(n)
        index = impact.Index(ids, data.astype(float))
        for q_id in (0, n + 5):
            q = rnd.integers(-3, 4, dim)
            found, score = index.search(q_id, q, 5)
            top = sorted(zip((-score).tolist(), found.tolist(), strict=True))[:5]
            assert top == sorted((-int(data[i] @ q), int(ids[i])) for i in range(n) if ids[i] != q_id)[:5]


def test_equal_vectors_can_be_filed():
    data = np.ones((500, 4))
    tree = forest.grow(data, 1)
    assert set(forest.file_rows(tree, data).tolist()) == {0} and forest.opened([tree], data[0], 1.0)[0].all()
    mixed = np.concatenate([data, np.random.default_rng(0).standard_normal((300, 4))])
    tree = forest.grow(mixed, 1)
    leaves = forest.file_rows(tree, mixed)
    assert leaves.min() >= 0 and abs(sum(tree[3]) - 1) < 1e-9 and len(set(leaves[:500].tolist())) == 1
