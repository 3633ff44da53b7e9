import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, id string, shard int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA)


def brute(ids, vectors, name, k):
    gap = vectors - vectors[list(ids).index(name)]
    scores = np.sqrt((gap * gap).sum(1))
    order = [j for j in np.lexsort((ids, scores)) if ids[j] != name][:k]
    return [(int(ids[j]), float(scores[j])) for j in order]


@pytest.mark.parametrize("shard", [64, 4000])
def test_recall_and_exact_scores(spark, shard):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 16))
    vectors = (centres[draw.integers(0, 20, 1500)] + 0.4 * draw.normal(size=(1500, 16))).astype(np.float32)
    vectors[200:500] = vectors[200]  # a common vector
    rows = table(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    got = {}
    for r in hnsw.nearest(rows, rows.where("vec_id % 50 = 0"), 10, shard=shard).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    wide, hit = vectors.astype(float), 0
    for name, found in got.items():
        want = brute(np.arange(1500), wide, name, 10)
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        for _, i, s in found:
            gap = wide[i] - wide[name]
            assert s == np.sqrt((gap * gap).sum())
        hit += len({i for i, _ in want} & {i for _, i, _ in found})
    assert len(got) == 30 and hit / 300 >= 0.9
    assert [i for _, i, _ in sorted(got[250])] == [200, 201, 202, 203, 204, 205, 206, 207, 208, 209]


def test_unusable_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (7, [1.0, 2.0]),
            (8, [1.0, 2.0, 3.0]), (100, [1.0, 0.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0])]
    data = table(spark, rows)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in hnsw.nearest(data, data, 3).collect())
    assert got == [
        (0, 1, 100, 0.0), (0, 2, 7, 2.0), (0, 3, 7, 2.0),
        (7, 1, 0, 2.0), (7, 2, 100, 2.0),
        (100, 1, 0, 0.0), (100, 2, 7, 2.0), (100, 3, 7, 2.0),
    ]


def test_empty(spark):
    data = table(spark, [])
    assert hnsw.nearest(data, data).collect() == []
    one = table(spark, [(100, [1.0])])
    assert hnsw.nearest(one, one).collect() == []


def test_graph_layers_are_flat_and_connected():
    draw = np.random.default_rng(1)
    graph = hnsw.Graph.build(draw.normal(size=(700, 8)))
    assert [len(x) for x in graph.layers] == [700, 58, 4]
    seen, todo = {0}, [0]
    while todo:
        near = [int(j) for j in graph.layers[0][todo.pop()] if j >= 0 and int(j) not in seen]
        seen.update(near)
        todo += near
    assert len(seen) > 690
