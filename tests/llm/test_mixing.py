import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def targets(sizes, weights, most):
    """source -> target, by resharing until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        share = left / sum(weight[s] for s in free) if free else 0.0
        more = {s for s in free if weight[s] * share > most * sizes[s]}
        if not more:
            return {s: float(most * sizes[s]) if s in full else weight[s] * share for s in names}
        full |= more


def drawn(n, seed, sources):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        text = draw.choice(["", None, "a  b", "x " * draw.randrange(1, 60), "é\tü\n" * draw.randrange(30)])
        rows.append((draw.choice([i, i, i, None, 7]), draw.choice(sources), text))
    return rows


def words(text):
    return len((text or "").encode().split())


@pytest.mark.parametrize("seed", range(2))
def test_targets_and_words(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "FAN", 16)  # several levels of the tree
    rows = drawn(3000, seed, ["hot"] * 6 + ["a", "Z", "é", "𝄞", "￮", None, "b"]) + [(-1, "tiny", "one two")] + [(-2, "none", " ")]
    got = mixing.mixed(spark.createDataFrame(rows, SCHEMA)).collect()
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=key) == sorted(((i, s, words(t)) for i, s, t in rows), key=key)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = targets(sizes, (5, 2, 1), 3)
    for s, size in sizes.items():
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {size}
        assert all(r.target == pytest.approx(want[s]) for r in mine)
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in mine)
        if size:
            expected = want[s] / size
            assert all(r.copies in (int(expected), int(expected + 1 - 1e-9)) for r in mine if r.size)
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(r.size for r in mine)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree_however_the_rows_lie(spark):
    rows = drawn(800, 4, ["a", "b", None])
    once = mixing.mixed(spark.createDataFrame(rows, SCHEMA))
    random.Random(1).shuffle(rows)
    again = mixing.mixed(spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("n", F.lit("x")).withColumn("block", F.lit(1)))
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.copies)
    assert sorted(map(key, once.collect())) == sorted(map(key, again.collect()))


def test_equal_rows_are_split(spark):
    rows = [(5, "a", "w w w")] * 9001 + [(6, "b", "w")] * 10
    got = mixing.mixed(spark.createDataFrame(rows, SCHEMA)).groupBy("source").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert {r.source: r.n for r in got} == {"a": 9001, "b": 10}
    assert all(abs(r.taken - r.target) <= 3 for r in got)


def test_every_document_keeps_its_expectation():
    size = np.array([900, 400, 300, 40, 40, 7, 3, 3, 1])
    left = np.array([0.3, 0.7, 0.5, 0.9, 0.2, 0.25, 0.6, 0.1, 0.45])
    rng = np.random.default_rng(1)
    sums = np.zeros(len(size))
    for _ in range(20_000):
        up, rest = mixing.rounded(size, left, rng.random(len(size)))
        assert (rest > 0).sum() <= 1 and abs(((up + rest - left) * size).sum()) < 1e-6
        sums += up + rest
    assert np.abs(sums / 20_000 - left).max() < 0.015


def test_empty_tables_and_texts(spark):
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).collect() == []
    got = mixing.mixed(spark.createDataFrame([(1, "a", None), (2, None, "")], SCHEMA)).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    long = mixing.mixed(spark.createDataFrame([(1, "a", "w " * 300_000), (2, "b", "w")], SCHEMA)).collect()
    assert {r.doc_id: r.size for r in long} == {1: 300_000, 2: 1}
