import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.arrays import Texts

BAD = ["stupid", "idiotic", "worthless"]


def corpus(draw, n):
    rows = []
    for i in range(n):
        words = ["".join(draw.choice(["ta", "re", "no", "li", "su"]) for _ in range(draw.choice([1, 2, 3]))) for _ in range(draw.choice([5, 40]))]
        label = int(draw.random() < 0.3)
        if label:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(BAD) + draw.choice(["", ".", ","]))
        rows.append((i, " ".join(words), label))
    return rows


def test_held_out_accuracy_and_odd_texts(spark, with_clashes):
    rows = corpus(random.Random(1), 400)
    odd = [None, "", "x", "STUPID\nidiotic! worthless " * 4000]
    docs = with_clashes([t for _, t, _ in rows] + odd + [rows[0][1]], [i for i, _, _ in rows] + [1000, 1001, 1002, 1003, 0])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(None, 1), (5000, 1), (6, None)], "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == 405
    by_id = {r.doc_id: r for r in got}
    right = [by_id[i].predicted == y for i, _, y in rows if i % 5 == 0]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score < 0.5 and by_id[1000].evidence == []
    assert by_id[1003].predicted == 1 and len(by_id[1003].evidence) == 3
    assert len({r.score for r in got if r.doc_id == 0}) == 1


def test_no_labels_and_no_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.scored(documents(["a b c", None]), none).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(0, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.scored(documents(["a b c", None]), one).collect()} == {1.0}
    assert toxicity.scored(documents([]), none).collect() == []


def test_block_max_search_is_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    draw = np.random.default_rng(2)
    rows = []
    for i in range(50):
        terms = np.sort(draw.choice(12, draw.integers(1, 5), replace=False))
        rows.append((i, int(draw.integers(0, 2)), terms.tolist(), draw.integers(1, 4, len(terms)).tolist()))
    idf = draw.uniform(1, 5, 12)
    index = toxicity.Index.build(rows, idf)
    dense = np.zeros((50, 12))
    for place, name in enumerate(index.ids):
        _, _, terms, counts = rows[name]
        dense[place, terms] = (1 + np.log(counts)) * idf[terms]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    queries = dense[draw.permutation(50)][:20]
    best, who = index.nearest(queries, 6)
    for q, scores, names in zip(queries, best, who):
        every = np.round(dense @ q, 12)
        order = [i for i in np.lexsort((np.arange(50), -every)) if every[i] > 0][:6]
        assert names[names >= 0].tolist() == order
        assert scores[: len(order)] == pytest.approx(every[order])


def test_grams_are_counted_within_texts_only():
    texts = ["abcde", "fgh", "ABCDEFG abcde", ""]
    chosen = np.sort(np.concatenate([toxicity.grams(np.frombuffer(b"abcde", np.uint8), 5), toxicity.grams(np.frombuffer(b"abcdefg", np.uint8), 7)]))
    owner, feature, counts = toxicity.Extractor(chosen).count(Texts(pa.array(texts)))
    assert list(zip(owner.tolist(), counts.tolist())) == [(0, 1), (2, 2), (2, 1)]


def test_monotone_fit():
    votes, labels = np.array([0.1, 0.2, 0.3, 0.9, 1.0]), np.array([0, 1, 0, 1, 1.0])
    knots, values = toxicity.monotone(votes, labels)
    assert np.all(np.diff(knots) > 0) and np.all(np.diff(values) >= 0) and 0 < values[0] < values[-1] < 1
