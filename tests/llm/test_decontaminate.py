import random

import pyarrow as pa
import pytest

from tidemark.llm import decontaminate
from tidemark.llm.arrays import Texts


def edits(a, b, anywhere=False):
    """Edit distance of a and b, or of a and its nearest part of b."""
    row = [0] * (len(b) + 1) if anywhere else list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row) if anywhere else row[-1]


def test_regions_equal_brute_force():
    draw = random.Random(5)
    text = lambda n: "".join(draw.choice("abcdefgh éß ") for _ in range(n))

    def changed(s, k):
        s = list(s)
        for _ in range(k):
            p, what = draw.randrange(len(s)), draw.choice("sid")
            s[p : p + (what != "i")] = [] if what == "d" else [draw.choice("abcdefgh ")]
        return "".join(s)

    seen = 0
    for _ in range(25):
        items = [text(draw.choice([3, 9, 20, 40, 90])) for _ in range(4)]
        docs = []
        for _ in range(4):
            doc = text(draw.choice([0, 10, 80]))
            for _ in range(draw.choice([0, 1, 2])):
                item = draw.choice(items)
                doc += changed(item, draw.randint(0, len(item) // 9)) + text(draw.choice([0, 5, 40]))
            docs.append(doc)
        own = decontaminate.Items(items, 0.1)
        best = {}
        for t, i, start, end, cost in decontaminate.leaks(own, *decontaminate.Letters().of(Texts(pa.array(docs, pa.string())))):
            assert edits(items[i], docs[t][start:end]) == cost
            best[t, i] = min(cost, best.get((t, i), 99))
        for t, doc in enumerate(docs):
            for i, item in enumerate(items):
                least = edits(item, doc, anywhere=True)
                seen += least <= own.budget[i]
                assert best.get((t, i)) == (least if least <= own.budget[i] else None)
    assert seen > 40


def test_find(spark, with_clashes):
    item = "What is the capital of the country whose flag is blue and white?"
    texts = [None, "", "nothing of the kind", f"Q: {item} A: x", f"{item.upper()}\n{item.replace('blue', 'blu')}", "é " * 30000 + item]
    docs = with_clashes([*texts, texts[3]], [*range(len(texts)), 3])
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "zq")], "item_id long, text string")
    rows = sorted((r.doc_id, r.item_id, r.start, r.end, r.edits) for r in decontaminate.find(docs, bench).collect())
    n = len(item)
    assert rows == [(3, 7, 3, 3 + n, 0)] * 2 + [(4, 7, 0, n, 0), (4, 7, n + 1, 2 * n, 1), (5, 7, 60000, 60000 + n, 0)]


def test_items_in_groups_and_empty_tables(spark, documents):
    items = [f"item number {i} with enough letters {i * 7919}" for i in range(20)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = documents([f"a {x} b" for x in items])
    found = decontaminate.find(docs, bench, rate=0.0, item_bytes=200)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(i, i) for i in range(20)]
    assert decontaminate.find(documents([]), bench).collect() == []
    assert decontaminate.find(docs, bench.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["int", "string", "decimal(10,0)"])
def test_ids_of_any_type(spark, documents, kind):
    item = "an item with enough letters to be found anywhere"
    bench = spark.createDataFrame([(3, item), (None, "quite another question, found nowhere else")], "item_id int, text string").selectExpr(f"CAST(item_id AS {kind}) AS item_id", "text")
    docs = documents([f"a {item} b"]).selectExpr(f"CAST(doc_id AS {kind}) AS doc_id", "text")
    found = decontaminate.find(docs, bench)
    assert [(str(r.doc_id), str(r.item_id)) for r in found.collect()] == [("0", "3")]
    assert dict(found.dtypes)["item_id"] == kind
