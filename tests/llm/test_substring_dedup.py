import random
import re

import pytest

from tidemark.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """rows: (id, text) -> (words, removed, kept text), in the order of the rows."""
    first = {}
    cut = [WORD.findall(t or "") for _, t in rows]
    for (i, _), words in zip(rows, cut):
        if i is not None:
            for k in range(len(words) - window + 1):
                key = tuple(words[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), words in zip(rows, cut):
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), " ".join(kept)))
    return sorted(out, key=str)


def result(docs, window):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.dedup(docs, window).collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, with_clashes, seed):
    draw = random.Random(seed)
    window = draw.choice([4, 5, 8])
    passages = [" ".join(draw.choice("abcdef") + str(draw.randrange(30)) for _ in range(draw.choice([3, 6, 12, 30]))) for _ in range(6)]
    texts, ids = [], []
    for i in range(60):
        parts = [draw.choice([*passages, f"u{i} v{draw.randrange(99)}", "x x x x x x x x x x"]) for _ in range(draw.randrange(5))]
        texts.append(draw.choice([" ", "\n", "  \t"]).join(parts) if parts else draw.choice([None, "", " "]))
        ids.append(draw.choice([i, i, i, None, max(i - 1, 0)]))
    docs = with_clashes(texts, ids)
    assert result(docs, window) == brute(list(zip(ids, texts)), window)


def test_over_many_partitions_and_slices(spark, documents, monkeypatch):
    draw, window = random.Random(9), 6
    common = " ".join(f"c{i}" for i in range(40))
    texts = [" ".join([f"n{draw.randrange(5000)}" for _ in range(draw.randrange(30))] + ([common] if i % 3 else [])) for i in range(200)]
    monkeypatch.setattr(substring_dedup, "SLICE", 500)
    docs = documents(texts).repartition(7)
    assert result(docs, window) == brute(list(enumerate(texts)), window)


def test_spans_and_carried_columns(documents):
    from pyspark.sql import functions as F

    texts = ["a b c d e f", "x a  b c d e f y", "tail\n only"]
    docs = documents(texts).withColumn("lang", F.lit("en"))
    rows = {r.doc_id: r for r in substring_dedup.dedup(docs, 4, carry=["lang"]).collect()}
    assert [(s.start, s.end) for s in rows[1].spans] == [(1, 7)]
    assert (rows[1].text, rows[2].text, rows[0].rest.lang) == ("x y", "tail\n only", "en")


def test_empty_and_very_long(documents):
    assert substring_dedup.dedup(documents([])).collect() == []
    long = " ".join(str(i % 977) for i in range(200_000))
    rows = {r.doc_id: r for r in substring_dedup.dedup(documents([long, long, "short"])).collect()}
    assert (rows[0].n_removed, rows[1].n_removed, rows[1].kept) == (0, 200_000, "")


def test_words_that_hash_alike_are_no_repeat(documents):
    from .test_arrays import mirrored

    first, second = mirrored(1024)
    around = [f"w{i}" for i in range(30)]
    texts = [" ".join([*around, w, *reversed(around)]) for w in (first, second, first)]
    assert result(documents(texts), 50) == brute(list(enumerate(texts)), 50)
