import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import resampling
from tidemark.llm.arrays import Texts

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string"


def features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, percent=5, least=20, buckets=10_000):
    """Rows (doc_id, n_features, weight, score, rank)."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = [(i, *features(t)) for i, t in docs]
    s = Counter(bucket(f) for _, _, fs in own for f in fs)
    t = Counter(bucket(f) for _, text in target for f in features(text)[1])
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for i, words, fs in own:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        rows.append((i, words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    ranks = {}
    for place, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        ranks.setdefault(row, []).append(place)
    return [(i, n, w, sc, ranks[r].pop(0) if ranks.get(r := (i, words, n, w, sc)) else None) for i, words, n, w, sc in rows]


def drawn(n, seed):
    draw = random.Random(seed)
    word = lambda: draw.choice(["the", "The", "été", "naïve", "x1", "42", "日本", "longer" * draw.randrange(1, 90), "a"])
    rows = []
    for i in range(n):
        text = "".join(word() + draw.choice([" ", ", ", "--", "\x00", "_\n"]) for _ in range(draw.choice([0, 1, 2, 19, 20, 40, 200])))
        rows.append((draw.choice([i] * 9 + [None, 3]), draw.choice([text] * 9 + [None])))
    return rows + rows[:40]


def key(row):
    return tuple((v is None, v or 0) for v in row)


@pytest.mark.parametrize("percent", [5, 60])
def test_equals_the_plain_version(spark, percent):
    docs, target = drawn(400, 1), drawn(30, 2)
    got = resampling.resampled(spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'x' AS id", "'y' AS words", "1 AS n", "2 AS bucket", "3 AS rank"),
                               spark.createDataFrame(target, SCHEMA), percent=percent)
    rows = sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got.collect()), key=key)
    assert rows == sorted(plain(docs, target, percent), key=key)


def test_running_crcs_cancel():
    shifts, rng = resampling.Shifts(), np.random.default_rng(0)
    for n in (0, 1, 63, 64, 65, 4096, 5000, resampling.CHUNK, resampling.CHUNK + 77):
        data = rng.integers(0, 256, n).astype(np.uint8)
        places = np.unique(np.concatenate([rng.integers(0, n + 1, 40), [0, n]]))
        prefix = shifts.prefixes(data, places)
        got = prefix[1:] ^ resampling.ONES ^ shifts.shifted(prefix[:-1] ^ resampling.ONES, np.diff(places))
        assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(places[:-1], places[1:])]


def test_buckets_of_odd_texts():
    texts = ["Hello, wörld A1 b", None, "", "x", "a b", "ab", "cd", "É é ÀB. " * 3, "w" * 300 + " " + "v" * 70_000 + " end", "  ", "z" * 2_000_000]
    found = [b for _, own, _ in resampling.Features(10_000, 3).located(Texts(pa.array(texts))) for b in own.tolist()]
    assert sorted(found) == sorted(zlib.crc32(f.encode()) % 10_000 for t in texts for f in features(t)[1])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    docs = drawn(30, 5)
    assert resampling.resampled(empty, empty).collect() == []
    got = resampling.resampled(spark.createDataFrame(docs, SCHEMA), empty)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got.collect()), key=key) == sorted(plain(docs, []), key=key)


def test_a_row_repeated_very_often_is_ranked_throughout(spark):
    docs = [(1, "w " * 25)] * 9000 + [(2, "v " * 25)] * 1000
    got = resampling.resampled(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(docs[-1:], SCHEMA), percent=50)
    assert sorted(r.rank for r in got.collect() if r.rank) == list(range(1, 5001))
