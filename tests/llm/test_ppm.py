import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ppm
from tidemark.llm.arrays import Texts, Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def symbols(text):
    return [x for w in words_of(text) for x in [*w.encode(), 32]] + [10]


class Trie:
    """Contexts as tuples of bytes, with escapes and exclusion sets made explicit."""

    def __init__(self, texts):
        self.nodes = [defaultdict(Counter) for _ in range(ppm.DEPTH + 1)]
        for text in texts:
            context = (32,) * ppm.DEPTH
            for x in symbols(text):
                self.nodes[ppm.DEPTH][context][x] += 1
                context = (*context, x)[1:]
        for k in range(ppm.DEPTH, 0, -1):  # a shorter context counts a byte once for each longer one
            for context, seen in self.nodes[k].items():
                self.nodes[k - 1][context[1:]].update(list(seen))
        self.taken = []
        for nodes in self.nodes:
            counts = Counter(n for seen in nodes.values() for n in seen.values())
            n = [max(counts[i], 1) for i in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1])
            free = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
            self.taken.append([min(max(d, ppm.MARGIN), i + 1 - ppm.MARGIN) for i, d in enumerate(free)])

    def chances(self, context, k=ppm.DEPTH):
        """Probability of every symbol after the context."""
        if k < 0:
            return dict.fromkeys(ALPHABET, 1 / ppm.SYMBOLS)
        lower = self.chances(context[1:], k - 1)
        seen = self.nodes[k].get(context)
        if not seen:
            return lower
        total = sum(seen.values())
        off = {x: self.taken[k][min(n, 3) - 1] for x, n in seen.items()}
        free, inherited = sum(off.values()) / total, sum(lower[x] for x in seen)
        escape = free * (1 - inherited)
        out = {x: (n - off[x]) / total + free * lower[x] for x, n in seen.items()}
        for x in lower.keys() - out.keys():  # the seen ones are excluded from what the shorter context predicts
            out[x] = escape * lower[x] / (1 - inherited)
        return out

    def score(self, text):
        context, out = (32,) * ppm.DEPTH, 0.0
        for x in symbols(text):
            out += math.log10(self.chances(context)[x])
            context = (*context, x)[1:]
        return out


ALPHABET = [x for x in range(256) if x not in (9, 11, 12, 13)]


def corpus(seed):
    draw = random.Random(seed)
    pools = [["the", "of", "cat", "Running", "naïve", "a" * 40, "x.y", "\x00"], ["der", "die", "und", "Straße", "gehen", "漢字"]]
    texts = [None, "", "  ", "the", "THE the unseen", "unseen straßen " * 30]
    for _ in range(40):
        pool = draw.choice(pools)
        texts.append(draw.choice([" ", "\n"]).join(draw.choice(pool) + draw.choice(["", "", "s", "ing"]) for _ in range(draw.randrange(30))))
    return texts


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, with_clashes, seed):
    texts = corpus(seed)
    trains = [t for i, t in enumerate(texts) if i % 3 != 1]
    tokens = Counter(w for t in trains for w in [*words_of(t), None])
    total, distinct, trie = sum(tokens.values()), len(tokens), Trie(trains)
    found = ppm.scored(with_clashes(texts), F.col("doc_id") % 3 != 1).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(texts)))
    for r in found:
        own = [*words_of(texts[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(tokens[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((tokens[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own), rel=1e-9)
        assert r.score == pytest.approx(trie.score(texts[r.doc_id]), rel=1e-5)


def test_all_bytes_after_a_context_sum_to_one():
    trie = Trie(corpus(2))
    for text in ("", "the", "the ca", "die unge", "漢"):
        context = ((32,) * ppm.DEPTH + tuple(text.encode()))[-ppm.DEPTH :]
        assert sum(trie.chances(context).values()) == pytest.approx(1)
    assert len(ALPHABET) == ppm.SYMBOLS


def test_runs_hold_the_bytes_before():
    texts = ["Ab c", None, "é"]
    codes, sizes, _, _ = ppm.predicted(Texts(pa.array(texts, pa.string())), Words(True))
    assert sizes.tolist() == [len(symbols(t)) for t in texts]
    want = []
    for text in texts:
        stream = [32] * ppm.DEPTH + symbols(text)
        want += [bytes([0, *stream[i - ppm.DEPTH : i][::-1], stream[i]]) for i in range(ppm.DEPTH, len(stream))]
    assert [int(c).to_bytes(8, "big") for c in codes] == want


def test_order_of_words_matters(documents):
    draw = random.Random(5)
    line = "one two three four five six seven eight nine ten".split()
    texts = [" ".join(line)] * 20 + [" ".join(draw.sample(line, len(line))) for _ in range(5)]
    docs = documents(texts)
    by_id = {r.doc_id: r for r in ppm.scored(docs, F.col("doc_id") < 19).collect()}
    assert all(by_id[19].score > by_id[i].score + 3 for i in range(20, 25) if texts[i] != texts[0])
    assert all(by_id[19].base_score == pytest.approx(by_id[i].base_score) for i in range(20, 25))


def test_repeated_null_and_untrained_rows(documents):
    docs = documents(["a b", "a b", "c", "d"], [1, 1, None, 2])
    rows = sorted((r.doc_id, r.n_known, r.train_tokens, r.score) for r in ppm.scored(docs, F.lit(True)).collect())
    assert [r[:3] for r in rows] == [(1, 3, 10), (1, 3, 10), (2, 2, 10)] and rows[0] == rows[1]
    untrained = ppm.scored(docs, F.lit(None).cast("boolean")).collect()
    assert {(r.n_known, r.train_tokens) for r in untrained} == {(0, 0)}
    assert sorted(r.score for r in untrained) == pytest.approx([-math.log10(ppm.SYMBOLS) * n for n in (5, 5, 3)], rel=1e-5)
    assert ppm.scored(documents([]), F.lit(True)).collect() == []


def test_very_long_texts_and_words(documents):
    texts = ["ab" * 300_000, "word " * 100_000, "ab word"]
    by_id = {r.doc_id: r for r in ppm.scored(documents(texts), F.col("doc_id") < 2).collect()}
    assert (by_id[0].n_tokens, by_id[1].n_tokens, by_id[2].n_known) == (2, 100_001, 2)
    assert all(math.isfinite(r.score) for r in by_id.values())


def test_parts_added_up_equal_the_whole(monkeypatch):
    monkeypatch.setattr(ppm, "PENDING", 10)
    draw = np.random.default_rng(0)
    parts = [(np.unique(draw.integers(0, 99, 30).astype(np.uint64)), None) for _ in range(20)]
    parts = [(k, draw.integers(0, 9, len(k))) for k, _ in parts]
    keys, counts = ppm.added(iter(parts))
    want = Counter()
    for k, c in parts:
        for x, n in zip(k.tolist(), c.tolist()):
            want[x] += n
    assert dict(zip(keys.tolist(), counts.tolist())) == dict(want) and keys.tolist() == sorted(want)


def test_pieces_and_slices_do_not_change_scores(documents, monkeypatch):
    docs = documents(corpus(3))
    score = lambda: sorted((r.doc_id, r.n_known, round(r.score, 4)) for r in ppm.scored(docs, F.col("doc_id") % 3 != 1).collect())
    whole = score()
    for piece, size in ((100, 1 << 20), (50, 300), (1, 1)):
        monkeypatch.setattr(ppm, "PIECE", piece)
        monkeypatch.setattr(ppm, "SLICE", size)
        assert score() == whole
