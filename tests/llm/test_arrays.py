import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import arrays

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("chunk", [7, 50, 1 << 20])
def test_words_are_cut_and_hashed_as_the_pattern_cuts_them(monkeypatch, chunk):
    monkeypatch.setattr(arrays, "CHUNK", chunk)
    draw = random.Random(chunk)
    for _ in range(60):
        texts = [
            draw.choice([None, "".join(draw.choice("ab cÀé \n\tZ\u00a0\x1f") for _ in range(draw.choice([0, 1, 3, 20, 200])))])
            for _ in range(draw.choice([0, 1, 2, 9]))
        ]
        hashes, bounds = arrays.Words(lower=True).hashes(arrays.Texts(pa.array(texts, pa.string())))
        words = [WORD.findall(t or "") for t in texts]
        assert np.diff(bounds).tolist() == [len(w) for w in words]
        seen = {}
        for word, value in zip((re.sub("[A-Z]", lambda m: m[0].lower(), w) for ws in words for w in ws), hashes):
            assert seen.setdefault(word, value) == value
        assert len(set(seen.values())) == len(seen)


def test_runs_agree_where_the_words_agree():
    words = np.array([1, 2, 3, 1, 2, 3, 9], np.uint64)
    runs = arrays.Runs().hashes(words, 3)
    assert runs[0] == runs[3] and len(set(runs.tolist())) == 4
    assert len(arrays.Runs().hashes(words, 8)) == 0


def test_packed_columns_come_back():
    a, b = np.array([5, 1, 7], np.uint32), np.array([1.5, -2, 0])
    got = arrays.unpack(arrays.pack(a, b), np.uint32, np.float64)
    assert got[0].tolist() == a.tolist() and got[1].tolist() == b.tolist()
    assert [len(x) for x in arrays.unpack(arrays.pack(a[:0], b[:0]), np.uint32, np.float64)] == [0, 0]


def test_sliced_arrow_columns_keep_their_place():
    column = pa.array(["a b", None, "c", "d e f"]).slice(2)
    _, bounds = arrays.Words(lower=False).hashes(arrays.Texts(column))
    assert bounds.tolist() == [0, 1, 4]


def test_long_words_of_a_bad_build_keep_apart():
    first, second = mirrored(1024)
    for lower in (False, True):
        hashes = arrays.Words(lower).hashes(arrays.Texts(pa.array([first, second, first, "A" * 65, "a" * 65])))[0]
        assert hashes[0] == hashes[2] != hashes[1] and (hashes[3] == hashes[4]) == lower


def mirrored(n):
    """Two different words whose polynomial hashes modulo 2**64 are equal for any base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
