import random

import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, queries

ODD = [None, "", " ", "\n\t", "don't STOP", "ΑΣΣ Σ İ", "a<|endoftext|>b <|startof <|startoftext|>", "漢字 😀👍🏽", "x" * 5000, "\u0558 \ua7cb ܐ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.word_vocabulary())


def test_random_texts_equal_the_library(library):
    encoder, draw = bpe.Encoder(bpe.Vocabulary.read(queries.word_vocabulary())), random.Random(3)
    letters = list("abc THE the in re's 'S'll\t\n\u0085  \x1c\x1fÀéßΣσςıİǅ٣²½12あ漢字😀👍<|>") + ["<|endoftext|>", "e\u0301"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.choice([0, 1, 5, 50]))) for _ in range(500)]
    texts += ["".join(chr(draw.choice([draw.randrange(1, 0x3000), draw.randrange(0x1000, 0xD000)])) for _ in range(40)) for _ in range(200)]
    ids, bounds = encoder.encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_and_decode(with_clashes, library):
    path = queries.word_vocabulary()
    docs = with_clashes([*ODD, ODD[4]], [*range(len(ODD)), 4])
    rows = bpe.decode(bpe.encode(docs, path), path).collect()
    assert len(rows) == len(ODD) + 1
    for row in rows:
        want = library.encode(ODD[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == want
        assert row.decoded == library.decode(want, skip_special_tokens=False)


def test_a_text_survives_the_round_trip(documents, library):
    path, texts = queries.word_vocabulary(), ["the cat sat on the mat", "un été à paris, 1999!"]
    rows = bpe.decode(bpe.encode(documents(texts), path), path).orderBy("doc_id").collect()
    joined = [r.decoded.replace(" ", "").replace("</w>", " ").strip() for r in rows]
    assert joined[0] == texts[0]


def test_empty_table(documents):
    path = queries.word_vocabulary()
    assert bpe.decode(bpe.encode(documents([]), path), path).collect() == []


def test_memory_of_pretokens_is_renewed(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED", 3)
    encoder = bpe.Encoder(bpe.Vocabulary.read(queries.word_vocabulary()))
    for text in ("one two three four", "four five", "two three"):
        ids, _ = encoder.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
