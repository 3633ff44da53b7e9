import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import queries, token_counts


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_random_edits_equal_a_full_count(library):
    counter = token_counts.Counter(open(queries.byte_ranks(), "rb").read())
    draw = random.Random(2)
    letters = list("ab 's're'lld \n\t 12.#!éß漢  ") + ["'re", "'ll", "  ", "\n\n", "hello", " the"]
    text = lambda n: "".join(draw.choice(letters) for _ in range(n))
    for _ in range(800):
        document = token_counts.Document(text(draw.choice([0, 1, 3, 20, 100])), counter)
        for _ in range(draw.choice([0, 1, 3, 8])):
            start = draw.randint(0, len(document.text))
            end = min(len(document.text), start + draw.choice([0, 0, 1, 2, 5, 30]))
            document.edit(start, end, text(draw.choice([0, 0, 1, 2, 10])))
            assert document.tree.tokens == library(document.text)
            assert document.tree.letters == len(document.text)


def test_only_the_surroundings_are_encoded_again():
    counter = token_counts.Counter(open(queries.byte_ranks(), "rb").read())
    document = token_counts.Document("some words " * 20_000, counter)
    document.edit(100_000, 100_004, "other")
    assert document.renewed < 10


def test_counted(spark, documents, library):
    secret = "AKIA" + "A1" * 8
    texts = [None, "", "mail me: a.b@c.example.org now", f"{secret}{secret} ### x", "plain <|endoftext|>", "é" * 50_000 + " q@w.io"]
    after = [r if r else "" for r in texts]
    after[2], after[3], after[5] = "mail me: <EMAIL> now", "<KEY><KEY>   x", "é" * 50_000 + " <EMAIL>"
    docs = documents([*texts, texts[2]], [*range(len(texts)), 2])
    rows = token_counts.counted(docs, queries.byte_ranks(), queries.REDACTIONS).collect()
    assert len(rows) == 7
    for r in rows:
        assert (r.n_tokens, r.n_tokens_after) == (library(texts[r.doc_id] or ""), library(after[r.doc_id]))


def test_edits_of_a_column(spark, library):
    schema = "doc_id long, text string, edits array<struct<start: int, end: int, text: string>>, id string"
    rows = [
        (0, "hello world", [(6, 11, "there"), (0, 5, "HI")], "x"),
        (1, "hello world", [(0, 5, "a"), (3, 8, "b"), (90, 99, "!"), (None, None, None)], "x"),
        (2, "hello", None, "x"),
        (3, None, [(0, 0, "new text")], "x"),
    ]
    got = token_counts.counted(spark.createDataFrame(rows, schema), queries.byte_ranks(), edits_col="edits")
    want = {0: "HI there", 1: "abrld!", 2: "hello", 3: "new text"}
    assert {r.doc_id: r.n_tokens_after for r in got.collect()} == {i: library(t) for i, t in want.items()}


def test_empty_table(documents):
    assert token_counts.counted(documents([]), queries.byte_ranks()).collect() == []
