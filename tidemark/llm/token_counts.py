"""Edit-aware token counts.

A document is kept as the leaves of a segment tree, one for each pre-token, with its letters and tokens; inner nodes
hold the sums. An edit finds the leaves it touches by descending on letters, takes in the leaves whose cut could
depend on it, cuts the text there anew until the cuts meet an old border again, counts the tokens of the new
pre-tokens only, and updates the sums on the way to the root.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import slices
from tidemark.llm.bpe import BYTE_LEVEL_PATTERN
from tidemark.llm.shipping import shipped

shipped(__name__)

CACHED = 1_000_000  # distinct pre-tokens kept per task; beyond it the memory starts anew
CONTEXT = 2  # letters behind a pre-token that can decide where it ends: the longest contraction has three


class Counter:
    """Tokens of pre-tokens; those already met are looked up. Strings of special tokens count as plain text."""

    def __init__(self, ranks: bytes):
        pairs = map(bytes.split, ranks.splitlines())
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encode = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}
        pattern = regex.compile(BYTE_LEVEL_PATTERN)
        self.cut, self.cut_from = pattern.findall, pattern.finditer

    def learn(self, words: Iterable[str]) -> None:
        if len(self.known) > CACHED:
            self.known = {}
        for word in set(words).difference(self.known):
            self.known[word] = len(self.encode(word))

    def count(self, words: Sequence[str]) -> list[int]:
        try:
            return [self.known[w] for w in words]
        except KeyError:
            self.learn(words)
            return [self.known[w] for w in words]


class Tree:
    """Sums of letters and tokens over the leaves. A leaf holds one pre-token, or several after an edit."""

    def __init__(self, letters: Sequence[int], tokens: Sequence[int]):
        self.leaves = len(letters)
        self.size = 1 << max(self.leaves - 1, 0).bit_length()
        self.sums = np.zeros((2, 2 * self.size), np.int64)
        if self.leaves:
            self.sums[:, self.size : self.size + self.leaves] = letters, tokens
        at = self.size
        while at > 1:
            half = at // 2
            self.sums[:, half:at] = self.sums[:, at : 2 * at].reshape(2, half, 2).sum(2)
            at = half

    @property
    def letters(self) -> int:
        return int(self.sums[0, 1])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf(self, place: int) -> tuple[int, int]:
        """(leaf that holds the letter at the place, first letter of the leaf); the end belongs to the leaf behind all."""
        if place >= self.letters:
            return self.leaves, self.letters
        node, first = 1, 0
        while node < self.size:
            node *= 2
            if place >= first + self.sums[0, node]:
                first += int(self.sums[0, node])
                node += 1
        return node - self.size, first

    def put(self, leaf: int, letters: int, tokens: int) -> None:
        node = leaf + self.size
        change = np.array([letters, tokens]) - self.sums[:, node]
        while node:
            self.sums[:, node] += change
            node //= 2


class Document:
    """A text with its tree, edited in place."""

    def __init__(self, text: str, counter: Counter, words: list[str] | None = None):
        self.text, self.counter, self.renewed = text, counter, 0
        words = counter.cut(text) if words is None else words
        self.tree = Tree([len(w) for w in words], counter.count(words))

    def edit(self, start: int, end: int, new: str) -> None:
        """Put `new` in the place of the letters start ... end - 1."""
        tree, old = self.tree, self.text
        text = self.text = old[:start] + new + old[end:]
        moved = len(new) - (end - start)
        if not tree.leaves:
            words = self.counter.cut(text)
            self.tree, self.renewed = Tree([len(w) for w in words], self.counter.count(words)), self.renewed + len(words)
            return
        # From the first leaf that ends within CONTEXT letters before the edit.
        leaf, first = tree.leaf(max(start - CONTEXT, 0))
        while leaf and leaf == tree.leaves:
            leaf -= 1
            first -= int(tree.sums[0, tree.size + leaf])
        last, border = leaf, first  # the leaf that starts at the border in the old text
        words, at = [], first
        for match in self.counter.cut_from(text, first):
            if at >= start + len(new):  # the text behind is the old one: does a leaf start here?
                while last < tree.leaves and border < at - moved:
                    border += int(tree.sums[0, tree.size + last])
                    last += 1
                if border == at - moved and border >= end:
                    break
            words.append(match.group())
            at = match.end()
        else:
            last = tree.leaves
        counts = self.counter.count(words)
        self.renewed += len(words)
        for other in range(leaf + 1, last):
            tree.put(other, 0, 0)
        if leaf == last:  # nothing old is taken: the first leaf keeps its own and takes the new ones in
            tree.put(leaf, int(tree.sums[0, tree.size + leaf]) + at - first, int(tree.sums[1, tree.size + leaf]) + sum(counts))
        else:
            tree.put(leaf, at - first, sum(counts))


def ordered(edits: Sequence[dict], length: int) -> list[tuple[int, int, str]]:
    """Edits by their start, within the text; one that starts inside another starts where that ends."""
    out, at = [], 0
    for e in sorted((e for e in edits if e), key=lambda e: (e["start"] or 0, e["end"] or 0)):
        start = min(max(e["start"] or 0, at), length)
        end = min(max(e["end"] or 0, start), length)
        out.append((start, end, e["text"] or ""))
        at = end
    return out


def matching(patterns: Sequence[tuple[str, str]]) -> Callable[[str], list[dict]]:
    """Edits that put a fixed text in the place of every match."""
    compiled = [(regex.compile(p), new) for p, new in patterns]

    def edits(text: str) -> list[dict]:
        return [{"start": m.start(), "end": m.end(), "text": new} for p, new in compiled for m in p.finditer(text)]

    return edits


def counted(
    docs: DataFrame, path: str, patterns: Sequence[tuple[str, str]] = (), edits_col: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_tokens, n_pretokens, n_edits, n_tokens_after, n_renewed) for every row of docs.

    path: the ranks of a byte-level BPE vocabulary, a line for each token in base64 and its rank; strings of special
    tokens count as plain text. Edits are those of
    `edits_col`, an array of (start, end, text) in letters of the text, and one for each match of (pattern, text) in
    `patterns`. They all refer to the text as given; a null field counts as 0 or empty, places outside of the text as
    its ends, and an edit that starts inside another one starts where that ends. n_renewed: pre-tokens cut and
    encoded for the edits. Null texts are empty; repeated rows are counted alike; other columns are not returned.
    """
    with open(path, "rb") as source:
        ranks = docs.sparkSession.sparkContext.broadcast(source.read())
    edits = F.col(edits_col) if edits_col else F.lit(None)
    given = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
        edits.cast("array<struct<start: int, end: int, text: string>>").alias("edits"),
    )
    kind = given.schema["id"].dataType.simpleString()
    names = ["n_tokens", "n_pretokens", "n_edits", "n_tokens_after", "n_renewed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, find = Counter(ranks.value), matching(patterns)
        for batch in batches:
            for piece in slices(batch, 1):
                rows = []
                texts = [t or "" for t in piece.column(1).to_pylist()]
                cuts = [counter.cut(t) for t in texts]
                counter.learn(chain.from_iterable(cuts))
                for text, words, edits in zip(texts, cuts, piece.column(2).to_pylist()):
                    document = Document(text, counter, words)
                    before, moved = document.tree.tokens, 0
                    leaves, todo = document.tree.leaves, ordered([*(edits or []), *find(text)], len(text))
                    for start, end, new in todo:
                        document.edit(start + moved, end + moved, new)
                        moved += len(new) - (end - start)
                    rows.append((before, leaves, len(todo), document.tree.tokens, document.renewed))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5
                yield pa.RecordBatch.from_arrays([piece.column(0), *columns], ["id", *names])

    result = given.mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} long" for n in names))
    return result.withColumnRenamed("id", id_col)
