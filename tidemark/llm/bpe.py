"""BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens of a batch are laid out as one symbol array. An index maps every mergeable pair to all
its positions there; ranks that occur are taken in ascending order from a heap, all positions of a rank are
merged, and the lists of the neighbouring pairs are updated. A pre-token is thus encoded once per task, however
often it occurs, and the ids of the texts are gathered from the encoded pre-tokens.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.shipping import shipped

shipped(__name__)

# Letters that all Unicode versions class alike: Latin, Greek, Cyrillic, general punctuation, kana, Han, Hangul and
# the older pictographs. A text with any other letter is cut into pre-tokens by the library's own steps.
SETTLED = "\u0000-\u0557\u1e00-\u1eff\u2000-\u2064\u20a0-\u20bf\u2100-\u214f\u2190-\u23f3\u2460-\u27bf\u3000-\u303f\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e\U0001f300-\U0001f64f\U0001f680-\U0001f6c5"
# Fixed value: the pattern of byte-level tokenizers that state none.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED = 400_000  # distinct pre-tokens kept per task; beyond it the memory starts anew


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What encoding needs of a tokenizer file; a few megabytes, whatever the corpus."""

    first: list[int]  # id of each byte inside a pre-token
    last: list[int]  # id of each byte at the end of one
    ranks: dict[int, int]  # left id << 32 | right id -> rank
    made: list[int]  # id that each rank makes
    tokens: list[str | None]  # text of each id
    special: dict[str, int]
    pattern: str
    lower: bool
    nfc: bool
    sides: list[int] = field(default_factory=list)  # left << 32 | right of each rank
    spec: str = ""  # the file itself

    @staticmethod
    def read(path: str) -> Vocabulary:
        """From a tokenizer file with a byte-level BPE model, a split pattern and word ends."""
        with open(path, encoding="utf-8") as source:
            text = source.read()
        spec = json.loads(text)
        model, ids = spec["model"], spec["model"]["vocab"]
        end = model.get("end_of_word_suffix") or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        letters = byte_letters()
        sides = [ids[a] << 32 | ids[b] for a, b in merges]
        made = [ids[a + b] for a, b in merges]
        known = {ids[x] for x in letters} | {ids[x + end] for x in letters}
        for pair, new in zip(sides, made):
            if pair >> 32 not in known or pair & 0xFFFFFFFF not in known:
                raise ValueError("a merge uses a token that no earlier merge makes")
            known.add(new)
        ranks: dict[int, int] = {}
        for rank, pair in enumerate(sides):
            ranks[pair] = rank
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens: list[str | None] = [None] * (max([*ids.values(), *added.values()]) + 1)
        for token, i in [*ids.items(), *added.items()]:
            tokens[i] = token
        steps = [spec["normalizer"], *((spec["normalizer"] or {}).get("normalizers") or [])]
        kinds = {s["type"] for s in steps if s}
        cutting = [spec["pre_tokenizer"], *(spec["pre_tokenizer"].get("pretokenizers") or [])]
        split = next((p["pattern"]["Regex"] for p in cutting if p["type"] == "Split"), BYTE_LEVEL_PATTERN)
        return Vocabulary(
            [ids[x] for x in letters], [ids[x + end] for x in letters], ranks, made, tokens, added,
            split, "Lowercase" in kinds, "NFC" in kinds, sides, text,
        )


def merge_all(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, start of each word among them and the end)."""
    first, last, ranks, made, sides = vocabulary.first, vocabulary.last, vocabulary.ranks, vocabulary.made, vocabulary.sides
    symbols: list[int] = []
    starts = [0]
    for word in words:
        symbols += [first[b] for b in word[:-1]]
        symbols.append(last[word[-1]])
        starts.append(len(symbols))
    n = len(symbols)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    for s in starts[1:]:
        following[s - 1] = -1
        if s < n:
            before[s] = -1
    places: dict[int, list[int]] = {}
    find = ranks.get
    for p, q in enumerate(following):
        if q >= 0 and (rank := find(symbols[p] << 32 | symbols[q])) is not None:
            if (at := places.get(rank)) is None:
                places[rank] = [p]
            else:
                at.append(p)
    active = list(places)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        left, right, new = sides[rank] >> 32, sides[rank] & 0xFFFFFFFF, made[rank]
        for p in sorted(places.pop(rank)):  # ascending, so overlapping occurrences merge from the left
            q = following[p]
            if symbols[p] != left or q < 0 or symbols[q] != right:
                continue  # one of the two was merged meanwhile
            symbols[p], symbols[q] = new, -1
            r = following[p] = following[q]
            if r >= 0:
                before[r] = p
                if (k := find(new << 32 | symbols[r])) is not None:
                    if (at := places.get(k)) is None:
                        places[k] = [p]
                        heapq.heappush(active, k)
                    else:
                        at.append(p)
            o = before[p]
            if o >= 0 and (k := find(symbols[o] << 32 | new)) is not None:
                if (at := places.get(k)) is None:
                    places[k] = [o]
                    heapq.heappush(active, k)
                else:
                    at.append(o)
    flat = np.array(symbols, np.int64)
    kept = flat >= 0
    total = np.concatenate([[0], np.cumsum(kept)])
    return flat[kept].astype(np.int32), total[np.array(starts)]


class Encoder:
    """Encodes batches of texts; pre-tokens already met are looked up."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.unsettled = regex.compile(f"[^{SETTLED}]").search
        self.library = None
        self.values = {letter: byte for byte, letter in enumerate(byte_letters())}
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.forget()

    def forget(self) -> None:
        special = self.vocabulary.special
        self.number = {name: i for i, name in enumerate(special)}
        self.ids = np.array(list(special.values()), np.int32)
        self.starts = np.arange(len(special) + 1)

    def pretokens(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.cut(text)
        found: list[str] = []
        for piece in self.special.split(text):
            if piece in self.vocabulary.special:
                found.append(piece)
            elif piece:
                found += self.cut(piece)
        return found

    def cut(self, text: str) -> list[str]:
        if text.isascii() or not self.unsettled(text):
            return self.find(self.normal(text))
        if self.library is None:
            self.library = Tokenizer.from_str(self.vocabulary.spec)
        normal = self.library.normalizer.normalize_str(text)
        pieces = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return [bytes(self.values[x] for x in w).decode("utf-8", "surrogatepass") for w in pieces]

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower() if self.vocabulary.lower else text
        if self.vocabulary.nfc:
            text = unicodedata.normalize("NFC", text)
        # Letter by letter: a capital sigma never becomes the final form.
        return text.replace("Σ", "σ").lower() if self.vocabulary.lower else text

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, start of each text among them and the end)."""
        if len(self.number) > CACHED:
            self.forget()
        number, fresh, rows, bounds = self.number, [], [], [0]
        for text in texts:
            words = self.pretokens(text)
            try:
                rows += [number[w] for w in words]
            except KeyError:
                del rows[bounds[-1] :]
                for w in words:
                    if w not in number:
                        number[w] = len(number)
                        fresh.append(w)
                rows += [number[w] for w in words]
            bounds.append(len(rows))
        if fresh:
            ids, starts = merge_all([w.encode("utf-8", "surrogatepass") for w in fresh], self.vocabulary)
            self.starts = np.concatenate([self.starts, starts[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        at = np.array(rows, np.int64)
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        gather = np.repeat(self.starts[at] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.ids[gather], ends[np.array(bounds)]


def _slices(table: pa.RecordBatch, column: int, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Pieces of about `limit` letters, of whole rows, so that memory does not follow the batch size."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(table.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < table.num_rows:
        base = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield table.slice(at, stop - at)
        at = stop


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row; a null or empty text has no ids, repeated rows stay repeated.

    Equals the tokenizers library's encoding without added special tokens; strings of special tokens in a text
    become their ids. Other columns are not returned, so their names cannot clash.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary.read(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**vocabulary.value))
        for batch in batches:
            for piece in _slices(batch, 1):
                ids, bounds = encoder.encode([x or "" for x in piece.column(1).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([piece.column(0), lists], ["id", "ids"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the texts of the tokens joined by one space; null or empty ids give an empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(vocabulary.value, pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                lists = pc.fill_null(piece.column(1), [])
                words = tokens.take(lists.flatten())
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), words), " ")
                yield pa.RecordBatch.from_arrays([piece.column(0), lists, texts.cast(pa.string())], ["id", "ids", "decoded"])

    given = encoded.select(F.col(id_col).alias("id"), "ids")
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
