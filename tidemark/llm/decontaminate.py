"""Benchmark decontamination by the q-gram lemma.

An occurrence of an item of m letters with at most k edits shares at least m - q + 1 - k q of its q-grams, all of
them on k + 1 neighbouring diagonals (place in the text less place in the item). Shared q-grams are counted in
bands of 2 (k + 1) diagonals that overlap by half, so one band holds them all. Regions that reach the bound are
verified by a banded alignment, many regions of an item at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.arrays import Texts, code_points, constants, slices
from tidemark.llm.shipping import shipped

shipped(__name__)

Q = 8
RATE = 0.1  # edits for each letter of an item
ITEM_BYTES = 8 << 20  # items are shipped in groups of about this size, however many there are
FILTER_BITS = 22
REGIONS = 128  # regions aligned at a time, of similar length


def folding() -> np.ndarray:
    """For each 16-bit letter, its small form if that is one letter, and a space for any white space."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        letter = chr(i)
        if letter.isspace():
            table[i] = 32
        elif len(letter.lower()) == 1 and ord(letter.lower()) < 1 << 16:
            table[i] = ord(letter.lower())
    return table


class Letters:
    """Folded letters of texts, one for each letter, so places stay the same."""

    def __init__(self) -> None:
        self.table = folding()

    def fold(self, points: np.ndarray) -> np.ndarray:
        return np.where(points < 1 << 16, self.table[np.minimum(points, (1 << 16) - 1)], points)

    def of(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(letters of all texts, first letter of each text and the end)."""
        first, end = int(texts.offsets[0]), int(texts.offsets[-1])
        data = texts.data[first:end]
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return self.fold(code_points(data.tobytes().decode("utf-8"))), heads[texts.offsets - first]


def grams(letters: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the q letters from each place on; q is a power of two."""
    keys, width = letters.astype(np.uint64), 1
    for factor in constants(77, 8)[: q.bit_length() - 1]:
        if len(keys) <= width:
            return np.empty(0, np.uint64)
        keys = keys[:-width] * (factor | np.uint64(1)) + keys[width:]
        keys = keys ^ (keys >> np.uint64(29))
        width *= 2
    return keys * np.uint64(0x9E3779B97F4A7C15)


class Items:
    """The q-grams of a group of items with their places, edit budgets and bounds."""

    def __init__(self, texts: list[str], rate: float, q: int = Q):
        fold = Letters().fold
        self.letters = [fold(code_points(t)) for t in texts]
        sizes = np.array([len(x) for x in self.letters], np.int64)
        self.q, self.sizes = q, sizes
        self.budget = np.maximum(np.minimum((rate * sizes).astype(np.int64), (sizes - q) // q), 0)
        self.bound = np.maximum(sizes - q + 1 - self.budget * q, 1)
        keys = [grams(x, q) for x in self.letters]
        flat = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        place = np.concatenate([np.arange(len(k)) for k in keys]) if keys else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(starts, len(flat))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True
        self.short = [i for i, n in enumerate(sizes) if 0 < n < q]

    def shared(self, letters: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, diagonal, place in the item) of every shared q-gram in pairs of a text and an item that share enough."""
        keys = grams(letters, self.q)
        hits = np.flatnonzero(self.filter[keys >> np.uint64(64 - FILTER_BITS)])
        at = np.searchsorted(self.keys, keys[hits])
        at[at == len(self.keys)] = 0
        right = self.keys[at] == keys[hits] if len(self.keys) else np.zeros(0, bool)
        hits, at = hits[right], at[right]
        owner = np.searchsorted(bounds, hits, side="right") - 1
        inside = hits + self.q <= bounds[owner + 1]
        hits, at, owner = hits[inside], at[inside], owner[inside]
        many = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(many)
        posting = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - many), many)
        item = self.item[posting]
        cell = np.repeat(owner, many) * len(self.sizes) + item
        counts = np.bincount(cell, minlength=(len(bounds) - 1) * len(self.sizes))
        enough = np.flatnonzero(counts[cell] >= self.bound[item])
        source = np.repeat(hits, many)[enough]
        place = self.place[posting[enough]]
        return np.repeat(owner, many)[enough], item[enough], source - place, place

    def regions(self, letters: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, first diagonal) of the bands that reach the bound; diagonals count from the first letter of all."""
        text, item, diagonal, place = self.shared(letters, bounds)
        step = self.budget[item] + 1
        shifted = diagonal - bounds[text] + self.sizes[item]  # from 1 on
        band = shifted // step
        wide = int(band.max()) + 2 if len(band) else 1
        cell = (text * len(self.sizes) + item) * wide
        # A place of the item counts once in a band, however often the text repeats its q-gram there.
        span = int(self.sizes.max()) + 1 if len(self.sizes) else 1
        both = np.concatenate([(cell + band) * span + place, (cell + np.maximum(band - 1, 0)) * span + place])
        keys, counts = np.unique(np.unique(both) // span, return_counts=True)
        item, band = keys // wide % max(len(self.sizes), 1), keys % wide
        text = keys // wide // max(len(self.sizes), 1)
        full = counts >= self.bound[item]
        text, item, band = text[full], item[full], band[full]
        return text, item, band * (self.budget[item] + 1) - self.sizes[item] + bounds[text]


def aligned(
    item: np.ndarray, sizes: np.ndarray, letters: np.ndarray, low: np.ndarray, width: int, first: np.ndarray, end: np.ndarray,
    free: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Edits of the best alignment of each whole item in its region, and where it ends in the letters.

    item: one row of letters for each region, `sizes` of them, descending. A region allows the diagonals low ... low +
    width - 1 and the letters first ... end - 1. The alignment may start on any diagonal, or only on that of `free`.
    """
    far = np.int32(1 << 20)
    drift = np.arange(width, dtype=np.int32)
    place = low[:, None] + drift  # the letter that the diagonal step reads
    first, end = first[:, None], end[:, None]
    costs = np.where((place >= first) & (place <= end), np.int32(0), far)
    if free is not None:
        costs = np.where(place == free[:, None], costs, far)
        costs = np.minimum.accumulate(costs - drift, axis=1) + drift
    out, stop = np.zeros(len(low), np.int32), np.zeros(len(low), np.int64)
    active, top = len(low), len(letters) - 1
    for i in range(int(sizes[0]) if len(sizes) else 0):
        done = int(np.searchsorted(-sizes, -i, side="left"))  # rows from here on have no letter i
        if done < active:
            _finish(costs, low, sizes, out, stop, done, active)
            active, costs, place, first, end = done, costs[:done], place[:done], first[:done], end[:done]
        known = (place >= first) & (place < end)
        same = letters[np.clip(place, 0, top)] == item[:active, i : i + 1]
        step = np.where(known, costs + ~same, far)
        skip = np.full_like(costs, far)
        skip[:, :-1] = costs[:, 1:] + 1
        costs = np.minimum(step, skip)
        place = place + 1
        outside = (place < first) | (place > end)
        costs[outside] = far
        costs = np.minimum(np.minimum.accumulate(costs - drift, axis=1) + drift, far)
        costs[outside] = far
    _finish(costs, low, sizes, out, stop, 0, active)
    return out, stop


def _finish(costs: np.ndarray, low: np.ndarray, sizes: np.ndarray, out: np.ndarray, stop: np.ndarray, begin: int, end: int) -> None:
    best = np.argmin(costs[begin:end], axis=1)
    out[begin:end] = costs[begin:end][np.arange(end - begin), best]
    stop[begin:end] = low[begin:end] + best + sizes[begin:end]


def leaks(items: Items, letters: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of all verified regions, places counted in the text's letters."""
    found = set()
    texts, names, diagonals = items.regions(letters, bounds)
    order = np.argsort(-items.sizes[names], kind="stable") if len(names) else names
    texts, names, diagonals = texts[order], names[order], diagonals[order]
    total = len(letters)
    for at in range(0, len(names), REGIONS):
        own = slice(at, at + REGIONS)
        text, name = texts[own], names[own]
        sizes, budget = items.sizes[name], items.budget[name]
        most, k = int(sizes[0]), int(budget.max())
        rows = np.zeros((len(name), most), np.uint32)
        mirrored = np.zeros((len(name), most), np.uint32)
        for i in np.unique(name):
            rows[name == i, : items.sizes[i]] = items.letters[i]
            mirrored[name == i, : items.sizes[i]] = items.letters[i][::-1]
        first, end = bounds[text], bounds[text + 1]
        edits, stop = aligned(rows, sizes, letters, diagonals[own] - k, 2 * (k + 1) + 2 * k, first, end)
        good = np.flatnonzero(edits <= budget)
        if not len(good):
            continue
        text, name, sizes, first, end, edits, stop = (x[good] for x in (text, name, sizes, first, end, edits, stop))
        # The start: the same alignment from the end backwards, in the mirrored letters.
        _, back = aligned(mirrored[good], sizes, letters[::-1], total - stop - k, 2 * k + 1, total - end, total - first, free=total - stop)
        for t, i, s, e, cost, base in zip(text, name, total - back, stop, edits, first):
            found.add((int(t), int(i), int(s - base), int(e - base), int(cost)))
    for i in items.short:
        m = len(items.letters[i])
        same = np.ones(max(len(letters) - m + 1, 0), bool)
        for j, letter in enumerate(items.letters[i]):
            same &= letters[j : len(letters) - m + 1 + j] == letter
        places = np.flatnonzero(same)
        owner = np.searchsorted(bounds, places, side="right") - 1
        for text, s in zip(owner, places):
            if s + m <= bounds[text + 1]:
                found.add((int(text), i, int(s - bounds[text]), int(s - bounds[text]) + m, 0))
    return sorted(found)


def find(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """(id, item_id, start, end, edits): every region of a document that holds a whole item with at most rate x length edits.

    Letters are compared without case, any white space as a space. start and end count letters of the text. Short
    items have a smaller budget (the lemma needs a q-gram that no edit touches); items under q letters are found
    without edits; null and empty items and texts have no regions. Repeated documents and repeated items give
    repeated rows; a region seen in two bands is one row. The documents are not shuffled; items are shipped in
    groups of about `item_bytes`, one pass over the documents for each group. Other columns are not returned.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = benchmark.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("item"))
    texts = texts.where("length(item) > 0")
    size = texts.agg(F.sum(F.octet_length("item"))).first()[0] or 0
    groups = max(1, -(-size // item_bytes))
    kinds = given.schema["id"].dataType.simpleString(), texts.schema["item_id"].dataType.simpleString()
    name_type = to_arrow_type(texts.schema["item_id"].dataType)
    result = None
    for group in range(groups):
        own = texts.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == group).orderBy("item_id", "item").collect()
        shared = docs.sparkSession.sparkContext.broadcast(([r["item_id"] for r in own], [r["item"] for r in own]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, items = shared.value[0], Items(shared.value[1], rate)
            names = pa.array(names, name_type)
            letters_of = Letters()
            for batch in batches:
                for piece in slices(batch, 1, 2 << 20):
                    found = leaks(items, *letters_of.of(Texts(piece.column(1)))) if len(names) else []
                    columns = list(zip(*found)) if found else [[]] * 5
                    rows, which = (pa.array(c, pa.int64()) for c in columns[:2])
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(rows), names.take(which), *(pa.array(c, pa.int32()) for c in columns[2:])],
                        ["id", "item_id", "start", "end", "edits"],
                    )

        part = given.mapInArrow(run, f"id {kinds[0]}, item_id {kinds[1]}, start int, end int, edits int")
        result = part if result is None else result.unionByName(part)
    return result.withColumnRenamed("id", id_col)
