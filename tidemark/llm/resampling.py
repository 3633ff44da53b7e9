"""Importance resampling towards a target distribution, with hashed n-gram features from prefix CRCs.

A document's features are its runs of one to three words, each in the bucket that its CRC-32 names. The logarithm of
target share over corpus share, smoothed, is the gain of a bucket; the gains of all features are the weight of a
document, and a Gumbel draw on top makes the highest scores a sample without replacement.

Words are joined by one space and scanned once, storing the running CRC at every border of a word. A CRC is linear
over GF(2): the prefix before an n-gram, shifted by the n-gram's length, cancels what that prefix left in the
prefix behind it. So the CRC of any n-gram costs one table shift, however long its words are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import Texts, slices
from tidemark.llm.repeats import written_out
from tidemark.llm.shipping import shipped
from tidemark.llm.storage import stored
from tidemark.operators.ranks import running_total

shipped(__name__)

CRC32 = 0xEDB88320  # the polynomial of CRC-32, lowest power first
ONES = np.uint32(0xFFFFFFFF)
SHORT = 256  # shifts up to this many bytes have a table each, longer ones a table for each power of two
ROW = 64  # bytes that the scan handles side by side
CHUNK = 1 << 20  # bytes whose running CRCs are held at a time


class Shifts:
    """Running CRCs, and shifts of them by zero bytes as table look-ups."""

    def __init__(self):
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(CRC32), table >> np.uint32(1))
        self.table = table
        step = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
        steps = []
        for _ in range(SHORT):
            steps.append(step)
            step = table[step & np.uint32(255)] ^ (step >> np.uint32(8))
        self.short = np.stack(steps).ravel()
        self.doubled = [step]  # by 256, 512, ... bytes

    @staticmethod
    def through(table: np.ndarray, states: np.ndarray) -> np.ndarray:
        """States through one shift: table[byte place, byte]."""
        out = table[0][states & np.uint32(255)]
        for place in (1, 2, 3):
            out = out ^ table[place][(states >> np.uint32(8 * place)) & np.uint32(255)]
        return out

    def by(self, n: int) -> np.ndarray:
        """The table of the shift by one length."""
        table = self.short.reshape(SHORT, 4, 256)[n % SHORT]
        for bit, power in enumerate(self.powers(n // SHORT)):
            if n // SHORT >> bit & 1:
                table = self.through(power, table)
        return table

    def powers(self, n: int) -> list[np.ndarray]:
        while len(self.doubled) < n.bit_length():
            self.doubled.append(self.through(self.doubled[-1], self.doubled[-1]))
        return self.doubled[: n.bit_length()]

    def shifted(self, states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each state followed by its own number of zero bytes."""
        base = (lengths % SHORT) * 1024
        out = self.short[base + (states & np.uint32(255))]
        for place in (1, 2, 3):
            out = out ^ self.short[base + (place * 256) + ((states >> np.uint32(8 * place)) & np.uint32(255))]
        high = lengths // SHORT
        for bit, power in enumerate(self.powers(int(high.max(initial=0)))):
            at = np.flatnonzero(high >> bit & 1)
            out[at] = self.through(power, out[at])
        return out

    def prefixes(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Running CRC, from zero, of the bytes before each of the ascending places."""
        out, carry = np.empty(len(places), np.uint32), 0
        for at in range(0, max(len(data), 1), CHUNK):
            piece = data[at : at + CHUNK]
            last = at + CHUNK >= len(data)
            own = slice(np.searchsorted(places, at), len(places) if last else np.searchsorted(places, at + CHUNK))
            scanned, carry = self._scan(piece, carry)
            inside = places[own] - at
            row, column = inside // ROW, inside % ROW
            states = self.shifted(scanned[1][row], column)
            out[own] = states ^ np.where(column > 0, scanned[0][np.maximum(column - 1, 0), np.minimum(row, scanned[0].shape[1] - 1)], np.uint32(0))
        return out

    def _scan(self, piece: np.ndarray, carry: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
        """(running CRCs within rows of the piece, CRC before each row and after the last), CRC after the piece."""
        rows = max(-(-len(piece) // ROW), 1)
        padded = np.zeros(rows * ROW, np.uint8)
        padded[: len(piece)] = piece
        columns = np.ascontiguousarray(padded.reshape(rows, ROW).T)
        within, state = np.empty((ROW, rows), np.uint32), np.zeros(rows, np.uint32)
        for i in range(ROW):
            state = self.table[(state ^ columns[i]) & np.uint32(255)] ^ (state >> np.uint32(8))
            within[i] = state
        # The rows in turn, in groups that are scanned side by side as well.
        groups = -(-rows // ROW)
        ends = np.zeros(groups * ROW, np.uint32)
        ends[:rows] = within[-1]
        ends = ends.reshape(groups, ROW)
        one, many = self.by(ROW), self.by(ROW * ROW).tolist()
        local, state = np.zeros((groups, ROW + 1), np.uint32), np.zeros(groups, np.uint32)
        for i in range(ROW):
            state = self.through(one, state) ^ ends[:, i]
            local[:, i + 1] = state
        before = np.empty(groups, np.uint32)
        for g, end in enumerate(local[:, ROW].tolist()):
            before[g] = carry
            carry = many[0][carry & 255] ^ many[1][carry >> 8 & 255] ^ many[2][carry >> 16 & 255] ^ many[3][carry >> 24] ^ end
        starts = np.empty((groups, ROW + 1), np.uint32)
        for i in range(ROW + 1):
            starts[:, i] = local[:, i] ^ self.through(self.by(ROW * i), before)
        flat = np.append(starts[:, :ROW].ravel(), starts[-1, ROW])
        size = len(piece)
        after = flat[size // ROW]
        if size % ROW:
            after = self.through(self.by(size % ROW), after) ^ within[size % ROW - 1, size // ROW]
        return (within, flat), int(after)


class Features:
    """The buckets of all n-grams of a slice of texts."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest, self.shifts = buckets, longest, Shifts()
        self.plain = np.full(256, 0x20, np.uint8)
        for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
            self.plain[first : last + 1] = np.arange(first, last + 1)
        self.plain[0x41:0x5B] = np.arange(0x61, 0x7B)

    def words(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words joined by one space, start of each word there, its end, index of the first word of each text and the end)."""
        begin = int(texts.offsets[0])
        data = self.plain[texts.data[begin : int(texts.offsets[-1])]]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = data != 0x20
        first, final = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        borders = texts.offsets - begin
        touching = borders[inside[borders] & inside[borders + 1]]
        first[touching], final[touching] = True, True
        starts, ends = np.flatnonzero(first), np.flatnonzero(final)
        lengths = ends - starts
        ordinal = np.arange(len(starts))
        placed = np.concatenate([[0], np.cumsum(lengths)[:-1]])[: len(starts)] + ordinal
        joined = np.full(int(lengths.sum()) + len(starts), 0x20, np.uint8)
        letters = data[inside[1:-1]]
        joined[np.arange(len(letters)) + np.repeat(ordinal, lengths)] = letters
        return joined, placed, placed + lengths, np.searchsorted(starts, borders)

    def located(self, texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For n = 1, 2, ...: (index of the first word of each n-gram, its bucket, words before each text and in all)."""
        joined, starts, ends, bounds = self.words(texts)
        before, behind = self.shifts.prefixes(joined, starts) ^ ONES, self.shifts.prefixes(joined, ends) ^ ONES
        room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(starts))
        for n in range(1, self.longest + 1):
            at = np.flatnonzero(room >= n)
            last = at + n - 1
            crc = behind[last] ^ self.shifts.shifted(before[at], ends[last] - starts[at])
            yield at, crc.astype(np.int64) % self.buckets, bounds


def counting(buckets: int, longest: int):
    """One row for each bucket that occurs in the partition: (bucket, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts = Features(buckets, longest), np.zeros(buckets, np.int64)
        for piece in (p for batch in batches for p in slices(batch, 0)):
            for _, own, _ in features.located(Texts(piece.column(0))):
                counts += np.bincount(own, minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen])], ["bucket", "n"])

    return run


def weighing(gains: list[int], longest: int):
    """(id, words, n_features, weight) of each text."""
    table = np.array(gains, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(table), longest)
        for piece in (p for batch in batches for p in slices(batch, 1)):
            words, sums, found = 0, 0, 0
            for at, own, bounds in features.located(Texts(piece.column(1))):
                running = np.concatenate([[0], np.cumsum(table[own])])
                cuts = np.searchsorted(at, bounds)
                sums = sums + np.diff(running[cuts])
                found = found + np.diff(cuts)
                words = np.diff(bounds)
            columns = [pa.array(c, pa.int64()) for c in (words, found, sums)]
            yield pa.RecordBatch.from_arrays([piece.column(0), *columns], ["id", "words", "n_features", "weight"])

    return run


def bucket_counts(texts: DataFrame, buckets: int, longest: int, text_col: str = "text") -> list[int]:
    """How often each bucket occurs in all texts: as many numbers as there are buckets, whatever the corpus."""
    packed = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(counting(buckets, longest), "bucket long, n long")
    counts = [0] * buckets
    for bucket, n in packed.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gained(corpus: list[int], target: list[int]) -> list[int]:
    """Thousandths of the smoothed log ratio of target to corpus share, rounded down, for each bucket."""
    more = len(corpus)
    all_corpus, all_target = sum(corpus) + more, sum(target) + more
    return [
        math.floor(1000 * math.log(float((t + 1) * all_corpus) / float((s + 1) * all_target)))
        for s, t in zip(corpus, target)
    ]


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = 10_000,
    longest: int = 3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) for every row of docs.

    Words are runs of digits, letters a-z (A-Z counts as a-z) and characters beyond ASCII; features are all runs of 1
    to `longest` words. weight: sum of the features' gains in thousandths, 0 without words. score: weight and a Gumbel
    draw that hangs on seed and id alone. rank: 1, 2, ... of the `percent` highest scores among the texts with at
    least `least_words` words, ties to the smaller id; null for all others. Null texts are empty; a null id draws as
    an empty one and comes last in a tie. Rows with the same id and score follow each other in the order of n_features.
    `target` may be empty: then all gains come from the smoothing. Rows that are equal in all results are counted
    before they are ranked. Other columns are not returned. Memory follows the longest text, about 30 bytes for each
    of its bytes.
    """
    gains = gained(bucket_counts(docs, buckets, longest, text_col), bucket_counts(target, buckets, longest, text_col))
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    weighed = given.mapInArrow(weighing(gains, longest), "id long, words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    drawn = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + 0.5) / F.lit(4294967296.0)
    scored = weighed.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(drawn))).cast("long"))
    scored = stored(scored.groupBy("id", "words", "n_features", "weight", "score").agg(F.count("*").alias("n")), "scored")
    eligible = scored.where(F.col("words") >= least_words)
    drawn = percent * (eligible.agg(F.sum("n")).first()[0] or 0) // 100
    order = {"score": F.desc, "id": F.asc_nulls_last, "n_features": F.asc}
    reached = running_total(eligible, [], order, "n", "upto")
    others = scored.where(F.col("words") < least_words).withColumn("upto", F.lit(None).cast("long"))
    place = F.col("upto") - F.col("n") + F.col("copy") + 1
    return written_out(reached.select(*others.columns).unionByName(others), F.col("n")).select(
        F.col("id").alias(id_col), F.col("words").alias("n_words"), "n_features", "weight", "score",
        F.when(place <= drawn, place).alias("rank"),
    )
