"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Features are byte 5-grams and 7-grams of the folded text; a bounded sample of labelled rows picks the grams that
tell the classes apart (chi-square), document frequencies come from all documents. Examples lie in one flat
posting array, in blocks, with the largest weight of each term in each block. A text visits its most promising
block first; every block whose bound can still reach its k nearest is then scored exactly. The neighbours' votes
are weighted by distance, and a monotone fit on labelled rows that are no examples turns votes into
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays
from tidemark.llm.arrays import Texts, mixed
from tidemark.llm.shipping import shipped
from tidemark.llm.storage import stored

shipped(__name__)

EXAMPLES = 1500  # examples of each class, at most
CALIBRATION = 4000  # labelled rows for the monotone fit, at most
FEATURES = 2048  # grams kept, at most
LEAST_SQUARE = 25.0  # chi-square that a gram needs
NEIGHBOURS = 15
BLOCK = 64  # examples in a block
SIZES = (5, 7)
FILTER_BITS = 20


def folded() -> np.ndarray:
    """Capital letters to small ones; white space, controls and ASCII punctuation to a space."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] = table[97:123]
    for b in range(128):
        if not chr(b).isalnum():
            table[b] = 32
    return table


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """The bytes of each gram as one integer, marked with its size."""
    n = len(data) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = data.astype(np.uint64)
    two = wide[:-1] | wide[1:] << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    tail = four[size - 4 : size - 4 + n] >> np.uint64(8 * (8 - size))
    return four[:n] | tail << np.uint64(32) | np.uint64(size << 56)


class Extractor:
    """Counts of the chosen grams in each text."""

    def __init__(self, chosen: np.ndarray):
        self.chosen, self.table = chosen, folded()
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.slot(chosen)] = True

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)

    def count(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, count), by text and feature."""
        owners, features = [], []
        first, end = int(texts.offsets[0]), int(texts.offsets[-1])
        width = max(SIZES) - 1
        for at in range(first, end, arrays.CHUNK):
            stop = min(at + arrays.CHUNK, end)
            data = self.table[texts.data[at : min(stop + width, end)]]
            for size in SIZES:
                keys = grams(data, size)[: stop - at]
                hits = np.flatnonzero(self.filter[self.slot(keys)])
                found = np.searchsorted(self.chosen, keys[hits])
                found[found == len(self.chosen)] = 0
                right = self.chosen[found] == keys[hits] if len(self.chosen) else np.zeros(len(hits), bool)
                places = hits[right] + at
                owner = np.searchsorted(texts.offsets, places, side="right") - 1
                inside = places + size <= texts.offsets[owner + 1]
                owners.append(owner[inside])
                features.append(found[right][inside])
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        feature = np.concatenate(features) if features else np.empty(0, np.int64)
        keys, counts = np.unique(owner * (len(self.chosen) + 1) + feature, return_counts=True)
        return keys // (len(self.chosen) + 1), keys % (len(self.chosen) + 1), counts


def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, rows of class 1, rows of class 0) of the batch."""
    table = folded()
    for batch in batches:
        texts, labels = Texts(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        parts: tuple[list, list] = ([], [])
        for i in range(len(texts)):
            data = table[texts.data[texts.offsets[i] : texts.offsets[i + 1]]]
            parts[int(labels[i])].append(np.unique(np.concatenate([grams(data, s) for s in SIZES])))
        for label, own in enumerate(parts):
            keys, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *own]), return_counts=True)
            zero = np.zeros(len(keys), np.int64)
            ones, zeros = (counts, zero) if label else (zero, counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(ones), pa.array(zeros)], ["gram", "ones", "zeros"])


def frequencies(features: int):
    """(term, texts that hold it) of each batch of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=features)
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int32)), pa.array(total[terms])], ["term", "n"])

    return run


def chosen_grams(sample: DataFrame, features: int) -> np.ndarray:
    """The grams with the largest chi-square between the classes, among those in at least three rows."""
    totals = sample.agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).first()
    ones, zeros = float(totals["ones"] or 0), float((totals["n"] or 0) - (totals["ones"] or 0))
    if not ones or not zeros:
        return np.empty(0, np.uint64)
    counted = (
        sample.select("text", "label").mapInArrow(gram_counts, "gram long, ones long, zeros long")
        .groupBy("gram").agg(F.sum("ones").alias("a"), F.sum("zeros").alias("b")).where("a + b >= 3")
    )
    a, b = F.col("a"), F.col("b")
    n, seen = ones + zeros, F.col("a") + F.col("b")
    gap = a * zeros - b * ones
    square = gap * gap * n / (F.lit(ones * zeros) * seen * (F.lit(n) - seen + 1))
    best = counted.where(square >= LEAST_SQUARE).orderBy(square.desc(), "gram").limit(features).select("gram").collect()
    return np.sort(np.array([r["gram"] for r in best], np.int64).astype(np.uint64))


def vectors(rows: DataFrame, chosen: np.ndarray, keep: list[str]) -> DataFrame:
    """The kept columns with `terms` and `counts` of the text."""
    schema = rows.select(*keep).schema
    chosen_of = rows.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(chosen_of.value)
        for batch in batches:
            owner, feature, counts = extractor.count(Texts(batch.column(batch.num_columns - 1)))
            bounds = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (feature, counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], [*batch.schema.names[:-1], "terms", "counts"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.select(*keep, "text").mapInArrow(run, f"{fields}, terms array<int>, counts array<int>")


@dataclass
class Index:
    """Flat postings of the examples, ordered by block and term, with block maxima."""

    idf: np.ndarray
    maxima: np.ndarray  # term x block
    starts: np.ndarray  # first posting of each block, and the end
    terms: np.ndarray
    places: np.ndarray  # place of the example in its block
    weights: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    knots: np.ndarray  # vote and probability of the monotone fit
    values: np.ndarray
    empty: float  # score of a text without any chosen gram

    @staticmethod
    def build(rows: list[tuple[object, int, list[int], list[int]]], idf: np.ndarray) -> Index:
        """rows: (id, label, terms, counts). Examples with the same heaviest term come together."""
        units = []
        for key, label, terms, counts in rows:
            weights = (1 + np.log(np.array(counts, float))) * idf[terms]
            units.append((int(np.array(terms)[np.argmax(weights)]), key, label, terms, weights / np.linalg.norm(weights)))
        units.sort(key=lambda u: (u[0], str(u[1])))
        blocks = max(1, -(-len(units) // BLOCK))
        maxima = np.zeros((len(idf), blocks))
        postings = []
        for i, (_, _, _, terms, weights) in enumerate(units):
            block = i // BLOCK
            maxima[terms, block] = np.maximum(maxima[terms, block], weights)
            postings += [(block, t, i % BLOCK, w) for t, w in zip(terms, weights)]
        postings.sort()
        flat = np.array(postings, dtype=float).reshape(-1, 4)
        starts = np.searchsorted(flat[:, 0], np.arange(blocks + 1))
        return Index(
            idf, maxima, starts, flat[:, 1].astype(np.int32), flat[:, 2].astype(np.int32), flat[:, 3],
            np.array([u[2] for u in units], float), np.array([u[1] for u in units], object), np.zeros(0), np.zeros(0), 0.0,
        )

    def block(self, b: int) -> np.ndarray:
        """Term x place weights of a block, spread from its postings."""
        out = np.zeros((len(self.idf), BLOCK))
        own = slice(self.starts[b], self.starts[b + 1])
        out[self.terms[own], self.places[own]] = self.weights[own]
        return out

    def nearest(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(similarity, example) of the k most similar examples of each unit vector; ties to the first example.
        Where there are fewer than k with a similarity above 0, the rest are 0 and -1."""
        n, blocks = len(queries), self.maxima.shape[1]
        best, who = np.zeros((n, k)), np.full((n, k), -1)
        if not len(self.labels):
            return best, who
        bounds = queries @ self.maxima + 1e-9
        first = np.argmax(bounds, axis=1)

        def visit(b: int, rows: np.ndarray) -> None:
            scores = queries[rows] @ self.block(b)
            size = min(BLOCK, len(self.labels) - b * BLOCK)
            found = np.concatenate([best[rows], scores[:, :size]], axis=1)
            names = np.concatenate([who[rows], np.broadcast_to(np.arange(size) + b * BLOCK, (len(rows), size))], axis=1)
            names[found <= 0] = -1
            order = np.lexsort((np.where(names < 0, len(self.labels), names), -np.round(found, 12)), axis=1)[:, :k]
            best[rows], who[rows] = np.take_along_axis(found, order, 1), np.take_along_axis(names, order, 1)

        for b in range(blocks):
            rows = np.flatnonzero(first == b)
            if len(rows):
                visit(b, rows)
        for b in range(blocks):
            rows = np.flatnonzero((first != b) & (bounds[:, b] >= best[:, -1]) & (bounds[:, b] > 2e-9))
            if len(rows):
                visit(b, rows)
        return best, who

    def votes(self, best: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Share of class 1 among the neighbours, each weighing 1 / (distance + 0.05); NaN without neighbours."""
        weights = np.where(who >= 0, 1 / (1.05 - np.minimum(best, 1)), 0)
        classes = np.where(who >= 0, self.labels[np.maximum(who, 0)] if len(self.labels) else 0, 0)
        with np.errstate(invalid="ignore"):
            return (weights * classes).sum(1) / weights.sum(1)

    def probability(self, votes: np.ndarray) -> np.ndarray:
        out = np.interp(votes, self.knots, self.values) if len(self.knots) else votes
        return np.where(np.isnan(votes), self.empty, out)

    def queries(self, terms: pa.Array, counts: pa.Array) -> np.ndarray:
        """Unit TF-IDF vectors, dense over the chosen grams."""
        out = np.zeros((len(terms), len(self.idf)))
        sizes = np.diff(terms.offsets.to_numpy())
        rows, at = np.repeat(np.arange(len(terms)), sizes), terms.flatten().to_numpy()
        out[rows, at] = (1 + np.log(counts.flatten().to_numpy())) * self.idf[at]
        lengths = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(lengths > 0, lengths, 1)


def monotone(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising fit of the labels to the votes (pool adjacent violators), drawn towards the base rate by one row."""
    order = np.argsort(votes, kind="stable")
    base = labels.mean() if len(labels) else 0.5
    pools: list[list[float]] = []  # label sum, rows, vote sum
    for v, y in zip(votes[order], labels[order]):
        pools.append([y, 1, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [x + z for x, z in zip(pools[-1], last)]
    return np.array([p[2] / p[1] for p in pools]), np.array([(p[0] + base) / (p[1] + 1) for p in pools])


def _sampled(labelled: DataFrame, order: str, n: int) -> DataFrame:
    return labelled.orderBy(F.xxhash64(F.lit(order), "id"), "id").limit(n)


def scored(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    examples: int = EXAMPLES, calibration: int = CALIBRATION, features: int = FEATURES, neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """(id, score, predicted, evidence) for every row of docs.

    labels: (id, label 0 or 1) of the rows to learn from; other labels, ids without a document and null labels
    teach nothing. The sample is bounded by `examples` of each class and `calibration` more rows, drawn in the
    order of a hash of the id. score: probability of label 1; predicted: 1 from 0.5 on; evidence: ids of the three
    nearest examples. A null or empty text, and any text without a chosen gram, gets the share of label 1 among
    such labelled rows. Without rows of both labels the score is the base rate, or 0 if there is none. Repeated
    rows are scored alike, other columns are not returned.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id IS NOT NULL AND label IN (0, 1)")
    # A third of the rows serves the calibration, so that it sees both labels at their natural rate.
    apart = F.pmod(F.xxhash64(F.lit("role"), "id"), F.lit(3)) == 0
    sampled = _sampled(known.where(apart), "calibration", calibration).withColumn("role", F.lit("calibration"))
    for label in (0, 1):
        own = _sampled(known.where(~apart & (F.col("label") == label)), "example", examples)
        sampled = sampled.unionByName(own.withColumn("role", F.lit("example")))
    # At most calibration + 2 * examples ids, by the limits above.
    sampled = sampled.distinct()
    sample = stored(given.join(F.broadcast(sampled), "id"), "toxic-sample")
    chosen = chosen_grams(sample, features)
    counted = stored(vectors(given, chosen, ["id"]), "toxic-vectors")
    totals = counted.agg(F.count(F.lit(1))).first()[0]
    df = np.zeros(len(chosen))
    seen = counted.select("terms").mapInArrow(frequencies(len(chosen)), "term int, n long")
    for row in seen.groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[row["term"]] = row["n"]
    idf = np.log((totals + 1) / (df + 1)) + 1
    rows = vectors(sample, chosen, ["id", "label", "role"]).collect()
    index = Index.build([(r["id"], r["label"], r["terms"], r["counts"]) for r in rows if r["role"] == "example" and r["terms"]], idf)
    rest = [r for r in rows if r["role"] == "calibration"]
    every = np.array([r["label"] for r in (rest or rows)], float)
    base = float(every.mean()) if len(every) else 0.0
    index.empty = base
    if rest and len(index.labels):
        tried = index.queries(pa.array([r["terms"] for r in rest], pa.list_(pa.int32())), pa.array([r["counts"] for r in rest], pa.list_(pa.int32())))
        votes = index.votes(*index.nearest(tried, neighbours))
        with_votes = ~np.isnan(votes)
        if with_votes.any():
            index.knots, index.values = monotone(votes[with_votes], every[with_votes])
        none = every[~with_votes]
        index.empty = float((none.sum() + base) / (len(none) + 1))
    shared = spark.sparkContext.broadcast(vars(index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(**shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                n = piece.num_rows
                sizes = np.diff(piece.column(1).offsets.to_numpy())
                score, near = np.full(n, index.empty), np.full((n, 3), -1)
                rows = np.flatnonzero(sizes)
                if len(rows):
                    own = piece.take(pa.array(rows))
                    best, who = index.nearest(index.queries(own.column(1), own.column(2)), neighbours)
                    score[rows] = index.probability(index.votes(best, who))
                    near[rows, : who.shape[1]] = who[:, :3]
                evidence = [[index.ids[i] for i in line if i >= 0] for line in near]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(evidence, pa.list_(batch.schema.field("id").type))],
                    ["id", "score", "predicted", "evidence"],
                )

    kind = given.schema["id"].dataType.simpleString()
    result = counted.mapInArrow(run, f"id {kind}, score double, predicted int, evidence array<{kind}>")
    return result.withColumnRenamed("id", id_col)
