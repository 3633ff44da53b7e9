"""Exact substring dedup with fixed-block anchors.

Every document is cut into non-overlapping reference blocks of half a window; any repeat of a whole window holds
one such block unbroken. The rolling windows of block length of all documents probe the blocks: both are dealt by
their hash, packed as sorted arrays, so a batch sends one row to each partition however many windows it has. Around
the hits, repeats are extended to whole windows on either side; equal windows meet under a 128-bit key, the
smallest document with a window keeps it, and the union of the others is the maximal repeat that goes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import Runs, Texts, Words, mixed, pack, scaled, slices, steps, unpack, within
from tidemark.llm.shipping import shipped
from tidemark.llm.storage import buckets, stored

shipped(__name__)

PACKED = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("kind", pa.int8()), ("blob", pa.binary())])
PACKED_SQL = "bucket int, batch long, kind tinyint, blob binary"
TABLE, PROBES, HITS = 0, 1, 2
EMPTY = np.empty(0, np.int64)
SLICE = 4 << 20  # bytes of text whose windows are sorted together


class Documents:
    """Word hashes of a batch of (id, text, mark, ...), in the order of ids; rows with a null id are left out."""

    def __init__(self, batch: pa.RecordBatch, words: Words):
        batch = batch.filter(batch.column(0).is_valid())
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        batch = batch.take(pa.array(order))
        self.batch, self.ids, self.marks = batch, ids[order], batch.column(2).to_numpy()
        self.words, self.bounds = words.hashes(Texts(batch.column(1)))
        # The same rows in another task attempt get the same name.
        seen = mixed(self.ids.astype(np.uint64)) ^ mixed(self.bounds[1:].astype(np.uint64) + np.uint64(1))
        names = mixed(seen + np.arange(len(seen), dtype=np.uint64))
        self.name = int((names.sum(dtype=np.uint64) ^ self.words.sum(dtype=np.uint64)).astype(np.int64)) if len(names) else 0

    def table(self, parts: int) -> dict:
        return {"bucket": self.name % parts, "batch": self.name, "kind": TABLE, "blob": pack(self.ids, self.marks) + self.bounds.tobytes()}

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, side="right") - 1


def rows(found: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(found, PACKED)


def probes(block: int, parts: int):
    """Map side of the first pass: rolling windows of block length, marked where they are reference blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, runs = Words(lower=False), Runs()
        for batch in (piece for whole in batches for piece in slices(whole, 1, SLICE)):
            docs = Documents(batch, words)
            keys = runs.hashes(docs.words, block)
            places = np.flatnonzero(within(docs.bounds, block)[: len(keys)])
            if not len(places):
                continue
            keys = scaled(keys[places], parts)
            aligned = (places - docs.bounds[docs.owner(places)]) % block == 0
            order = np.argsort(keys, kind="stable")
            keys, places, aligned = keys[order], places[order], aligned[order]
            # Windows that meet a block within the batch are hits already; two of them stand for all.
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(keys)]]))
            with_block = np.logical_or.reduceat(aligned, starts)
            local = np.repeat((sizes >= 2) & with_block, sizes)
            rank = np.arange(len(keys)) - np.repeat(starts, sizes)
            found = [docs.table(parts)]
            if local.any():
                hits = np.sort(places[local]).astype(np.uint32)
                found.append({"bucket": docs.name % parts, "batch": docs.name, "kind": HITS, "blob": pack(steps(hits))})
            aligned = aligned | local
            sent = ~local | (rank < 2)
            keys, places, aligned = keys[sent], places[sent].astype(np.uint32), aligned[sent]
            cuts = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
            prints = ((keys & np.uint64(0xFFFFFFFF)) >> np.uint64(8)).astype(np.uint32)
            for b in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[b], cuts[b + 1])
                blob = pack(steps(prints[own]), places[own]) + np.packbits(aligned[own]).tobytes()
                found.append({"bucket": int(b), "batch": docs.name, "kind": PROBES, "blob": blob})
                if len(found) >= 64:
                    yield rows(found)
                    found = []
            yield rows(found)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> list[dict]:
    return [row for batch in batches for row in batch.to_pylist()]


def _answered(given: list[dict], hits: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    yield rows([r for r in given if r["kind"] != PROBES])
    found = [
        {"bucket": 0, "batch": name, "kind": HITS, "blob": pack(steps(np.sort(places)))}
        for name, places in hits if len(places)
    ]
    for at in range(0, len(found), 64):
        yield rows(found[at : at + 64])


def match_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side of the first pass: places of windows whose print occurs twice and at a reference block."""
    given = _gathered(batches)
    parts = []
    for r in given:
        if r["kind"] == PROBES:
            prints, places = unpack(r["blob"], np.uint32, np.uint32)
            flags = np.unpackbits(np.frombuffer(r["blob"], np.uint8, offset=8 + 8 * len(prints)), count=len(prints))
            parts.append((r["batch"], np.cumsum(prints, dtype=np.uint32), places, flags.astype(bool)))
    hits = []
    if parts:
        prints = np.concatenate([p[1] for p in parts])
        order = np.argsort(prints, kind="stable")
        ordered = prints[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(ordered)]]))
        flags = np.concatenate([p[3] for p in parts])[order]
        live = np.empty(len(prints), bool)
        live[order] = np.repeat((sizes >= 2) & np.logical_or.reduceat(flags, starts), sizes)
        at = 0
        for name, own, places, _ in parts:
            hits.append((name, places[live[at : at + len(own)]]))
            at += len(own)
    yield from _answered(given, hits)


def located(key: tuple, table: pa.Table) -> pa.Table:
    """The hits of one batch as (id, mark, places in the document)."""
    given = table.to_pylist()
    head = next((r["blob"] for r in given if r["kind"] == TABLE), None)
    hits = [np.cumsum(unpack(r["blob"], np.uint32)[0], dtype=np.uint32) for r in given if r["kind"] == HITS]
    ids, marks, lists = [], [], []
    if head is not None and hits:
        names, of_text = unpack(head, np.int64, np.int64)
        bounds = np.frombuffer(head, np.int64, offset=8 + 16 * len(names))
        places = np.unique(np.concatenate(hits)).astype(np.int64)
        owners = np.searchsorted(bounds, places, side="right") - 1
        cuts = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
        for at, stop in zip(cuts, [*cuts[1:], len(places)]):
            ids.append(int(names[owners[at]]))
            marks.append(int(of_text[owners[at]]))
            lists.append(pack(steps((places[at:stop] - bounds[owners[at]]).astype(np.uint32))))
    return pa.table([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(lists, pa.binary())], ["id", "mark", "places"])


def _places(blobs: list[bytes] | None) -> np.ndarray:
    if not blobs:
        return EMPTY
    return np.unique(np.concatenate([np.cumsum(unpack(b, np.uint32)[0], dtype=np.uint32) for b in blobs])).astype(np.int64)


def windows(window: int, block: int, parts: int):
    """Map side of the second pass: whole windows around the hits, as 128-bit keys with their document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, runs = Words(lower=False), Runs()
        others, more = Words(lower=False, seed=17), Runs(seed=23)  # the second half of a key shares nothing with the first
        for batch in (piece for whole in batches for piece in slices(whole.filter(whole.column(3).is_valid()), 1, SLICE)):
            docs = Documents(batch, words)
            total = int(docs.bounds[-1])
            if total < window:
                continue
            marks = np.zeros(total + 1, np.int64)  # a hit at p may lie in the windows from p - (window - block) to p
            for i, blobs in enumerate(docs.batch.column(3).to_pylist()):
                size = docs.bounds[i + 1] - docs.bounds[i]
                hits = _places(blobs)
                hits = hits[hits < size]
                np.add.at(marks, docs.bounds[i] + np.maximum(hits - (window - block), 0), 1)
                np.add.at(marks, docs.bounds[i] + hits + 1, -1)
            room = within(docs.bounds, window)
            places = np.flatnonzero((np.cumsum(marks[:-1]) > 0) & room)
            if not len(places):
                continue
            keys = runs.hashes(docs.words, window)[places]
            second = more.hashes(others.hashes(Texts(docs.batch.column(1)))[0], window)[places]
            owners = docs.ids[docs.owner(places)]
            order = np.argsort(keys, kind="stable")  # places of equal keys stay in the order of ids
            keys, second, places, owners = keys[order], second[order], places[order].astype(np.uint32), owners[order]
            # A batch sends the smallest document of each window and the repeats that need an answer from others.
            first = np.concatenate([[True], (keys[1:] != keys[:-1]) | (second[1:] != second[:-1])])
            group = np.cumsum(first) - 1
            least = owners[np.flatnonzero(first)][group]
            found = [docs.table(parts)]
            local = owners > least
            if local.any():
                found.append({"bucket": docs.name % parts, "batch": docs.name, "kind": HITS, "blob": pack(steps(np.sort(places[local])))})
            sent = ~local
            keys, second, places, owners = keys[sent], second[sent], places[sent], owners[sent]
            cuts = np.searchsorted(scaled(keys, parts), np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
            for b in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[b], cuts[b + 1])
                blob = pack(keys[own], second[own], places[own], owners[own])
                found.append({"bucket": int(b), "batch": docs.name, "kind": PROBES, "blob": blob})
                if len(found) >= 64:
                    yield rows(found)
                    found = []
            yield rows(found)

    return run


def match_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side of the second pass: places of windows that a smaller document has too."""
    given = _gathered(batches)
    parts = [(r["batch"], *unpack(r["blob"], np.uint64, np.uint64, np.uint32, np.int64)) for r in given if r["kind"] == PROBES]
    hits = []
    if parts:
        keys, second, owners = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 4))
        order = np.lexsort((owners, second, keys))
        first = np.concatenate([[True], (np.diff(keys[order]) != 0) | (np.diff(second[order]) != 0)])
        least = np.empty(len(keys), np.int64)
        least[order] = owners[order][np.flatnonzero(first)][np.cumsum(first) - 1]
        at = 0
        for name, _, _, places, own in parts:
            hits.append((name, places[own > least[at : at + len(own)]]))
            at += len(own)
    yield from _answered(given, hits)


def removed(window: int):
    """Covers the words of the repeated windows and joins the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in slices(whole, 1, SLICE)):
            out: tuple[list, list, list, list] = ([], [], [], [])
            for text, blobs in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at the six white-space bytes
                spans, gone = [], 0
                starts = _places(blobs)
                if len(starts):
                    breaks = np.flatnonzero(np.diff(starts) > window) + 1
                    kept, at = [], 0
                    for run_of in np.split(starts, breaks):
                        begin, end = int(run_of[0]), min(int(run_of[-1]) + window, len(words))
                        kept += words[at:begin]
                        spans.append({"start": begin, "end": end})
                        gone += end - begin
                        at = end
                    words, count = kept + words[at:], len(words)
                else:
                    count = len(words)
                for column, value in zip(out, (count, gone, spans, b" ".join(words).decode("utf-8", "surrogatepass"))):
                    column.append(value)
            spans = pa.array(out[2], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), spans, pa.array(out[3], pa.string())]
            names = ["id", "n_words", "n_removed", "spans", "kept"]
            if batch.num_columns > 4:
                columns += [batch.column(4), pc.if_else(pc.greater(columns[1], 0), columns[3], batch.column(1).cast(pa.string()))]
                names += ["rest", "text"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return run


def dedup(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
) -> DataFrame:
    """(id, n_words, n_removed, spans, kept) for every row of docs; with `carry`, those columns as the struct `rest`,
    and `text`: the given text if nothing goes, else the kept words.

    Words are runs of anything but the six ASCII white-space characters. A word goes if a window of `window` words
    that covers it also starts in a document with a smaller id; windows are judged on the input. spans: removed
    ranges of words, [start, end); kept: the other words joined by one space. Null and empty texts, and texts
    shorter than a window, lose nothing. Ids are integers; rows with a null id keep all their words and take none
    from others, rows that share an id don't take words from each other. Other columns are not returned.
    """
    if window < 2:
        raise ValueError("a window needs at least two words")
    spark, block = docs.sparkSession, (window + 1) // 2
    rest = [F.struct(*carry).alias("rest")] if carry else []
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *rest)
    # Rows that share an id are told apart by their texts.
    given = given.withColumn("mark", F.xxhash64("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = buckets(spark, size)

    def answered(packed: DataFrame, match) -> DataFrame:
        dealt = packed.mapInArrow(match, PACKED_SQL) if parts == 1 else packed.repartitionById(parts, F.col("bucket")).mapInArrow(match, PACKED_SQL)
        located_rows = dealt.groupBy("batch").applyInArrow(located, "id long, mark long, places binary")
        return located_rows.groupBy("id", "mark").agg(F.collect_list("places").alias("places"))

    hits = stored(answered(given.select("id", "text", "mark").mapInArrow(probes(block, parts), PACKED_SQL), match_blocks), "block-hits")
    # Both joins are left joins of the same texts, so these are dealt by id once; rows without hits are passed over.
    names = ["id", "text", "mark", "places", *(["rest"] if carry else [])]
    around = given.join(hits, ["id", "mark"], "left").select(*names)
    repeated = answered(around.mapInArrow(windows(window, block, parts), PACKED_SQL), match_windows)
    whole = given.join(repeated, ["id", "mark"], "left").select(*names)
    schema = "id long, n_words long, n_removed long, spans array<struct<start: int, end: int>>, kept string"
    if carry:
        schema += f", rest {given.schema['rest'].dataType.simpleString()}, text string"
    return whole.mapInArrow(removed(window), schema).withColumnRenamed("id", id_col)
