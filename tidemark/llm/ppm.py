"""Language-model scores by prediction by partial matching over bytes.

A text is read as its words in lower case, a space behind each, and one end. Every byte of it is predicted from the up
to six bytes before it, across word borders; six spaces stand before the first. All training texts are counted, byte by
byte, in the trie of these contexts, so the order of words matters, and words that training has not seen are spelled by
the same trie.

Counts. The longest contexts count occurrences. A shorter context counts a byte once for each longer context that it
followed (update exclusion: longer contexts that know the byte do not pass its repetitions on).

Escapes. A context with T counts takes a discount d from each byte it has seen; d depends on the order and on whether
the count is 1, 2 or more, and is estimated from the numbers of counts 1 to 4 in the whole trie (`discounts`). The mass
L / T that this frees is shared by what the next shorter context q predicts: a seen byte inherits L / T q(byte), and the
escape is L / T (1 - sum of q over the seen bytes). After an escape the seen bytes are excluded, that is, the others
keep their shares of q, divided by 1 - sum of q over the seen bytes. The two sums cancel, so an unseen byte has
probability L / T q(byte), and the trie is evaluated from the shortest context up without holding exclusion sets.
Without any context all SYMBOLS are alike. The probabilities of all bytes after a context sum to 1.

In Spark. A byte's probability depends on the run of seven bytes that it ends, so a slice of texts is reduced to its
distinct runs with training counts. Runs are dealt by the NEAR bytes before the predicted one: all contexts of three
bytes or more that predict it meet in one bucket. Shorter contexts hold at most 256^3 counts whatever the corpus, and
are shipped. A bucket prices its runs and answers each slice; a text's score is the sum over its bytes. Texts meet
nothing but the answers to their slice. A bucket keeps the runs that slices sent compressed, and adds them up a part
at a time, so its memory follows the distinct runs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import Texts, Words, mixed, pack, scaled, slices, unpack
from tidemark.llm.shipping import shipped
from tidemark.llm.storage import buckets, stored

shipped(__name__)

DEPTH = 6  # bytes of the longest context
NEAR = 3  # bytes before the predicted one that runs are dealt by
SYMBOLS = 252  # 250 bytes that words can hold, the end of a word and the end of a text
PIECE = 4 << 20  # bytes of text handled at a time
SLICE = 16 << 20  # bytes of text whose distinct runs are sent together
PENDING = 1 << 20  # runs that a bucket holds before it adds them up, at least
SPACE, END = 0x20, 0x0A
MARGIN = 0.05  # a discount stays this far from nothing and from the whole count
ROW = pa.schema([("place", pa.int64()), ("other", pa.int64()), ("kind", pa.int8()), ("runs", pa.binary()), ("words", pa.binary())])
ROW_SQL = "place long, other long, kind tinyint, runs binary, words binary"
TEXTS, ASKED, LOW, TOTALS, ANSWERS = range(5)
Found = tuple[int, int, int, bytes, bytes]


def limited(found: Iterable[Found], n: int = 64) -> Iterator[pa.RecordBatch]:
    held: list[Found] = []
    for row in found:
        held.append(row)
        if len(held) == n:
            yield rows(held)
            held = []
    if held:
        yield rows(held)


def rows(found: list[Found]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(ROW.names, r)) for r in found], ROW)


def squeezed(blob: bytes) -> bytes:
    return len(blob).to_bytes(8, "little") + pa.compress(blob, "zstd", asbytes=True)


def released(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)


# --- texts as runs of bytes ----------------------------------------------------------------------


def lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] = table[97:123]
    return table


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The pieces [start, end) of the bytes, each followed by a space."""
    sizes = ends - starts + 1
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    source = np.repeat(starts - (stops - sizes), sizes) + np.arange(total)
    out = data[np.minimum(source, max(len(data) - 1, 0))] if total else np.empty(0, np.uint8)
    out[stops - 1] = SPACE
    return out


def predicted(texts: Texts, splitter: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(run of each predicted byte, number of them in each text, hash of each word, first word of each text and the end).

    A run is one integer: the byte in the lowest eight bits, the nearest byte before it in the highest.
    """
    n = len(texts)
    hashes, bounds, begins, finishes = splitter.located(texts)
    size = len(texts.data)
    data = np.concatenate([lowered()[texts.data], np.array([END] + [SPACE] * (DEPTH - 1), np.uint8)])
    words = np.diff(bounds)
    place = np.arange(len(hashes)) + 2 * np.repeat(np.arange(n), words) + 1  # each text has its margin before and its end behind
    first = bounds[:-1] + 2 * np.arange(n)
    starts, ends = np.empty(len(hashes) + 2 * n, np.int64), np.empty(len(hashes) + 2 * n, np.int64)
    starts[place], ends[place] = begins, finishes
    starts[first], ends[first] = size + 1, size + DEPTH
    last = first + words + 1
    starts[last], ends[last] = size, size + 1
    stream = joined(data, starts, ends)
    stops = np.cumsum(ends - starts + 1)
    begin, finish = stops[first], stops[last] - 1  # of the predicted bytes of each text
    keep = np.zeros(len(stream) + 1, np.int8)
    keep[begin] = 1
    keep[finish] -= 1
    keep = np.cumsum(keep[:-1], dtype=np.int8).view(bool)
    codes = stream.astype(np.uint64)
    for back in range(1, DEPTH + 1):
        codes[back:] |= stream[:-back].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - back))
    return codes[keep], finish - begin, hashes, bounds


def dealt(codes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the codes by bucket, cuts between buckets); codes ascend, and so do those of a bucket."""
    near = codes >> np.uint64(8 * (DEPTH + 1 - NEAR))
    bucket = (scaled(mixed(near), parts) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(parts + 1))


def cut_words(keys: np.ndarray, parts: int) -> np.ndarray:
    """Cuts between the buckets of ascending word keys."""
    return np.searchsorted(scaled(keys, parts), np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))


def end_key(splitter: Words) -> np.uint64:
    """The key of the end of a text: no word hashes to it but by chance."""
    return mixed(np.array([0xE4D], np.uint64) + splitter.table[97:98])[0]


# --- the trie ------------------------------------------------------------------------------------


def edge(codes: np.ndarray, k: int) -> np.ndarray:
    """The nearest k bytes of the context and the predicted byte."""
    return ((codes >> np.uint64(8 * (DEPTH + 1 - k))) << np.uint64(8)) | (codes & np.uint64(255))


def shorter(edges: np.ndarray) -> np.ndarray:
    """Edges without the farthest byte of their contexts."""
    return ((edges >> np.uint64(16)) << np.uint64(8)) | (edges & np.uint64(255))


def summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, weights=amounts, minlength=len(unique)).astype(np.int64)


def added(pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all keys; holds little more than the distinct ones."""
    total = (np.empty(0, np.uint64), np.empty(0, np.int64))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for pair in pairs:
        held.append(pair)
        size += len(pair[0])
        if size > max(PENDING, len(total[0])):
            total, held, size = summed(*(np.concatenate(c) for c in zip(total, *held))), [], 0
    return summed(*(np.concatenate(c) for c in zip(total, *held))) if held else total


def spread(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.int64)


def discounts(ones: np.ndarray) -> np.ndarray:
    """What a context takes from a count of 1, 2 and more, by the numbers of counts 1 to 4 of its order (the usual
    leaving-one-out estimates, kept inside (0, count))."""
    n = [max(int(x), 1) for x in ones]
    share = n[0] / (n[0] + 2 * n[1])
    return np.array([min(max(i - (i + 1) * share * n[i] / n[i - 1], MARGIN), i - MARGIN) for i in (1, 2, 3)])


class Order:
    """The contexts of one length: their counts, discounts and the mass that the discounts free."""

    def __init__(self, edges: np.ndarray, counts: np.ndarray, taken: np.ndarray):
        self.edges = edges
        self.nodes, node = np.unique(edges >> np.uint64(8), return_inverse=True)
        off = taken[np.minimum(counts, 3) - 1] if len(counts) else np.empty(0)
        total = np.bincount(node, weights=counts, minlength=len(self.nodes))
        self.own = (counts - off) / total[node]
        self.free = np.bincount(node, weights=off, minlength=len(self.nodes)) / total

    def probability(self, keys: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Of the byte of each edge, given its probability after the next shorter context."""
        node, seen = _find(self.nodes, keys >> np.uint64(8)), _find(self.edges, keys)
        known = node >= 0
        out = below.copy()  # a context that training has not seen leaves it to the shorter one
        out[known] *= self.free[node[known]]
        out[seen >= 0] += self.own[seen[seen >= 0]]
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in the sorted keys, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def levels(edges: np.ndarray, counts: np.ndarray, top: int, bottom: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Edges and counts of the orders from top down to bottom; an edge counts the longer ones that end in it."""
    out = {top: (edges, counts)}
    for k in range(top - 1, bottom - 1, -1):
        out[k] = np.unique(shorter(out[k + 1][0]), return_counts=True)
    return out


def probabilities(codes: np.ndarray, trie: dict[int, Order]) -> np.ndarray:
    """Of the last byte of each distinct run after the others."""
    below, before = np.full(1, 1 / SYMBOLS), np.zeros(1, np.uint64)  # the keys of the order below, and their probabilities
    for k in range(DEPTH + 1):
        keys = codes if k == DEPTH else np.unique(edge(codes, k))
        lower = below[np.searchsorted(before, shorter(keys))] if k else np.full(len(keys), below[0])
        before, below = keys, trie[k].probability(keys, lower)
    return below


# --- jobs ----------------------------------------------------------------------------------------


def counted(parts: int):
    """For each slice of (id, text, train): its texts, and for each bucket its distinct runs and words with their
    training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, held, size = Words(lower=True), [], 0
        for batch in batches:
            for piece in slices(batch, 1, PIECE):
                offsets = Texts(piece.column(1)).offsets
                held.append(piece)
                size += int(offsets[-1] - offsets[0])
                if size >= SLICE:
                    yield from limited(of_slice(held, splitter, parts))
                    held, size = [], 0
        if any(piece.num_rows for piece in held):
            yield from limited(of_slice(held, splitter, parts))

    return run


def distinct_runs(codes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often they occur in training; changes the codes in place.

    They are sorted with the mark of training in the lowest bits, so that one plain sort gives both.
    """
    codes <<= np.uint64(8)
    codes |= train.astype(np.uint64)
    codes.sort()
    marks = (codes & np.uint64(1)).astype(np.int64)
    codes >>= np.uint64(8)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(marks, first)


def of_slice(pieces: list[pa.RecordBatch], splitter: Words, parts: int) -> Iterator[Found]:
    ids, sizes, data, runs, words = [], [], [], [], []
    for piece in pieces:
        if not piece.num_rows:
            continue
        texts = Texts(piece.column(1))
        codes, many, hashes, bounds = predicted(texts, splitter)
        train = piece.column(2).to_numpy(zero_copy_only=False).astype(bool)
        runs.append(distinct_runs(codes, np.repeat(train, many)))
        keys, word = np.unique(np.concatenate([hashes, np.full(len(train), end_key(splitter))]), return_inverse=True)
        words.append((keys, np.bincount(word, weights=np.concatenate([np.repeat(train, np.diff(bounds)), train]), minlength=len(keys))))
        ids.append(piece.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        sizes.append(np.diff(texts.offsets))
        data.append(texts.data[texts.offsets[0] : texts.offsets[-1]].tobytes())
    blob = pack(np.concatenate(ids), np.concatenate(sizes)) + b"".join(data)
    name = int(np.array([xxhash.xxh64_intdigest(blob)], np.uint64).view(np.int64)[0])
    yield name, 0, TEXTS, squeezed(blob), b""
    unique, seen = added(runs)
    order, cuts = dealt(unique, parts)
    unique, seen = unique[order], seen[order].astype(np.uint32)
    keys, amounts = added(words)
    word_cuts = cut_words(keys, parts)
    for b in np.flatnonzero((np.diff(cuts) > 0) | (np.diff(word_cuts) > 0)):
        own, mine = slice(cuts[b], cuts[b + 1]), slice(word_cuts[b], word_cuts[b + 1])
        yield int(b), name, ASKED, squeezed(pack(unique[own], seen[own])), squeezed(pack(keys[mine], amounts[mine].astype(np.uint32)))


def pairs(held: list[dict], column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for row in held:
        keys, counts = unpack(released(row[column]), np.uint64, np.uint32)
        yield keys, counts.astype(np.int64)


def gathered(batches: Iterator[pa.RecordBatch]) -> list[dict]:
    return [row for batch in batches for row in batch.to_pylist()]


def trained(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return keys[counts > 0], counts[counts > 0]


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket -> its counts of the contexts of NEAR - 1 bytes, its number of tokens and of distinct ones, and for each
    longer order the numbers of counts 1 to 4."""
    held = gathered(batches)
    if not held:
        return
    tokens = added(pairs(held, "words"))[1]
    trie = levels(*trained(*added(pairs(held, "runs"))), DEPTH, NEAR - 1)
    numbers = np.concatenate([[tokens.sum(), (tokens > 0).sum()], *(spread(trie[k][1]) for k in range(NEAR, DEPTH + 1))])
    yield rows([(0, held[0]["place"], TOTALS, numbers.astype(np.int64).tobytes(), b""), (0, 0, LOW, squeezed(pack(*trie[NEAR - 1])), b"")])


def low_added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = added(unpack(released(row["runs"]), np.uint64, np.int64) for batch in batches for row in batch.to_pylist())
    yield rows([(0, 0, LOW, squeezed(pack(*found)), b"")])


def answered(shared):
    """A bucket -> for each slice that asked: the log10 probabilities of its runs and the counts of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = gathered(batches)
        if not held:
            return
        low, taken = shared.value
        bucket = held[0]["place"]
        keys, tokens = added(pairs(held, "words"))
        codes, counts = added(pairs(held, "runs"))
        found = {**levels(*low, NEAR - 1, 0), **levels(*trained(codes, counts), DEPTH, NEAR)}
        price = np.log10(probabilities(codes, {k: Order(*found[k], taken[k]) for k in found})) if len(codes) else np.empty(0)

        def answers() -> Iterator[Found]:
            for row, (asked, _), (words, _) in zip(held, pairs(held, "runs"), pairs(held, "words")):
                prices = price[np.searchsorted(codes, asked)].astype(np.float32)
                own = tokens[np.searchsorted(keys, words)]
                yield row["other"], bucket, ANSWERS, squeezed(pack(prices)), squeezed(pack(own))

        yield from limited(answers())

    return run


SCORES = "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def bytes_scored(blob: bytes, price: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts of a slice and the prices of its runs -> (ids, tokens of each text, place of each token's key among
    the distinct ones, score of each text)."""
    splitter = Words(lower=True)
    ids, sizes = unpack(blob, np.int64, np.int64)
    stops, data = np.cumsum(sizes), np.frombuffer(blob, np.uint8)[8 + 16 * len(ids) :]
    pieces, tokens, many = [], [], []
    at = 0
    while at < len(ids):
        begin = int(stops[at] - sizes[at])
        stop = max(at + 1, int(np.searchsorted(stops, begin + PIECE, side="right")))
        codes, length, hashes, bounds = predicted(Texts.of(np.concatenate([[0], stops[at:stop] - begin]), data[begin : stops[stop - 1]]), splitter)
        unique, place = np.unique(codes, return_inverse=True)
        pieces.append((unique, place.astype(np.uint32), np.concatenate([[0], np.cumsum(length)[:-1]])))
        tokens.append(np.insert(hashes, bounds[1:], end_key(splitter)))
        many.append(np.diff(bounds) + 1)
        at = stop
    every = np.unique(np.concatenate([p[0] for p in pieces]))
    prices = np.empty(len(every))
    prices[dealt(every, parts)[0]] = price
    # Every text has its end, so no sum is over nothing.
    score = [np.add.reduceat(prices[np.searchsorted(every, unique)][place], first) for unique, place, first in pieces]
    return ids, np.concatenate(many), np.unique(np.concatenate(tokens), return_inverse=True)[1], np.concatenate(score)


def texts_scored(parts: int, tokens: int, distinct: int):
    """The texts of a slice and the answers of all buckets -> scores."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        given = table.to_pylist()
        pieces = {r["other"]: r for r in given if r["kind"] == ANSWERS}  # equal slices ask twice and get the same answer
        answers = [pieces[b] for b in sorted(pieces)]
        price = np.concatenate([unpack(released(r["runs"]), np.float32)[0] for r in answers])
        counts = np.concatenate([unpack(released(r["words"]), np.int64)[0] for r in answers])
        base = np.log10((counts + 0.5) / (tokens + 0.5 * (distinct + 1)))
        out = []
        for r in given:
            if r["kind"] == TEXTS:
                ids, many, place, score = bytes_scored(released(r["runs"]), price, parts)
                owner = np.repeat(np.arange(len(ids)), many)
                known = np.bincount(owner, weights=counts[place] > 0, minlength=len(ids)).astype(np.int64)
                out.append([ids, many, known, np.full(len(ids), tokens), np.bincount(owner, weights=base[place], minlength=len(ids)), score])
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4 + [np.empty(0)] * 2
        return pa.table([pa.array(c) for c in columns], ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def scored(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) for every row with an id.

    The model learns from the rows where `train` is true (null: not). Tokens are words (anything but the six ASCII
    white-space characters, A-Z in lower case) and one end for each text; a null or empty text is only its end.
    base_score sums log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens; n_known counts those with c > 0; score is the
    model's log10 probability of the bytes of the tokens, each byte's rounded to single precision. All training rows
    count whole; without any training row all bytes are alike. Ids are integers, rows with a null id are not scored but
    teach like others; repeated rows are scored alike, and each teaches. Other columns are not returned.
    """
    spark = docs.sparkSession
    named = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    parts = buckets(spark, named.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    parsed = stored(named.mapInArrow(counted(parts), ROW_SQL), "byte-runs", by="kind")
    asked = parsed.where(F.col("kind") == ASKED).repartitionById(parts, F.col("place").cast("int"))
    about = stored(asked.mapInArrow(summaries, ROW_SQL), "byte-counts", by="kind")
    found = about.where(F.col("kind") == TOTALS).select("runs").collect()  # a few numbers from each bucket
    numbers = sum((np.frombuffer(r["runs"], np.int64) for r in found), np.zeros(2 + 4 * (DEPTH + 1 - NEAR), np.int64))
    tokens, distinct = int(numbers[0]), int(numbers[1])
    # At most 256^3 counts: contexts of under NEAR bytes.
    short = about.where(F.col("kind") == LOW).coalesce(16).mapInArrow(low_added, ROW_SQL)
    (one,) = short.repartition(1).mapInArrow(low_added, ROW_SQL).collect()
    low = tuple(unpack(released(one["runs"]), np.uint64, np.int64))
    spreads = [spread(counts) for _, counts in (levels(*low, NEAR - 1, 0)[k] for k in range(NEAR))]
    taken = [discounts(n) for n in [*spreads, *numbers[2:].reshape(-1, 4)]]
    answers = asked.mapInArrow(answered(spark.sparkContext.broadcast((low, taken))), ROW_SQL)
    texts = parsed.where(F.col("kind") == TEXTS).unionByName(answers)
    result = texts.groupBy("place").applyInArrow(texts_scored(parts, tokens, distinct), SCORES)
    return result.where(F.col("id") != F.lit(-(2**63))).withColumnRenamed("id", id_col)
