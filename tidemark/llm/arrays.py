"""Words, n-grams and hashes of whole Arrow batches of texts, as numpy arrays.

A word is a run of bytes other than the six ASCII white-space bytes. These bytes never occur inside a
multi-byte UTF-8 character, so words can be cut on bytes. Word hashes are 64-bit polynomial hashes read from
one running sum, and hashes of n consecutive words are built from them in the same way, so the cost is a few
passes over the bytes whatever n is. Modulo 2**64 such a hash has equal values for long words of a certain build,
whatever its base; words beyond LONG bytes are therefore hashed by xxhash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tidemark.llm.shipping import shipped

shipped(__name__)

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
CHUNK = 1 << 20  # bytes handled at a time
LONG = 64  # bytes; words of this build that differ but have equal polynomial hashes have 1024 bytes or more


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """n fixed 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 2 + 1))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


class Powers:
    """Powers of an odd base and of its inverse, extended when a longer text asks for it."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.empty(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            self.up, self.down = powers(self.base, size), powers(self.inverse, size)
        return self.up[:n], self.down[:n]


class Texts:
    """The bytes and offsets of a column of strings; null counts as empty."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
            if isinstance(column, pa.ChunkedArray):  # combined pieces of over 2 GB stay apart
                column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks])
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, offsets, data = column.buffers()
        self.offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)

    @classmethod
    def of(cls, offsets: np.ndarray, data: np.ndarray) -> Texts:
        texts = cls.__new__(cls)
        texts.offsets, texts.data = offsets, data
        return texts

    def __len__(self) -> int:
        return len(self.offsets) - 1


class Words:
    """Splits texts into words and hashes them."""

    def __init__(self, lower: bool, seed: int = 1):
        table = constants(seed, 256)
        table[list(SPACES)] = 0
        if lower:
            table[65:91] = table[97:123]
        self.table, self.powers = table, Powers(int(constants(seed + 100, 1)[0]))
        self.lower, self.seed = lower, seed

    def hashes(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, index of the first word of each text and the end)."""
        hashes, bounds, _, _ = self.located(texts)
        return hashes, bounds

    def located(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """hashes() with the first byte of each word and the byte after it."""
        none = np.empty(0, np.int64)
        parts, begins, finishes, counts = [np.empty(0, np.uint64)], [none], [none], np.zeros(len(texts) + 1, np.int64)
        for first, last, starts, ends, base in self.spans(texts):
            if len(starts):
                chunk = texts.data[base[0] : base[1]]
                up, down = self.powers.get(len(chunk) + 1)
                run = np.zeros(len(chunk) + 1, np.uint64)
                np.cumsum(self.table[chunk] * up[:-1], out=run[1:])
                parts.append(mixed((run[ends] - run[starts]) * down[starts]))
                for i in np.flatnonzero(ends - starts > LONG):
                    word = chunk[starts[i] : ends[i]].tobytes()
                    parts[-1][i] = xxhash.xxh64_intdigest(word.lower() if self.lower else word, self.seed)
                begins.append(starts + base[0])
                finishes.append(ends + base[0])
                at = np.searchsorted(texts.offsets[first + 1 : last + 1], begins[-1], side="right") + first
                counts[1:] += np.bincount(at, minlength=len(texts))
        return np.concatenate(parts), np.cumsum(counts), np.concatenate(begins), np.concatenate(finishes)

    def spans(self, texts: Texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, tuple[int, int]]]:
        """Chunks of about a megabyte, cut at white space or between texts: (first text, text after the last, word
        starts, word ends, (chunk start, chunk end)); starts and ends count from the chunk's start."""
        offsets, data = texts.offsets, texts.data
        at, end = int(offsets[0]), int(offsets[-1])
        space = np.zeros(256, bool)
        space[list(SPACES)] = True
        while at < end:
            stop = min(at + CHUNK, end)
            while stop < end and not space[data[stop]]:  # to the next white space or the next text
                nearest = int(offsets[np.searchsorted(offsets, stop, side="left")])
                piece = data[stop : min(nearest, stop + CHUNK)]
                hit = np.flatnonzero(space[piece])
                stop = stop + int(hit[0]) if len(hit) else stop + len(piece)
                if stop == nearest:
                    break
            first = int(np.searchsorted(offsets, at, side="right")) - 1
            last = int(np.searchsorted(offsets, stop, side="left"))
            inside = np.zeros(stop - at + 2, bool)
            inside[1:-1] = ~space[data[at:stop]]
            begin, finish = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
            borders = offsets[first + 1 : last]
            borders = borders[(borders > at) & (borders < stop)] - at
            touching = borders[inside[borders] & inside[borders + 1]]  # two texts without white space between them
            begin[touching], finish[touching] = True, True
            yield first, last, np.flatnonzero(begin), np.flatnonzero(finish), (at, stop)
            at = stop


class Runs:
    """Hashes of n consecutive words."""

    def __init__(self, seed: int = 7):
        self.powers = Powers(int(constants(seed, 1)[0]))

    def hashes(self, words: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n words from each position on; one for each position that has n words after it in the array."""
        if len(words) < n:
            return np.empty(0, np.uint64)
        up, down = self.powers.get(len(words))
        run = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up, out=run[1:])
        return mixed((run[n:] - run[:-n]) * down[: len(words) - n + 1] + np.uint64(n))


def within(bounds: np.ndarray, n: int) -> np.ndarray:
    """True at the positions from which n words stay inside one text; bounds: first word of each text, and the end."""
    total = int(bounds[-1])
    room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(total)
    return room >= n


def slices(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Whole rows with about `limit` bytes of text, so that memory does not follow the size of the batch."""
    offsets = Texts(batch.column(column)).offsets
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop
    pa.default_memory_pool().release_unused()  # idle workers keep less


def planes(values: np.ndarray) -> bytes:
    """The bytes of integers, lowest bytes first and together: the high ones compress to nothing."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(blob: memoryview, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8, n * size).reshape(size, n).T).view(kind).ravel()


def steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def pack(*columns: np.ndarray) -> bytes:
    head = np.array([len(columns[0])], np.int64).tobytes()
    return head + b"".join(planes(np.ascontiguousarray(c)) for c in columns)


def unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(blob, np.int64, 1)[0]), 8, []
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(from_planes(memoryview(blob)[at : at + size], kind, n))
        at += size
    return out


def scaled(keys: np.ndarray, parts: int) -> np.ndarray:
    """bucket << 32 | place in the bucket, in the order of the keys."""
    return (keys >> np.uint64(32)) * np.uint64(parts)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
