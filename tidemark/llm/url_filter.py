"""URL rules in a sorted digest array.

Rules are (action, host, path) with a host that holds for all its subdomains and a path prefix. The 64-bit
xxhash of each rule's text is kept in one sorted array on disk, which tasks memory-map. Each url offers its host
suffixes, each joined with the path prefixes of the lengths that rules of that host have; a vectorised binary
search finds equal digests, and the stored rule text confirms the hit, so a collision decides nothing.
"""

from __future__ import annotations

import os
import pickle
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shipping import shipped

shipped(__name__)

MOST_RULES = 5_000_000  # a list of rules is shipped to the executors up to this size


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


class DigestArray:
    """Sorted digests with the full strings behind them, in one file."""

    def __init__(self, path: str):
        with open(path, "rb") as source:
            self.strings, self.values = pickle.load(source)
            at = source.tell()
        n = len(self.strings)
        self.keys = np.memmap(path, np.uint64, "r", at, (n,)) if n else np.empty(0, np.uint64)

    @staticmethod
    def write(path: str, entries: dict[str, object]) -> None:
        ordered = sorted(entries.items(), key=lambda e: (digest(e[0]), e[0]))
        with open(path, "wb") as out:
            pickle.dump(([s for s, _ in ordered], [v for _, v in ordered]), out)
            out.write(np.array([digest(s) for s, _ in ordered], np.uint64).tobytes())

    def find(self, texts: Sequence[str]) -> list[object | None]:
        """The value stored with each text, or None."""
        out: list[object | None] = [None] * len(texts)
        if not len(self.keys) or not texts:
            return out
        keys = np.fromiter((digest(t) for t in texts), np.uint64, len(texts))
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(low < high):
            for at in range(low[i], high[i]):  # over one only where digests collide
                if self.strings[at] == texts[i]:
                    out[i] = self.values[at]
        return out


_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first :// up to / ? # or the end, A-Z in lower case; then up to ? # or the end."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    tail = rest[cut:]
    stop = min((at for at in map(tail.find, "?#") if at >= 0), default=len(tail))
    return rest[:cut].translate(_UPPER), tail[:stop]


def suffixes(host: str) -> list[str]:
    """The host and all domains above it, longest first."""
    found = [host]
    while "." in host:
        host = host.split(".", 1)[1]
        found.append(host)
    return found


def judge(urls: Sequence[str | None], rules: DigestArray, hosts: DigestArray, otherwise: str) -> dict[str, list]:
    """host, path, rule and verdict of each url; the longest rule text that fits wins, then the longer host."""
    split = [split_url(u) for u in urls]
    probes = [(i, s) for i, (host, _) in enumerate(split) if host for s in suffixes(host)]
    lengths = hosts.find([s for _, s in probes])
    tries = [
        (i, s, s + split[i][1][:size])
        for (i, s), sizes in zip(probes, lengths) if sizes
        for size in sizes if size <= len(split[i][1])
    ]
    best: dict[int, tuple[int, int, str, str]] = {}
    for (i, host, text), found in zip(tries, rules.find([t for _, _, t in tries])):
        if found is None or host not in found:
            continue
        key = (len(text), len(host), text, found[host])
        if i not in best or key[:2] > best[i][:2]:
            best[i] = key
    hits = [best.get(i) for i in range(len(urls))]
    return {
        "host": [h for h, _ in split],
        "path": [p for _, p in split],
        "rule": [h[2] if h else None for h in hits],
        "verdict": [h[3] if h else otherwise for h in hits],
    }


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
    otherwise: str = "allow", most: int = MOST_RULES,
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row, repeated rows included.

    rules: (action, host, path); the host is lower-cased, an empty path fits every path. Two actions for the same
    host and path: the last one holds. A null url, or one without ://, has an empty host and path, no rule and the
    verdict `otherwise`, which a url gets that no entry of the array fits. Other columns are not returned. A list
    of over `most` rules is refused: its size is the bound of what each executor keeps.
    """
    if len(rules) > most:
        raise ValueError(f"{len(rules)} rules are more than the {most} that may be shipped to executors")
    texts: dict[str, dict[str, str]] = {}
    sizes: dict[str, set[int]] = {}
    for action, host, path in rules:
        host = host.translate(_UPPER)
        texts.setdefault(host + path, {})[host] = action
        sizes.setdefault(host, set()).add(len(path))
    context = pages.sparkSession.sparkContext
    names = [f"rules-{uuid.uuid4().hex}", f"hosts-{uuid.uuid4().hex}"]
    folder = tempfile.mkdtemp(prefix="rules-")  # on the driver; addFile hands copies to the executors
    for name, entries in zip(names, (texts, {h: sorted(s, reverse=True) for h, s in sizes.items()})):
        DigestArray.write(os.path.join(folder, name), entries)
        context.addFile(os.path.join(folder, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [DigestArray(SparkFiles.get(name)) for name in names]
        for batch in batches:
            found = judge(batch.column(1).to_pylist(), *both, otherwise)
            columns = [pa.array(found[c], pa.string()) for c in ("host", "path", "rule", "verdict")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "host", "path", "rule", "verdict"])

    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    kind = given.schema["id"].dataType.simpleString()
    result = given.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string")
    return result.withColumnRenamed("id", id_col)
