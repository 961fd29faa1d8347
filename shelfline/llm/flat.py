"""Texts of an Arrow batch as flat numpy arrays.

The Python operators of this package work on bytes: a chunk of texts is one ``uint8`` array, tokens are
(start, end) pairs in it, and every token has a 64-bit hash read off a prefix polynomial, so no Python string
is made per token. Chunks are cut at document borders near ``CHUNK`` bytes, which bounds the temporary arrays.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C55)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (``--py-files`` does so on a cluster)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        out = []
        for base in (_BASE, _BASE_INV):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers = (out[0], out[1])
    return _powers


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ascending byte ranges ``data[start:end]``, in blocks of bounded size."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, lo + CHUNK, side="right")))
        hi = int(ends[at:stop].max())
        p, inv = _power_tables(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        block = data[lo:hi].astype(np.uint64)
        block += np.uint64(1)
        block *= p[: hi - lo]
        np.cumsum(block, out=sums[1:])
        s, e = starts[at:stop] - lo, ends[at:stop] - lo
        out[at:stop] = (sums[e] - sums[s]) * inv[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        at = stop
    return mix(out)


@dataclass
class Chunk:
    """Documents ``first .. first + n - 1`` of a batch: their bytes and the bounds of each document."""

    first: int
    data: np.ndarray
    bounds: np.ndarray  # n + 1 byte positions

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each document."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    """The texts of an Arrow string column, null as empty, in chunks of whole documents."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        stop = min(stop, len(texts))
        yield Chunk(at, data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at])
        at = stop


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of true bytes; runs never cross a document border."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[1:n] = inside[1:] != inside[:-1]
    edge[0] = edge[n] = True
    edge[bounds] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = inside[starts] if n else np.zeros(len(starts), bool)
    return starts[keep], ends[keep]


def doc_of(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, starts, side="right") - 1


def ngrams(hashes: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and documents of the windows of ``n`` consecutive tokens that stay inside one document."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[i : i + count]
    keep = docs[:count] == docs[n - 1 :]
    return mix(out[keep]), docs[:count][keep]


def first_of_doc(docs: np.ndarray) -> np.ndarray:
    """Positions at which a new document begins in an ascending array of document numbers."""
    return np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
