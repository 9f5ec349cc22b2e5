"""Vectorised words and rolling hashes over Arrow batches of documents.

Words are maximal runs of bytes other than space and 0x09-0x0D. All hashes are
64-bit: a polynomial over random byte values (words) or over word hashes
(windows), taken modulo 2**64 and finalised by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
_CHUNK = 1 << 16
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalising bit mixer (splitmix64)."""
    z = x + _U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    z ^= z >> _U(30)
    z *= _U(0xBF58476D1CE4E5B9)
    z ^= z >> _U(27)
    z *= _U(0x94D049BB133111EB)
    z ^= z >> _U(31)
    return z


_BYTE = mix(np.arange(256, dtype=_U), 11)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_pow: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if not _pow or len(_pow[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        _pow[:] = []
        for b in (_BASE, inverse):
            p = np.full(size, _U(b))
            p[0] = 1
            _pow.append(np.multiply.accumulate(p))
    return _pow[0][:n], _pow[1][:n]


@dataclass
class Words:
    """Words of some documents: document j owns words[offsets[j]:offsets[j+1]]."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    def last(self) -> np.ndarray:
        """For each word, the end offset of its document."""
        return np.repeat(self.offsets[1:], np.diff(self.offsets))


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    """Tokenise documents; per-byte work is done in chunks of about 64 KB, whose numbers fit a cache."""
    data = b"\n".join(texts)
    buf = np.frombuffer(data, dtype=np.uint8)
    table = _LOWER if lower else _BYTE
    starts, ends, hashes = [], [], []
    at, n = 0, len(buf)
    while at < n:
        to = min(at + _CHUNK, n)
        while to < n and not _WS[buf[to - 1]]:  # end a chunk behind white space
            more = np.flatnonzero(_WS[buf[to : to + _CHUNK]])
            to = to + int(more[0]) + 1 if len(more) else min(to + _CHUNK, n)
        part = buf[at:to]
        white = (part == 32) | (part - np.uint8(9) < 5)
        edge = np.diff(np.concatenate(([True], white, [True])).view(np.int8))
        s, e = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        p, ip = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=_U)
        np.cumsum(np.take(table, part, mode="clip") * p[:-1], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * ip[s] + (e - s).astype(_U)))
        starts.append(s + at)
        ends.append(e + at)
        at = to
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, dtype=t)
    starts = cat(starts, np.int64)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(data, starts, cat(ends, np.int64), cat(hashes, _U), np.searchsorted(starts, first))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values, wherever they start; len(h)-k+1 of them."""
    if len(h) < k:
        return np.zeros(0, dtype=_U)
    if k <= 8:
        out = h[: len(h) - k + 1].copy()
        for j in range(1, k):
            out *= _U(_BASE)
            out += h[j : len(h) - k + 1 + j]
        return mix(out)
    return spans(h, np.arange(len(h) - k + 1), np.full(len(h) - k + 1, k), prefix(h))


def prefix(h: np.ndarray) -> np.ndarray:
    total = np.zeros(len(h) + 1, dtype=_U)
    np.cumsum(h * powers(len(h))[0], out=total[1:])
    return total


def spans(h: np.ndarray, starts: np.ndarray, lengths: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Hash of each span of values; equal spans of equal length have equal hashes."""
    ip = powers(len(h) + 1)[1]
    return mix((total[starts + lengths] - total[starts]) * ip[starts], 3) ^ mix(lengths.astype(_U), 5)


def minimum_of(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    out, have = h, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = w - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def texts_in(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    col = batch.column(batch.schema.get_field_index(name))
    return [t or b"" for t in col.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes together, one document at least."""
    i = size = 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
