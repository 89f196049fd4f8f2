"""Vectorised text kernels over Arrow string buffers.

Texts never become Python strings here: the UTF-8 buffer of an Arrow column is
classified, hashed and segmented with whole-array numpy operations. Input is
cut at document borders into pieces of about ``PIECE`` bytes, so memory follows
the piece (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _lut() -> np.ndarray:
    """Byte -> lower-case byte for ASCII letters, digits and underscore; else 0."""
    lut = np.zeros(256, np.uint8)
    for c in range(128):
        ch = chr(c)
        if ch.isalnum() or ch == "_":
            lut[c] = ord(ch.lower())
    return lut


_LUT = _lut()
_CHAR = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_BASE = 0xD6E8FEB86659FD93
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get("up")
    if have is None or len(have) <= n:
        size = max(n + 1, 4 * PIECE + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, U64)
            p[0] = 1
            _POW[name] = np.cumprod(p, dtype=U64)
        if size > 16 * PIECE:  # one very long word: its tables are not kept
            return _POW.pop("up"), _POW.pop("down")
    return _POW["up"], _POW["down"]


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n+1, int64) and bytes of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    if col.null_count:
        col = col.fill_null("")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if off is not None else np.zeros(len(col) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, raw


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes, or of a single longer one."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of every word, in order.

    A word is a maximal run of ASCII letters, digits and underscore, lower-cased.
    ``offsets`` select the documents; numbers count from 0 within them. Long
    ranges are hashed stretch by stretch, cut between words, so that working
    memory follows the stretch.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    docs, hashes = [], []
    while lo < hi:
        end = min(hi, lo + 4 * PIECE)
        while end < hi and _LUT[raw[end]] and _LUT[raw[end - 1]]:
            ahead = np.flatnonzero(_LUT[raw[end : end + PIECE]] == 0)
            end = min(hi, end + (int(ahead[0]) if len(ahead) else PIECE))
        s, h = _stretch(raw[lo:end], offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, end, side="right")] - lo)
        docs.append(np.searchsorted(offsets, s + lo, side="right") - 1)
        hashes.append(h)
        lo = end
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(docs), np.concatenate(hashes)


def _stretch(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of the words of some bytes; words also end at the borders."""
    n = len(raw)
    c = _LUT[raw]
    inside = c != 0
    border = np.zeros(n + 1, bool)
    border[borders[borders <= n]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | border[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | border[1:-1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(n)
    acc = np.zeros(n + 1, U64)
    np.cumsum(_CHAR[c] * up[:n], out=acc[1:])
    return s, mix((acc[e] - acc[s]) * down[s] + (e - s).astype(U64))


def shingles(doc: np.ndarray, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of every run of ``k`` words inside one document."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(k):
        out = out * U64(0x9FB21C651E98DF25) + h[i : i + n]
    keep = doc[:n] == doc[k - 1 :]
    return doc[:n][keep], mix(out[keep])


def distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (document, hash) once each, sorted by document, then hash."""
    if not len(h):
        return doc, h
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def starts(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents that occur in the sorted ``doc`` and where each begins."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    return doc[at], at


def jaccard(a: pa.Array, b: pa.Array, k: int) -> np.ndarray:
    """Overlap of the distinct k-word runs of two columns of texts, row by row; 0 if either has none."""
    out = np.zeros(len(a))
    (oa, ra), (ob, rb) = buffers(a), buffers(b)
    for i, j in pieces(oa + ob):
        da, ha = distinct(*shingles(*words(oa[i : j + 1], ra), k))
        db, hb = distinct(*shingles(*words(ob[i : j + 1], rb), k))
        n = j - i
        doc, h = np.r_[da, db], np.r_[ha, hb]
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        same = (doc[1:] == doc[:-1]) & (h[1:] == h[:-1])
        both = np.bincount(doc[1:][same], minlength=n)
        either = np.bincount(da, minlength=n) + np.bincount(db, minlength=n) - both
        out[i:j] = both / np.maximum(either, 1)
    return out
