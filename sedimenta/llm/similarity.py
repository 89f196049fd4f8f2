"""What the similarity operators share: text classes, hot buckets, exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

U64 = np.uint64


def classes_of(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Class number and shingle count of each of ``n`` documents; (doc, h) distinct and sorted.

    Texts with the same set of shingles share a class: their overlap is 1, so
    one of them stands for all. The class is a 64-bit hash of the set; among
    10**8 different texts about 3 in 10,000 runs see one collision.
    """
    docs, at = K.starts(doc)
    count = np.bincount(doc, minlength=n) if len(doc) else np.zeros(n, np.int64)
    cls = np.zeros(n, U64)
    if len(docs):
        cls[docs] = K.mix(np.add.reduceat(K.mix(h ^ U64(0x5851F42D4C957F2D)), at) + count[docs].astype(U64))
    return cls.view(np.int64), count


def bucket_pairs(key: np.ndarray, cls: np.ndarray, hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of different classes inside the small runs of equal keys, and the positions of rows in hot runs.

    Both arrays are sorted by key, then class, and hold each combination once.
    Returns (a, b, positions in hot runs, their rank inside the run).
    """
    if not len(key):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    out_a, out_b = [], []
    for m in np.unique(size[(size > 1) & (size <= hot)]):
        at = first[size == m]
        i, j = np.triu_indices(int(m), 1)
        step = max(1, (1 << 20) // len(i))
        for k in range(0, len(at), step):
            out_a.append(cls[(at[k : k + step, None] + i).ravel()])
            out_b.append(cls[(at[k : k + step, None] + j).ravel()])
    big = size > hot
    pos = np.flatnonzero(np.repeat(big, size))
    rank = pos - np.repeat(first[big], size[big]) if len(pos) else pos
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return cat(out_a), cat(out_b), pos, rank


def pair_buckets(hot: int):
    """A mapInArrow function over rows (key, cls) sorted by both, split by key.

    Emits (a, b, key, block): a pair of classes, or, where a bucket holds more
    than ``hot`` classes, b null and the row's key and block of ``hot`` classes.
    Only one run of at most ``hot`` rows is held; longer ones stream through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cls = np.zeros(0, np.int64), np.zeros(0, np.int64)
        gone = 0  # rows of the run at the front that were already emitted as hot

        def emit(key, cls, offset):
            """offset: rank of the first row in its run."""
            hot_rows: list[tuple] = []
            if offset:  # the front run is hot: its rows leave at once
                end = int(np.argmax(key != key[0])) if (key != key[0]).any() else len(key)
                hot_rows.append((key[:end], cls[:end], (np.arange(end) + offset) // hot))
                key, cls = key[end:], cls[end:]
            a, b, pos, rank = bucket_pairs(key, cls, hot)
            if len(pos):
                hot_rows.append((key[pos], cls[pos], rank // hot))
            for i in range(0, len(a), 1 << 16):
                n = len(a[i : i + (1 << 16)])
                yield pa.record_batch([pa.array(a[i : i + n]), pa.array(b[i : i + n]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], ["a", "b", "key", "block"])
            for k, c, r in hot_rows:
                if len(k):
                    yield pa.record_batch([pa.array(c), pa.nulls(len(c), pa.int64()), pa.array(k), pa.array(r.astype(np.int64))], ["a", "b", "key", "block"])

        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            c = batch.column(1).to_numpy(zero_copy_only=False)
            key, cls = np.r_[key, k], np.r_[cls, c]
            new = np.r_[True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])]
            key, cls = key[new], cls[new]
            if not len(key):
                continue
            last = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])  # the last run may go on
            if last:
                yield from emit(key[:last], cls[:last], gone)
                key, cls, gone = key[last:], cls[last:], 0
            # a run that is already too long leaves, but for its last row (to see repeats)
            if len(key) + gone > hot and len(key) > 1:
                if not gone and len(key) <= hot:
                    continue
                n = len(key) - 1
                yield pa.record_batch([pa.array(cls[:n]), pa.nulls(n, pa.int64()), pa.array(key[:n]), pa.array((np.arange(n) + gone) // hot)], ["a", "b", "key", "block"])
                key, cls, gone = key[n:], cls[n:], gone + n
        if len(key):
            yield from emit(key, cls, gone)

    return run


def verified(pairs: DataFrame, text_a: str, text_b: str, shingle: int, threshold: float, keep: list[str]) -> DataFrame:
    """The pairs whose texts overlap by at least the threshold, with the exact overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                j = K.jaccard(part.column(part.schema.get_field_index(text_a)), part.column(part.schema.get_field_index(text_b)), shingle)
                ok = np.flatnonzero(j >= threshold - 1e-12)
                if len(ok):
                    cols = [part.column(part.schema.get_field_index(c)).take(pa.array(ok)) for c in keep]
                    yield pa.record_batch([*cols, pa.array(j[ok])], [*keep, "overlap"])

    schema = ", ".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in keep) + ", overlap double"
    return pairs.select(*keep, text_a, text_b).mapInArrow(run, schema)


def ordered(a: F.Column, b: F.Column) -> list[F.Column]:
    return [F.least(a, b), F.greatest(a, b)]


def meet_buckets(hot: int, radius: int, at_once: int = 1 << 17):
    """A mapInArrow function over rows (key, class, f0, f1) sorted by key, split by key >> 1; the lowest bit of a key is its side.

    Emits (a, b): class a of side 1 and class b of side 0 that share a bucket
    and whose words f0 and f1 differ in at most ``radius`` bits. Where a bucket
    holds more than ``hot`` rows of side 0, they leave in blocks of ``hot``, and
    so do the rows of side 1 that asked for them; key, block, side and the words
    are set then, and the squares are to be compared elsewhere. At most ``hot``
    rows and a batch are held.
    """
    names = ["a", "b", "key", "block", "side", "f0", "f1"]
    kinds = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 2

    def table(n: int, **columns) -> pa.RecordBatch:
        return pa.record_batch([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4  # rows of side 0 of the last bucket
        bucket, gone, asked = -1, 0, 0  # the last bucket, and its rows of either side that left as blocks

        for batch in batches:
            rows = [np.r_[x, batch.column(i).to_numpy(zero_copy_only=False)] for i, x in enumerate(held)]
            if not len(rows[0]):
                continue
            key, cls, f0, f1 = rows
            own, side = key >> 1, key & 1
            filed, probe = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            low = np.searchsorted(own[filed], own[probe], "left")
            many = np.searchsorted(own[filed], own[probe], "right") - low
            # rows of side 0 sort before those of side 1: all that a probe can meet, and did not leave, is here
            total = np.cumsum(many)
            i = 0
            while i < len(probe):
                j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + at_once, "right")))
                n = many[i:j]
                x = np.repeat(probe[i:j], n)
                y = filed[np.repeat(low[i:j] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))]
                apart = np.bitwise_count((f0[x] ^ f0[y]).view(U64)) + np.bitwise_count((f1[x] ^ f1[y]).view(U64))  # of signed numbers it counts the absolute value
                ok = apart <= radius
                if ok.any():
                    yield table(int(ok.sum()), a=cls[x[ok]], b=cls[y[ok]])
                i = j
            if gone:  # probes of the bucket whose first rows left
                late = probe[own[probe] == bucket]
                if len(late):
                    yield table(len(late), a=cls[late], key=own[late], block=(np.arange(len(late)) + asked) // hot, side=np.ones(len(late), np.int32), f0=f0[late], f1=f1[late])
                    asked += len(late)
            if own[-1] != bucket:
                bucket, gone, asked = int(own[-1]), 0, 0
            last = filed[own[filed] == bucket]
            if len(last) > hot:
                n = len(last) - len(last) % hot
                out, last = last[:n], last[n:]
                yield table(n, b=cls[out], key=own[out], block=(np.arange(n) + gone) // hot, side=np.zeros(n, np.int32), f0=f0[out], f1=f1[out])
                # probes of the bucket in this batch have met these rows already
                gone += n
            held = [x[last] for x in rows]

    return run
