"""Near-duplicate records with small edits: b-bit MinHash over banded candidates.

Plan, by stage (N records, C classes of equal shingle sets):

1. one narrow pass over the texts makes, for every record with enough words,
   its class, ``bands`` bucket keys and the low two bits of ``perms`` minima,
   packed bit by bit into longs; written once to the shared folder;
2. (key, class) rows are hash-partitioned by key and sorted; one streaming pass
   emits the pairs of classes of each bucket. Copies fall together in the sort,
   so a text held by a third of all rows costs one row. Buckets with more than
   ``hot`` classes are cut into blocks, and block pairs are compared on packed
   signatures in separate tasks: no task ever holds a bucket, none is dropped;
3. distinct candidates join the packed signatures; equal bits are counted with
   ``bit_count`` inside whole-stage codegen, corrected for chance agreement;
4. what may reach the threshold is checked on the texts themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import Scratch
from . import kernel as K
from .similarity import classes_of, pair_buckets, verified

U64 = np.uint64
PLANES = 2  # b: low bits kept of each minimum


@dataclass
class NearDuplicates:
    """links(a, b, overlap): pairs of classes, a < b; members(id, class); both written tables."""

    links: DataFrame
    members: DataFrame
    scratch: Scratch

    def pairs(self) -> DataFrame:
        """(id_a, id_b), all pairs of different records, smaller first: across linked classes and inside one class."""
        m = self.members
        inside = m.alias("x").join(m.alias("y"), F.col("x.class") == F.col("y.class")).where(F.col("x.id") < F.col("y.id")).select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
        left = self.links.join(m.select(F.col("class").alias("a"), F.col("id").alias("ia")), "a")
        both = left.join(m.select(F.col("class").alias("b"), F.col("id").alias("ib")), "b")
        across = both.select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))
        return inside.unionByName(across)

    def groups(self) -> DataFrame:
        """(id, copy_of, n_links, group): one row per record that has a near-duplicate or a copy.

        copy_of is the smallest id with the same shingle set (a class), n_links
        counts the classes linked to it, group is the smallest id that links reach.
        """
        m = self.members
        degree = self.links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("n_links"))
        comp = components(self.links.select("a", "b"), self.scratch, "near")
        classes = m.groupBy("class").agg(F.min("id").alias("copy_of"), F.count("*").alias("copies"))
        classes = classes.join(degree, "class", "left").where("copies > 1 or n_links is not null")
        classes = classes.join(comp.select(F.col("node").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
        first = classes.groupBy("root").agg(F.min("copy_of").alias("group"))
        named = classes.join(first, "root").select("class", "copy_of", F.coalesce("n_links", F.lit(0)).alias("n_links"), "group")
        return m.join(named, "class").select("id", "copy_of", "n_links", "group")


def _sketcher(shingle: int, min_words: int, bands: int, rows: int):
    perms = bands * rows
    seed = K.mix(np.arange(1, 2 * perms + 1, dtype=U64) * U64(0xA0761D6478BD642F))
    mul, add = seed[:perms] | U64(1), seed[perms:]
    longs = -(-perms // 64)

    def sketch(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        docs, at = K.starts(doc)
        minima = np.empty((perms, len(docs)), U64)
        buf = np.empty_like(h)
        for p in range(perms):
            np.multiply(h, mul[p], out=buf)
            np.add(buf, add[p], out=buf)
            minima[p] = np.minimum.reduceat(buf, at)
        minima = K.mix(minima)
        key = np.zeros((bands, len(docs)), U64)
        for r in range(rows):
            key = key * U64(0x9FB21C651E98DF25) + minima[r * bands : (r + 1) * bands]
        key = K.mix(key ^ (np.arange(bands, dtype=U64) * U64(0x8CB92BA72F3D8DD7))[:, None])
        planes = []
        for b in range(PLANES):
            bits = ((minima >> U64(b)) & U64(1)).astype(np.uint8)
            pad = np.zeros((longs * 64 - perms, len(docs)), np.uint8)
            packed = np.packbits(np.vstack([bits, pad]), axis=0)
            planes += [np.ascontiguousarray(packed[8 * i : 8 * i + 8].T).view(np.int64).ravel() for i in range(longs)]
        return docs, key, planes

    names = [f"s{i}" for i in range(PLANES * longs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            off, raw = K.buffers(texts)
            for i, j in K.pieces(off):
                doc, h = K.words(off[i : j + 1], raw)
                enough = np.bincount(doc, minlength=j - i) >= max(min_words, shingle)
                doc, h = K.shingles(doc, h, shingle)
                ok = enough[doc]
                doc, h = K.distinct(doc[ok], h[ok])
                if not len(doc):
                    continue
                cls, _ = classes_of(doc, h, j - i)
                docs, key, planes = sketch(doc, h)
                flat = pa.array(np.ascontiguousarray(key.T).view(np.int64).ravel())
                keys = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), flat)
                yield pa.record_batch([ids.take(pa.array(docs + i)), pa.array(cls[docs]), keys, *map(pa.array, planes)], ["id", "class", "keys", *names])

    return run, names


def _agreement(x: str, y: str, names: list[str], perms: int) -> F.Column:
    """Similarity estimated from the packed bits of two sides, corrected for chance agreement (2**-b)."""
    half = len(names) // PLANES
    same = F.lit(0)
    for i in range(half):
        differ = F.lit(0).cast("long")
        for p in range(PLANES):
            n = names[p * half + i]
            differ = differ.bitwiseOR(F.col(f"{x}.{n}").bitwiseXOR(F.col(f"{y}.{n}")))
        same = same + (F.lit(64) - F.bit_count(differ))
    pad = half * 64 - perms
    chance = 2.0**-PLANES
    return ((same - pad) / F.lit(float(perms)) - chance) / (1 - chance)


def near_duplicates(
    df: DataFrame,
    id_col: str,
    text_col: str,
    *,
    shingle: int = 5,
    threshold: float = 0.8,
    min_words: int = 5,
    bands: int = 48,
    rows: int = 4,
    sigmas: float = 4.0,
    hot: int = 2048,
    scratch: Scratch | None = None,
) -> NearDuplicates:
    """Link records whose distinct ``shingle``-word runs overlap by at least ``threshold``.

    Defined results: a null or empty text, or one with fewer than ``min_words``
    words, has no links and is no member; rows with a null id are left out;
    repeated rows of one id count once; an empty table gives empty tables;
    further columns of ``df``, whatever their names, are not read. A pair at
    overlap s is found with probability 1 - (1 - s**rows)**bands.
    """
    scratch = scratch or Scratch(df.sparkSession, "near")
    base = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull())
    run, names = _sketcher(shingle, min_words, bands, rows)
    id_type = base.schema["id"].dataType.simpleString()
    sketches = scratch.write(base.mapInArrow(run, f"id {id_type}, class bigint, keys array<bigint>, " + ", ".join(f"{n} bigint" for n in names)), "sketches")

    spread = sketches.select(F.explode("keys").alias("key"), "class").repartition("key").sortWithinPartitions("key", "class")
    found = scratch.write(spread.mapInArrow(pair_buckets(hot), "a bigint, b bigint, key bigint, block bigint"), "buckets")
    packed = sketches.select("class", *names).groupBy("class").agg(*[F.first(n).alias(n) for n in names])

    perms = bands * rows
    chance = threshold + (1 - threshold) * 2.0**-PLANES
    floor = threshold - sigmas * math.sqrt(chance * (1 - chance) / perms) / (1 - 2.0**-PLANES)

    # Blocks of hot buckets: every unordered pair of blocks is a join key of its own.
    hot_rows = found.where(F.col("b").isNull()).select("key", "block", F.col("a").alias("class")).join(packed, "class")
    blocks = hot_rows.groupBy("key").agg((F.max("block") + 1).alias("n"))
    hot_rows = hot_rows.join(blocks, "key")
    left = hot_rows.withColumn("other", F.explode(F.expr("sequence(block, n - 1)"))).alias("x")
    right = hot_rows.withColumn("other", F.explode(F.expr("sequence(0L, block)"))).alias("y")
    within = left.join(right, (F.col("x.key") == F.col("y.key")) & (F.col("x.other") == F.col("y.block")) & (F.col("x.block") == F.col("y.other")))
    dense = within.where((F.col("x.class") != F.col("y.class")) & (_agreement("x", "y", names, perms) >= floor))
    dense = dense.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b"))

    candidates = found.where(F.col("b").isNotNull()).select("a", "b").unionByName(dense).distinct()
    near = candidates.join(packed.alias("x"), F.col("a") == F.col("x.class")).join(packed.alias("y"), F.col("b") == F.col("y.class")).where(_agreement("x", "y", names, perms) >= floor).select("a", "b")
    near = scratch.write(near, "near")
    scratch.drop("buckets")

    members = scratch.write(sketches.select("id", "class").distinct(), "members")
    touched = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    reps = members.join(touched, "class").groupBy("class").agg(F.min("id").alias("id"))
    texts = base.join(reps, "id").dropDuplicates(["class"]).select("class", "text")
    pairs = near.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    links = scratch.write(verified(pairs, "text_a", "text_b", shingle, threshold, ["a", "b"]), "links")
    scratch.drop("near")
    scratch.drop("sketches")
    return NearDuplicates(links, members, scratch)
