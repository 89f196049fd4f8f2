"""Records of evaluation splits that occur, exactly or almost, in the training split.

Similarity-hash fingerprints: every distinct word run votes on each code bit;
near texts get codes within a small Hamming radius. Codes are cut into blocks.
A training record is filed under each of its blocks; an evaluation record looks
up, per block, its own value and the values that differ in its least certain
bits (those whose vote was closest), in the order in which they are likely.
Rows of one block value stream through a sorted partition, where two further
words of the code are compared before a pair leaves it. The width of a block
follows the counted training side and the number of blocks follows from the
width, so that neither the lookups of a record nor its chance meetings grow in
proportion to the training side. The radius on the whole code and the overlap
of the texts decide.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from . import kernel as K
from .similarity import classes_of, meet_buckets, verified

U64 = np.uint64
#: Byte -> its eight bits in eight bytes of a word, so that words add up votes of eight bits at once.
_LANES = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(U64) << (np.arange(8, dtype=U64) * U64(8))).sum(axis=1, dtype=U64)


def conversation_text(col: str = "conversations") -> F.Column:
    """The values of all turns but system turns, in order, joined by line feeds; null without turns."""
    turns = F.filter(F.col(col), lambda t: ~F.coalesce(F.lower(F.trim(t["from"])) == "system", F.lit(False)))
    return F.array_join(F.transform(turns, lambda t: t["value"]), "\n")


@dataclass
class SplitOverlap:
    """links(a, b, overlap): evaluation class a and training class b; sides(id, side, class, split, source)."""

    links: DataFrame
    sides: DataFrame

    def pairs(self) -> DataFrame:
        """(id_eval, id_train, split, source, overlap): every overlapping pair of records, copies included."""
        ev = self.sides.where("side = 1").select(F.col("class").alias("a"), F.col("id").alias("id_eval"), "split", "source")
        tr = self.sides.where("side = 0").select(F.col("class").alias("b"), F.col("id").alias("id_train"))
        return self.links.join(ev, "a").join(tr, "b").select("id_eval", "id_train", "split", "source", "overlap").distinct()

    def report(self) -> DataFrame:
        """(split, source, n_records, n_leaked): evaluation records per split and source, and how many of them a training record repeats."""
        leaked = self.links.select(F.col("a").alias("class")).distinct().withColumn("hit", F.lit(1))
        ev = self.sides.where("side = 1").select("id", "class", "split", "source").distinct()
        return ev.join(leaked, "class", "left").groupBy("split", "source").agg(F.countDistinct("id").alias("n_records"), F.countDistinct(F.when(F.col("hit") == 1, F.col("id"))).alias("n_leaked"))


@dataclass(frozen=True)
class Shape:
    """How codes are cut: ``blocks`` of ``width`` bits, and which ranks of least certain bits a lookup turns round."""

    width: int
    blocks: int
    longs: int
    flips: tuple[tuple[int, ...], ...]
    word_radius: int
    radius: int

    @property
    def ranks(self) -> int:
        return 1 + max((r for s in self.flips for r in s), default=0)

    def words_of(self, block: int) -> tuple[int, int]:
        """The two words of the code that are compared inside a block value, as far from the block as can be."""
        at = block * self.width // 64 + self.longs // 2
        return at % self.longs, (at + 1) % self.longs


@lru_cache(None)
def shape(records: int, threshold: float, probes: int, miss: float) -> Shape:
    """The cut for so many training records.

    Of records whose overlap is just the threshold, ``miss`` are lost at most;
    overlap s of sets of one size is a cosine of 2s / (1 + s), the least it can
    be for sets of any sizes, and votes of two sets are as good as normal with
    that correlation. The share of blocks that a lookup gets right is measured
    on such votes. Block values hold the training side's power of 0.4.
    """
    width = max(6, round(0.6 * math.log2(max(records, 2)) + 0.8))
    cosine = 2 * threshold / (1 + threshold)
    # which bits to turn: the sets with the least sum of squared margins, by the expected margin of each rank
    margin = [NormalDist().inv_cdf(0.5 + 0.5 * (r + 0.6) / (width + 0.2)) for r in range(min(width, 10))]
    sets = [s for k in range(4) for s in itertools.combinations(range(len(margin)), k)]
    flips = tuple(sorted(sets, key=lambda s: (sum(margin[r] ** 2 for r in s), s))[:probes])
    rng = np.random.default_rng(7)
    x = rng.standard_normal((8000, width))
    y = cosine * x + math.sqrt(1 - cosine**2) * rng.standard_normal((8000, width))
    turned = np.take_along_axis((x > 0) != (y > 0), np.argsort(np.abs(x), axis=1), 1)
    right = np.zeros(len(x), bool)
    for s in flips:
        mask = np.zeros(width, bool)
        mask[list(s)] = True
        right |= (turned == mask).all(1)
    blocks = max(1, math.ceil(math.log(miss) / math.log(1 - min(right.mean(), 0.999))))
    longs = max(8, -(-blocks * width // 64))
    p = math.acos(cosine) / math.pi
    far = lambda bits, sigmas: int(bits * p + sigmas * math.sqrt(bits * p * (1 - p)))
    return Shape(width, blocks, longs, flips, far(128, 3), far(64 * longs, 4))


def votes_of(doc: np.ndarray, h: np.ndarray, longs: int, step: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Documents that occur in the sorted ``doc``, and per document how many of its runs set each bit, less those that do not."""
    docs, at = K.starts(doc)
    size = np.diff(np.r_[at, len(doc)])
    votes = np.zeros((len(docs), 64 * longs), np.int32)
    salt = K.mix(np.arange(1, longs + 1, dtype=U64) * U64(0xE7037ED1A0B428DB))
    row = np.repeat(np.arange(len(docs)), size)
    inside = np.arange(len(doc)) - np.repeat(at, size)
    for i in range(0, len(doc), step):
        part = slice(i, min(len(doc), i + step))
        # a lane of eight bits holds 255 votes
        begin = np.flatnonzero(np.r_[True, (row[part][1:] != row[part][:-1]) | (inside[part][1:] % 255 == 0)])
        lanes = _LANES[K.mix(h[part, None] ^ salt).view(np.uint8).reshape(-1, 8 * longs)]
        sums = np.add.reduceat(lanes, begin, axis=0).view(np.uint8).astype(np.int32)
        owner = row[part][begin]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        votes[owner[first]] += np.add.reduceat(sums, first, axis=0)
    return docs, 2 * votes - size[:, None].astype(np.int32)


def _coder(cut: Shape, shingle: int, min_words: int):
    """mapInArrow over (id, split, source, text, side): class and code of each text; for side 1 the ranks of its least certain bits."""
    names = [f"c{i}" for i in range(cut.longs)]
    used = cut.blocks * cut.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sides = batch.column(3), batch.column(4).to_numpy(zero_copy_only=False)
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
                docs, votes = votes_of(doc, h, cut.longs)
                packed = np.packbits(votes > 0, axis=1, bitorder="little").view(np.int64)
                weak: list[bytes | None] = [None] * len(docs)
                held = np.flatnonzero(sides[i + docs] == 1)
                if len(held):
                    margin = np.abs(votes[held, :used]).reshape(len(held), cut.blocks, cut.width)
                    ranks = np.argsort(margin, axis=2, kind="stable")[:, :, : cut.ranks].astype(np.uint8)
                    for r, x in zip(held, ranks.reshape(len(held), -1)):
                        weak[r] = x.tobytes()
                rows = pa.array(i + docs)
                kept = [batch.column(k).take(rows) for k in (0, 1, 2, 4)]
                yield pa.record_batch([*kept, pa.array(cls[docs]), pa.array(weak, pa.binary()), *(pa.array(np.ascontiguousarray(packed[:, w])) for w in range(cut.longs))], ["id", "split", "source", "side", "class", "weak", *names])

    return run, names


def _lookups(cut: Shape, step: int = 1 << 11):
    """mapInArrow over (class, side, weak, code words): one row per block of side 0, one per lookup of side 1.

    key holds block, value and, in its lowest bit, the side, so that the rows of
    a value sort with the filed ones first; f0 and f1 are two words of the code.
    """
    place = U64(1) << np.arange(cut.width, dtype=U64)
    number = np.arange(cut.blocks, dtype=U64) << U64(cut.width)
    words = np.array([cut.words_of(b) for b in range(cut.blocks)]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                cls, side = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                code = np.stack([part.column(3 + w).to_numpy(zero_copy_only=False) for w in range(cut.longs)], axis=1)
                bits = np.unpackbits(code.view(np.uint8), axis=1, bitorder="little")[:, : cut.blocks * cut.width].reshape(len(cls), cut.blocks, cut.width)
                value = (bits * place).sum(axis=2, dtype=U64) + number
                for s in (0, 1):
                    own = np.flatnonzero(side == s)
                    if not len(own):
                        continue
                    keys = value[own][:, :, None]
                    if s:
                        weak = np.frombuffer(b"".join(part.column(2).take(pa.array(own)).to_pylist()), np.uint8).reshape(len(own), cut.blocks, cut.ranks)
                        turn = np.stack([np.bitwise_or.reduce(place[weak[:, :, list(f)]], axis=2) if f else np.zeros(weak.shape[:2], U64) for f in cut.flips], axis=2)
                        keys = keys ^ turn
                    keys = (keys << U64(1)) | U64(s)
                    wide = lambda x: np.ascontiguousarray(np.broadcast_to(x[:, :, None], keys.shape)).ravel()
                    yield pa.record_batch([pa.array(keys.ravel().view(np.int64)), pa.array(wide(np.repeat(cls[own][:, None], cut.blocks, axis=1))), pa.array(wide(code[own][:, words[0]])), pa.array(wide(code[own][:, words[1]]))], ["key", "class", "f0", "f1"])

    return run


def split_overlap(
    df: DataFrame,
    id_col: str,
    text: F.Column,
    split: F.Column,
    source: F.Column,
    *,
    train: str = "train",
    held_out: tuple[str, ...] = ("val", "heldout", "test"),
    shingle: int = 5,
    threshold: float = 0.8,
    min_words: int = 5,
    probes: int = 8,
    miss: float = 0.01,
    hot: int = 8192,
    scratch: Scratch | None = None,
) -> SplitOverlap:
    """Find records of ``held_out`` splits whose distinct word runs overlap a training record by ``threshold``.

    ``split`` is compared without case and blanks. ``probes`` values are looked
    up per block; ``miss`` bounds what is lost at the threshold (see
    :func:`shape`). A block value with more than ``hot`` training classes is cut
    into squares of ``hot`` by ``hot`` that are compared in separate tasks.

    Defined results: rows of other or null splits, null ids, null texts and
    texts of fewer than ``min_words`` words take no part; a null source is
    reported as null; rows repeated under one id count once; empty tables give
    empty tables; other columns are not read.
    """
    scratch = scratch or Scratch(df.sparkSession, "splits")
    s = F.lower(F.regexp_replace(split, r"\s+", ""))
    base = df.select(F.col(id_col).alias("id"), s.alias("split"), source.alias("source"), text.alias("text"), F.when(s == train, 0).when(s.isin(*held_out), 1).cast("int").alias("side"))
    base = base.where(F.col("id").isNotNull() & F.col("side").isNotNull())
    cut = shape(base.where("side = 0").count(), threshold, probes, miss)
    run, names = _coder(cut, shingle, min_words)
    kinds = {c: base.schema[c].dataType.simpleString() for c in ("id", "source")}
    longs = ", ".join(f"{n} bigint" for n in names)
    coded = base.where(F.col("text").isNotNull()).mapInArrow(run, f"id {kinds['id']}, split string, source {kinds['source']}, side int, class bigint, weak binary, {longs}")
    coded = scratch.write(coded, "codes")

    # One row per class and side: copies are filed, and looked up, once.
    one = coded.select("class", "side", "weak", *names).dropDuplicates(["class", "side"])
    filed = one.mapInArrow(_lookups(cut), "key bigint, class bigint, f0 bigint, f1 bigint")
    filed = filed.repartition(F.shiftright("key", 1)).sortWithinPartitions("key")
    met = scratch.write(filed.mapInArrow(meet_buckets(hot, cut.word_radius), "a bigint, b bigint, key bigint, block bigint, side int, f0 bigint, f1 bigint"), "met")

    # Squares of hot values: filed rows by lookups, each square a join key of its own.
    big = met.where(F.col("key").isNotNull())
    sizes = big.groupBy("key").agg(F.max(F.when(F.col("side") == 0, F.col("block"))).alias("rows_"), F.max(F.when(F.col("side") == 1, F.col("block"))).alias("columns_"))
    big = big.join(sizes.where("rows_ is not null and columns_ is not null"), "key")
    shelf = big.where("side = 0").select("key", F.col("block").alias("r"), F.explode(F.sequence(F.lit(0).cast("bigint"), "columns_")).alias("c"), F.col("b"), F.col("f0").alias("x0"), F.col("f1").alias("x1"))
    asked = big.where("side = 1").select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), "rows_")).alias("r"), F.col("block").alias("c"), F.col("a"), "f0", "f1")
    close = F.bit_count(F.col("f0").bitwiseXOR(F.col("x0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("x1"))) <= cut.word_radius
    dense = asked.join(shelf, ["key", "r", "c"]).where(close).select("a", "b")

    candidates = met.where(F.col("key").isNull()).select("a", "b").unionByName(dense).distinct()
    code = lambda side, c: one.where(F.col("side") == side).select(F.col("class").alias(c), *[F.col(n).alias(f"{c}_{n}") for n in names])
    apart = sum((F.bit_count(F.col(f"a_{n}").bitwiseXOR(F.col(f"b_{n}"))) for n in names), F.lit(0))
    near = candidates.join(code(1, "a"), "a").join(code(0, "b"), "b").where(apart <= cut.radius).select("a", "b")
    near = scratch.write(near, "near")
    scratch.drop("met")

    sides = coded.select("id", "side", "class", "split", "source").distinct()
    touched = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    reps = sides.join(touched, "class").groupBy("class").agg(F.min("id").alias("id"))
    texts = base.select("id", "text").join(reps, "id").dropDuplicates(["class"]).select("class", "text")
    pairs = near.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    links = scratch.write(verified(pairs, "text_a", "text_b", shingle, threshold, ["a", "b"]), "links")
    scratch.drop("near")
    return SplitOverlap(links, sides)
