"""Sampling, splits and caps; all deterministic, with explicit tie-breaks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import hash_bucket
from ..session import Scratch


def hash_sample(df: DataFrame, key: Column, keep_one_in: int) -> DataFrame:
    """Rows whose key falls into bucket 0 of ``keep_one_in``; all rows for 1 or less."""
    return df if keep_one_in <= 1 else df.where(hash_bucket(key, keep_one_in) == 0)


def held_out(group: Column, rate: int = 12) -> Column:
    """Is the row's whole group held out?"""
    return hash_bucket(group, rate) == 0


def rank_by(df: DataFrame, order: list[Column], name: str = "rank", scratch: Scratch | None = None) -> DataFrame:
    """A global 0-based rank without one task sorting everything.

    Rows go to as many sorted ranges as the session has shuffle partitions and
    are written there with their place in the range; the rows of the ranges
    before are added. Order by enough columns: equal rows are ranked as they come.
    """
    scratch = scratch or Scratch(df.sparkSession, "rank")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("_part", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed = scratch.write(placed, f"ranked-{uuid.uuid4().hex}")
    counts = placed.groupBy("_part").count()
    ahead = counts.withColumn("_ahead", F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))).select("_part", F.coalesce("_ahead", F.lit(0)).alias("_ahead"))
    return placed.join(F.broadcast(ahead), "_part").withColumn(name, F.col("_n") + F.col("_ahead")).drop("_part", "_n", "_ahead")  # one row a range


def stride_sample(df: DataFrame, order: str, n: int) -> DataFrame:
    """Every step-th row in order, at most n, with step = rows // n (at least 1)."""
    total = df.count()
    step = max(1, total // n)
    ranked = rank_by(df, [F.col(order)])
    return ranked.where((F.col("rank") % step == 0) & (F.col("rank") < step * n)).drop("rank")


def first_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows in order: a top-n, merged from per-task heaps."""
    return df.orderBy(*order).limit(n)


def kind_cap(df: DataFrame, kind: str, answer: Column, order: str, share: float) -> DataFrame:
    """At most floor(share x rows) rows per kind (one at least), by lowest SHA-1 of kind and answer, ties in order.

    The cap follows the size before capping. A kind of a third of all rows is
    never sorted in one task: its rows go through hash-prefix sub-ranges, whose
    counts give each its offset.
    """
    h = F.sha1(F.concat(F.col(kind), F.coalesce(answer, F.lit(""))))
    cap = max(1, int(df.count() * share))
    keyed = df.withColumn("_h", h).withColumn("_sub", F.substring("_h", 1, 2))
    counts = keyed.groupBy(kind, "_sub").count().withColumn("_ahead", F.coalesce(F.sum("count").over(W.partitionBy(kind).orderBy("_sub").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select(F.col(kind).alias("_kind"), F.col("_sub").alias("_s"), "_ahead").where(F.col("_ahead") < cap)
    near = keyed.join(counts, F.col(kind).eqNullSafe(F.col("_kind")) & (F.col("_sub") == F.col("_s")))
    ranked = near.withColumn("_n", F.row_number().over(W.partitionBy(kind, "_sub").orderBy("_h", order)) + F.col("_ahead"))
    return ranked.where(F.col("_n") <= cap).drop("_h", "_sub", "_kind", "_s", "_ahead", "_n")


def val_split(df: DataFrame, key: str, *, every: int = 20, seed: str = "161") -> DataFrame:
    """``is_val`` for every ``every``-th row in the order of a seeded hash: sizes are exact, ceil(n / every)."""
    h = F.sha1(F.concat(F.lit(seed), F.col(key).cast("string")))
    lead = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    return rank_by(df.withColumn("_h", h), [lead, F.col("_h"), F.col(key)], "_rank").withColumn("is_val", F.col("_rank") % every == 0).drop("_h", "_rank")


def triple_cap(df: DataFrame, caps: dict[str, int], order: list[Column], scratch: Scratch | None = None, first: int = 200_000) -> DataFrame:
    """Greedy acceptance in order: a row is taken iff none of its keys has reached its cap; refused rows use nothing up.

    ``caps``: column -> cap. A decision depends on all before it, so rows are
    decided in stretches of the order, each four times as long as the one
    before: what holds a key that is full by then is dropped in parallel, and one
    pass decides the rest, which sees the keys only. A null is a key like others.
    """
    scratch = scratch or Scratch(df.sparkSession, "caps")
    names = list(caps)
    keyed = df.select("_id", *[F.coalesce(F.col(n).cast("string"), F.lit("\u0000")).alias(n) for n in names], *[o.alias(f"_o{i}") for i, o in enumerate(order)])
    ranked = rank_by(keyed, [*[F.col(f"_o{i}") for i in range(len(order))], F.col("_id")], "_rank", scratch).select("_id", *names, "_rank")
    total, low, size = ranked.count(), 0, first
    taken = ranked.limit(0).select("_id", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used: dict[tuple[str, str], int] = {}
        for batch in batches:
            kept = []
            columns = [c.to_pylist() for c in batch.columns[1:]]
            for i, row in enumerate(zip(*columns)):
                held = list(zip(names, row, row[len(names) :]))
                if all(before + used.get((n, k), 0) < caps[n] for n, k, before in held):
                    for n, k, _ in held:
                        used[n, k] = used.get((n, k), 0) + 1
                    kept.append(i)
            yield pa.record_batch([c.take(pa.array(kept, pa.int32())) for c in batch.columns[: 1 + len(names)]], ["_id", *names])

    schema = f"_id {df.schema['_id'].dataType.simpleString()}, " + ", ".join(f"`{n}` string" for n in names)
    step = 0
    while low < total:
        part = ranked.where((F.col("_rank") >= low) & (F.col("_rank") < low + size))
        for n in names:
            full = taken.groupBy(n).agg(F.count("*").alias(f"_u_{n}"))
            part = part.join(full, n, "left").withColumn(f"_u_{n}", F.coalesce(f"_u_{n}", F.lit(0))).where(F.col(f"_u_{n}") < caps[n])
        part = part.repartition(1).sortWithinPartitions("_rank").select("_id", *names, *[f"_u_{n}" for n in names])
        taken = scratch.write(taken.unionByName(part.mapInArrow(run, schema)), f"taken{step}")
        low, size, step = low + size, size * 4, step + 1
    return df.join(taken.select("_id"), "_id", "left_semi")


def chunks(df: DataFrame, *group: str, order: str, size: int = 40, scratch: Scratch | None = None) -> DataFrame:
    """``chunk``: groups cut into pieces of ``size`` rows in order; a hot group lies in many ranges of one global rank."""
    ranked = rank_by(df, [*[F.col(g) for g in group], F.col(order)], "_rank", scratch)
    begin = ranked.groupBy(*group).agg(F.min("_rank").alias("_begin"))
    on = [F.col(f"r.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    both = ranked.alias("r").join(begin.alias("b"), on)
    return both.select(*[f"r.{c}" for c in df.columns], F.floor((F.col("_rank") - F.col("_begin")) / size).alias("chunk"))
