"""Exact and near deduplication, keep-first."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import norm, shingle_hashes, shingles
from ..session import Scratch
from .components import components


def one_per_id(df: DataFrame, id_col: str, *drop: str) -> DataFrame:
    """Redelivered rows collapsed: one row per id, without the columns that differ between deliveries. Null ids are left out."""
    return df.drop(*drop).where(F.col(id_col).isNotNull()).dropDuplicates([id_col])


def dedup_text(prompt: Column, answer: Column, target: Column, rejected: Column) -> Column:
    """What a candidate is deduplicated by: prompt and rejected text of a pair, else target and answer."""
    pair = F.coalesce(F.length(rejected), F.lit(0)) > 0
    one = lambda c: F.coalesce(c, F.lit(""))
    return F.when(pair, F.concat_ws("\n", one(prompt), one(rejected))).otherwise(F.concat_ws("\n", one(target), one(answer)))


def exact_dedup(df: DataFrame, text: Column, order: str, *scope: str) -> DataFrame:
    """Keep, per scope and normalised text, the row with the smallest ``order``.

    Only hashes and ids are shuffled, and combined before it: a text that a
    third of all rows hold costs one row per task. The kept ids select the rows.
    Null texts count as empty; rows with a null order are left out.
    """
    keyed = df.where(F.col(order).isNotNull()).select(order, *scope, F.sha2(norm(text), 256).alias("_h"))
    first = keyed.groupBy(*scope, "_h").agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_semi").dropDuplicates([order])


def shared_shingle_pairs(df: DataFrame, id_col: str, text: Column, *, k: int = 5, threshold: float = 0.8, scratch: Scratch | None = None) -> DataFrame:
    """(id_a, id_b, jaccard): all pairs of different normalised texts with shingle overlap of the threshold or more.

    Texts are deduplicated first. Only rare shingles generate candidates: those
    in the prefix that two sets of such overlap must share, ordered by document
    frequency, so a shingle of boilerplate joins nothing with everything. Those
    of one text alone are no candidates but come first in the prefix; they are
    counted, not moved. Shingles move as hashes; the pairs are verified on the
    texts. Lineage is cut between the steps, so that no plan holds another twice.
    """
    scratch = scratch or Scratch(df.sparkSession, "shingle-pairs")
    base = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), norm(text).alias("t"))
    base = base.groupBy(F.sha2("t", 256).alias("_h")).agg(F.min(F.struct("id", "t")).alias("m")).select("m.id", "m.t")
    base = scratch.write(base, "texts")
    sets = base.select("id", shingle_hashes(F.col("t"), k).alias("s"))
    flat = sets.select("id", F.size("s").alias("n"), F.explode("s").alias("h"))
    common = flat.groupBy("h").agg(F.count("*").alias("f")).where("f > 1")
    own = W.partitionBy("id")
    ranked = flat.join(common, "h").select("id", "n", "h", F.row_number().over(own.orderBy("f", "h")).alias("r"), F.count("*").over(own).alias("m"))
    prefix = scratch.write(ranked.where(F.col("r") <= F.col("m") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1).select("id", "n", "h"), "prefix")
    held = scratch.write(base.join(prefix.select("id").distinct(), "id", "left_semi").select("id", shingles(F.col("t"), k).alias("s")), "held")
    x, y = prefix.alias("x"), prefix.alias("y")
    cand = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.id") < F.col("y.id")) & (F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * F.lit(threshold) - 1e-9))
    cand = cand.select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b")).distinct()
    a = held.select(F.col("id").alias("id_a"), F.col("s").alias("sa"))
    b = held.select(F.col("id").alias("id_b"), F.col("s").alias("sb"))
    both = cand.join(a, "id_a").join(b, "id_b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    j = F.col("i") / (F.size("sa") + F.size("sb") - F.col("i"))
    return both.select("id_a", "id_b", j.alias("jaccard")).where(F.col("jaccard") >= threshold - 1e-12)


def minhash_bands(df: DataFrame, id_col: str, text: Column, *scope: str, k: int = 5, perms: int = 55, rows: int = 11) -> DataFrame:
    """(id, band): band keys of each text, minima of seeded hashes over its shingles, eleven to a band.

    One explode and one aggregation; the minima combine before the shuffle, so
    a row leaves its task as ``perms`` numbers. Bands of different scopes differ.
    """
    flat = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(*scope).alias("sc") if scope else F.lit(0).alias("sc"), F.explode(shingles(norm(text), k)).alias("s")).select("id", "sc", F.xxhash64("s").alias("sh"))
    low = flat.groupBy("id", "sc").agg(*[F.min(F.xxhash64("sh", F.lit(i))).alias(f"m{i}") for i in range(perms)])
    keys = [F.xxhash64("sc", F.lit(b), *[f"m{i}" for i in range(b * rows, (b + 1) * rows)]) for b in range(perms // rows)]
    return low.select("id", F.explode(F.array(*keys)).alias("band"))


def keep_first(ids: DataFrame, bands: DataFrame, scratch: Scratch, rounds: int = 6) -> DataFrame:
    """The ids a sequential pass in id order would keep: a row stays iff it shares no band with an earlier kept row.

    ``ids``: one column; ``bands``: (id, band). Bands with one row decide
    nothing and are left out. A round looks at each band's smallest kept and
    smallest open row: a row with a smaller kept one in any band is dropped, a
    row that is the smallest open one in all its bands is kept. No pairs are
    formed, so a band of a third of all rows costs its rows and no more. What
    long chains leave open after ``rounds`` is finished per connected component:
    its open rows stream in id order past the bands kept so far.
    """
    name = ids.columns[0]
    bands = scratch.write(bands, "all-bands")
    many = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    held = scratch.write(bands.join(many, "band").distinct(), "bands")
    state = scratch.write(held.select("id").distinct().withColumn("state", F.lit(0)), "state0")
    left = rounds
    while left and state.where("state = 0").limit(1).count():
        live = held.join(state.where("state <> 2"), "id")
        per = live.groupBy("band").agg(F.min(F.when(F.col("state") == 1, F.col("id"))).alias("kept"), F.min(F.when(F.col("state") == 0, F.col("id"))).alias("open"))
        seen = live.where("state = 0").join(per, "band").groupBy("id").agg(F.max((F.col("kept") < F.col("id")).cast("int")).alias("beaten"), F.min((F.col("open") == F.col("id")).cast("int")).alias("first"))
        nxt = F.when(F.col("state") != 0, F.col("state")).when(F.col("beaten") == 1, 2).when(F.col("first") == 1, 1).otherwise(0)
        left -= 1
        state = scratch.write(state.join(seen, "id", "left").select("id", nxt.alias("state")), f"state{rounds - left}")
    dropped = state.where("state = 2").select("id")
    if state.where("state = 0").limit(1).count():
        live = held.join(state.where("state <> 2"), "id")  # with those already kept, which the open ones may meet
        dropped = dropped.unionByName(_in_order(live.join(live.where("state = 0").select("band").distinct(), "band"), scratch))
    return ids.where(F.col(name).isNotNull()).join(dropped.withColumnRenamed("id", name), name, "left_anti")


def _in_order(bands: DataFrame, scratch: Scratch) -> DataFrame:
    """(id) of the open rows of (id, band, state) that lose against an earlier one; rows of a component in id order, in one pass of its own."""
    hubs = bands.groupBy("band").agg(F.min("id").alias("hub"))
    edges = bands.join(hubs, "band").select("hub", "id")  # loops keep rows that no other meets
    roots = components(edges, scratch, "open")
    kind = bands.schema["id"].dataType.simpleString()
    rows = bands.join(roots.withColumnRenamed("node", "id"), "id").groupBy("root", "id").agg(F.collect_set("band").alias("held"), F.max("state").alias("state"))
    rows = rows.repartition("root").sortWithinPartitions("root", "id").select("root", "id", "held", "state")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, set()
        for batch in batches:
            lost = []
            for n, (root, held, sure) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)))):
                if root != now:
                    now, kept = root, set()
                if sure or kept.isdisjoint(held):
                    kept.update(held)
                else:
                    lost.append(n)
            yield pa.record_batch([batch.column(1).take(pa.array(lost, pa.int32()))], ["id"])

    return rows.mapInArrow(run, f"id {kind}")


def drop_repeated_paragraphs(text: Column) -> Column:
    """Paragraphs up to the first that repeats an earlier one by its first 40 characters, either way round."""
    blocks = F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda b: F.regexp_replace(b, r"^\s+|\s+$", "")), lambda b: b != "")
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("done"))

    def step(acc, b):
        again = F.exists(acc["kept"], lambda k: F.startswith(b, F.substring(k, 1, 40)) | F.startswith(k, F.substring(b, 1, 40)))
        done = acc["done"] | again
        return F.struct(F.when(done, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(b))).alias("kept"), done.alias("done"))

    kept = F.aggregate(blocks, start, step, lambda acc: F.array_join(acc["kept"], "\n\n"))
    return F.when(F.size(blocks) == 0, text).otherwise(kept)
