"""Finished datasets: conversations, preference pairs, and the card that describes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import group_of
from .split import held_out, kind_cap, val_split

# Roles of messages and of conversations.
ROLES = {"user": "human", "assistant": "gpt", "system": "system"}


def conversations(messages: Column) -> Column:
    """Messages as from/value turns. An unknown role is an error, as it would be silently mislabelled."""
    named = lambda role: F.when(role == "user", "human").when(role == "assistant", "gpt").when(role == "system", "system").otherwise(F.raise_error(F.concat(F.lit("unknown role "), F.coalesce(role, F.lit("null")))))
    return F.transform(messages, lambda m: F.struct(named(m["role"]).alias("from"), m["content"].alias("value")))


def last_content(messages: Column) -> Column:
    return F.get(messages, F.size(messages) - 1)["content"]


def first_content(messages: Column) -> Column:
    return F.get(messages, F.lit(0))["content"]


def preference(df: DataFrame, *keep: str) -> DataFrame:
    """(keep, prompt, chosen, rejected) of rows that have a rejected side."""
    return df.where(F.length("rejected_al") > 0).select(*keep, first_content(F.col("messages")).alias("prompt"), last_content(F.col("messages")).alias("chosen"), F.col("rejected_al").alias("rejected"))


def routed(df: DataFrame, *, heldout_rate: int = 12, share: float = 0.35, every: int = 20, id_col: str = "cand_id") -> DataFrame:
    """``part`` of every row: heldout, preference, capped, val or train.

    Whole groups are held out; of the rest, pairs are preference data; the
    others are capped per generator and split by a seeded hash.
    """
    d = df.withColumn("part", F.when(held_out(group_of(F.col("path"), F.col("object"), F.col("gen")), heldout_rate), "heldout").when(F.length("rejected_al") > 0, "preference"))
    sft = d.where("part is null").drop("part")
    kept = kind_cap(sft, "gen", last_content(F.col("messages")), id_col, share)
    split = val_split(kept.select(id_col), id_col, every=every).select(id_col, F.when(F.col("is_val"), "val").otherwise("train").alias("_p"))
    return d.join(split, id_col, "left").withColumn("part", F.coalesce("part", "_p", F.lit("capped"))).drop("_p")


def datacard(parts: DataFrame) -> DataFrame:
    """One row: counts per part and per generator."""
    n = lambda p: F.count_if(F.col("part") == p).alias(f"n_{p}")
    by = parts.where("part <> 'capped'").groupBy("gen").agg(F.count_if(F.col("part") != "heldout").alias("n"), F.count_if(F.col("part") == "heldout").alias("h"))
    maps = by.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gen", "n")))).alias("by_gen"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("gen", "h")))).alias("heldout_by_gen"))
    return parts.agg(F.count("*").alias("n_rows"), *[n(p) for p in ("train", "val", "preference", "heldout", "capped")]).crossJoin(maps)
