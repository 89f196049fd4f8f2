"""Vocabulary of a corpus, and near names in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vocabulary(members: DataFrame, min_length: int = 3) -> DataFrame:
    """(name): distinct identifiers of names, signatures and texts."""
    ident = F.lit(r"[A-Za-z_][A-Za-z0-9_]*")
    words = members.select(F.explode(F.array_distinct(F.concat(F.coalesce(F.regexp_extract_all("member_text", ident, F.lit(0)), F.array()), F.coalesce(F.flatten(F.transform("sibling_signatures", lambda s: F.regexp_extract_all(s, ident, F.lit(0)))), F.array())))).alias("name"))
    names = members.select(F.explode(F.array("member_name", F.replace("object_name", F.lit('"'), F.lit("")))).alias("name"))
    return words.unionByName(names).where(F.length("name") >= min_length).distinct()


def _third(word: Column, n: Column, k: int, shift: int = 0) -> Column:
    """Hash of the k-th third of words of n characters, read ``shift`` characters further on; null where that leaves the word."""
    lo, hi = F.floor(n * k / 3), F.floor(n * (k + 1) / 3)
    at = lo + shift
    return F.when((at >= 0) & (at + hi - lo <= F.length(word)), F.xxhash64(n.cast("int"), F.lit(k), F.substring(word, (at + 1).cast("int"), (hi - lo).cast("int"))))


def nearest_names(bad: DataFrame, pool: DataFrame) -> DataFrame:
    """(name, nearest): the one pool name, case aside, at edit distance 1 or 2; names with none or several are absent.

    Two edits leave one of the three thirds of a pool name unchanged, moved by
    at most two places, so candidates come from an equi-join on hashes: three
    keys a pool name, and those of five lengths and five places a name.
    """
    b = bad.select(F.col(bad.columns[0]).alias("name")).where("name is not null").distinct().withColumn("lb", F.lower("name"))
    p = pool.select(F.col(pool.columns[0]).alias("entry")).where("entry is not null").distinct().withColumn("lp", F.lower("entry"))
    keys = [_third(F.col("lb"), F.length("lb") + d, k, shift) for d in range(-2, 3) for k in range(3) for shift in range(-2, 3)]
    x = b.select("name", "lb", F.explode(F.array_compact(F.array_distinct(F.array(*keys)))).alias("k"))
    y = p.groupBy("lp").agg(F.min("entry").alias("entry")).select("lp", "entry", F.explode(F.array_distinct(F.array(*[_third(F.col("lp"), F.length("lp"), k) for k in range(3)]))).alias("k"))
    near = x.join(y, "k").where((F.col("lb") != F.col("lp")) & F.levenshtein("lb", "lp", 2).between(1, 2)).select("name", "lp", "entry").distinct()
    one = near.groupBy("name").agg(F.count("*").alias("n"), F.min("entry").alias("nearest")).where("n = 1")
    return one.select("name", "nearest")
