"""Queries over the training-data operators, with production parameters and over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from .doc_pairs import doc_pairs
from .encoding import repair_encoding
from .group_splits import group_splits, related_apps
from .leakage import leaked_items, reparameterised_items
from .mixture import mix
from .near_duplicates import near_duplicates
from .split_overlap import conversation_text, split_overlap

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _overlap(spark: SparkSession, sf: str):
    return split_overlap(_table(spark, sf, "sharegpt"), "row_id", conversation_text(), F.col("split"), F.col("meta.repo"), shingle=3, threshold=0.6, min_words=20)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a training row and a held-out row that overlap by at least 0.6."""
    pairs = _overlap(spark, sf).pairs()
    return pairs.select(F.least("id_eval", "id_train").alias("row_id_a"), F.greatest("id_eval", "id_train").alias("row_id_b")).distinct()


def p1_report(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out rows per split and repository, and how many of them a training row repeats."""
    return _overlap(spark, sf).report().withColumnRenamed("source", "repo")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Members with a body and documentation that says something."""
    return doc_pairs(_table(spark, sf, "members"), _table(spark, sf, "source_files"), with_text=False).select("origin", "record_id", "line_no")


def p2_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The pairs themselves: documentation, signature and text of each such member."""
    return doc_pairs(_table(spark, sf, "members"), _table(spark, sf, "source_files"))


SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def _apps(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "apps").select(F.col("app_id").alias("app"), "app_dir")


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "candidates").select(F.col("cand_id").alias("record_id"), "meta.path", "meta.author", "meta.object")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of apps that must land in the same split."""
    pairs = related_apps(_apps(spark, sf), _candidates(spark, sf)).pairs()
    return pairs.select(F.col("app_a").alias("app_id_a"), F.col("app_b").alias("app_id_b"))


def _splits(spark: SparkSession, sf: str) -> DataFrame:
    members = _table(spark, sf, "members").select(F.col("member_id").alias("record_id"), "path", "app_dir")
    return group_splits(_apps(spark, sf), members, _candidates(spark, sf), SHARES)


def p3_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Every member and candidate with its split."""
    return _splits(spark, sf).select("origin", "record_id", "split")


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    """Records per origin and split, and their share."""
    n = _splits(spark, sf).groupBy("origin", "split").agg(F.count("*").alias("n_records"))
    total = n.groupBy("origin").agg(F.sum("n_records").alias("total"))
    return n.join(total, "origin").select("origin", "split", "n_records", F.round(F.col("n_records") / F.col("total"), 6).alias("share"))


def p3_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates per split: the totals that subset sums reach."""
    return _splits(spark, sf).where("origin = 'candidates'").groupBy("split").agg(F.count("*").alias("n_candidates"))


def p3_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of related apps by their smallest app, with their records, and the splits these are in (one)."""
    s = _splits(spark, sf).where("app is not null").groupBy(F.substring_index("grp", ":", -1).cast("long").alias("app_id"))
    return s.agg(F.count_if(F.col("origin") == "candidates").alias("n_candidates"), F.count_if(F.col("origin") == "members").alias("n_members"), F.countDistinct("split").alias("n_splits"))


def _members_alike(spark: SparkSession, sf: str):
    return near_duplicates(_table(spark, sf, "members"), "member_id", "member_text", shingle=3, threshold=0.6, min_words=20)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of members whose texts overlap by at least 0.6."""
    return _members_alike(spark, sf).pairs().select(F.col("id_a").alias("member_id_a"), F.col("id_b").alias("member_id_b"))


def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Every member that has a near-duplicate or a copy, with its class, links and group."""
    return _members_alike(spark, sf).groups().withColumnRenamed("id", "member_id")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with twelve or more consecutive words of a benchmark item."""
    return leaked_items(_table(spark, sf, "documents"), "doc_id", "text", _table(spark, sf, "benchmark"), "item_id", "text").select("doc_id", "item_id")


def p5_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that repeat an item's template, verbatim or with other names, numbers and units."""
    return reparameterised_items(_table(spark, sf, "documents"), "doc_id", "text", _table(spark, sf, "benchmark"), "item_id", "text")


def _mixture(spark: SparkSession, sf: str):
    return mix(_table(spark, sf, "documents"), "doc_id", "text", "source", _table(spark, sf, "mix_targets"))


def p6_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """The mixed corpus: one row per use of a text."""
    return _mixture(spark, sf).copies()


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted and reached shares per source, with rates."""
    return _mixture(spark, sf).report()


def p6_texts(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the mixture, per wanted source: its distinct texts, those used too often, and those of another text's copies (none)."""
    mixture = _mixture(spark, sf)
    docs = _table(spark, sf, "documents").select("doc_id", F.xxhash64("text").alias("h"))
    caps = mixture.report().select("source", "n_texts", "max_repeats")
    used = mixture.documents.join(docs, "doc_id").join(caps.select("source", "max_repeats"), "source")
    twice = used.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", F.lit(1).alias("twice"))
    per = used.join(twice, "h", "left").groupBy("source").agg(F.count_if(F.col("copies") > F.col("max_repeats")).alias("o"), F.count("twice").alias("t"))
    return caps.where("n_texts > 0").join(per, "source", "left").select("source", "n_texts", F.coalesce("o", F.lit(0)).alias("n_over_cap"), F.coalesce("t", F.lit(0)).alias("n_repeated"))


def _encodings(spark: SparkSession, sf: str):
    return repair_encoding(_table(spark, sf, "documents"), "doc_id", "text")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with characters read in a wrong encoding."""
    return _encodings(spark, sf).found().withColumnRenamed("id", "doc_id")


def p7_repaired(spark: SparkSession, sf: str) -> DataFrame:
    """These documents with their original text where it can be recovered."""
    return _encodings(spark, sf).repaired().withColumnRenamed("id", "doc_id")


def p7_mappings(spark: SparkSession, sf: str) -> DataFrame:
    """The transformations and character mappings learned from clean twins."""
    return _encodings(spark, sf).learned()


def p7_kept(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of restored texts: found documents without one, and restored ones whose ASCII letters are not those of the document (none)."""
    r = _encodings(spark, sf)
    letters = lambda c: F.regexp_replace(c, "[^A-Za-z]", "")
    docs = _table(spark, sf, "documents").where("not contains(text, '&')").select("doc_id", F.col("text").alias("was"))
    fixed = r.repaired().withColumnRenamed("id", "doc_id")
    changed = fixed.join(docs, "doc_id").where(letters("was") != letters("text")).agg(F.count("*").alias("n_letters_changed"))
    return changed.crossJoin(r.found().withColumnRenamed("id", "doc_id").join(fixed, "doc_id", "left_anti").agg(F.count("*").alias("n_not_restored")))


def queries() -> dict[str, Query]:
    return {
        "p1_found": p1_found,
        "p1_report": p1_report,
        "p2_found": p2_found,
        "p2_pairs": p2_pairs,
        "p3_found": p3_found,
        "p3_splits": p3_splits,
        "p3_report": p3_report,
        "p3_totals": p3_totals,
        "p3_groups": p3_groups,
        "p4_found": p4_found,
        "p4_groups": p4_groups,
        "p5_found": p5_found,
        "p5_variants": p5_variants,
        "p6_mixture": p6_mixture,
        "p6_report": p6_report,
        "p6_texts": p6_texts,
        "p7_found": p7_found,
        "p7_repaired": p7_repaired,
        "p7_mappings": p7_mappings,
        "p7_kept": p7_kept,
    }


def oracle_sql() -> dict[str, str]:
    from .oracle import SQL

    return SQL
