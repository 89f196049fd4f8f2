"""Error-to-fix pairs from mutations, and how often a mutation breaks what it should."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import mutations as M
from ..functions.arrow import flat_map, map_rows
from ..functions.text import fenced
from ..session import Scratch, spread
from .generate import PROMPTS, framed, usable


def mutated(members: DataFrame) -> DataFrame:
    """The members with mutation, position, rejected_al, mutation_desc: up to fourteen rows per member text, null texts none."""
    order = {name: i for i, name in enumerate(M.CATALOGUE)}

    def run(texts: list, kinds: list) -> list[list[tuple]]:
        return [[(name, order[name], bad, said) for name, bad, said in M.mutate(text, {"member_kind": kind})] if text else [] for text, kind in zip(texts, kinds)]

    return flat_map(spread(members, "record_id"), ["member_text", "member_kind"], run, "mutation string, position int, rejected_al string, mutation_desc string")


def error_fix_pairs(members: DataFrame) -> DataFrame:
    """g5_error_fix: the broken member against the sound one, with the diagnostics the edit is meant to provoke."""
    base = members.where(usable(2, 40, "procedure", "trigger")).select("record_id", "member_text", "member_kind", "repo", "path", "member_name", "signature")
    expected = F.create_map(*[x for k, v in M.EXPECTED.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))])
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    prompt = framed(PROMPTS["g5_error_fix"], fenced(F.col("rejected_al")))
    return mutated(base).select("record_id", F.lit("g5_error_fix").alias("gen"), "mutation", "position", F.array(turn("user", prompt), turn("assistant", fenced(F.col("member_text")))).alias("messages"), F.col("member_text").alias("target_al"), "rejected_al", "repo", "path", F.col("member_name").alias("member"), "signature", "mutation_desc", F.element_at(expected, F.col("mutation")).alias("expected_diagnostic"))


def distinct_checked(df: DataFrame, text: str, check, name: str = "codes") -> DataFrame:
    """``check(text) -> list of codes`` once per distinct text, joined back by hash: the expensive call never repeats, and texts are not join keys."""
    keys = [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]

    def run(h1: list, h2: list, texts: list) -> list[tuple]:
        return [(a, b, sorted(check(x))) for a, b, x in zip(h1, h2, texts)]

    once = df.where(F.col(text).isNotNull()).select(*keys, text).dropDuplicates(["_h1", "_h2"])
    known = map_rows(once, run, f"_h1 long, _h2 long, `{name}` array<string>")
    both = df.select("*", *keys).join(known, ["_h1", "_h2"], "left").drop("_h1", "_h2")
    return both.withColumn(name, F.when(F.col(text).isNotNull(), F.col(name)))


def new_codes(good: DataFrame, bad: DataFrame, *key: str) -> DataFrame:
    """(key, code, n): codes of bad beyond those of good, as multisets; rows (key, code)."""
    g = good.groupBy(*key, "code").agg(F.count("*").alias("g"))
    b = bad.groupBy(*key, "code").agg(F.count("*").alias("b"))
    return b.join(g, [*key, "code"], "left").withColumn("n", F.col("b") - F.coalesce("g", F.lit(0))).where("n > 0").select(*key, "code", "n")


def calibration(pairs: DataFrame, check, k: int = 8, scratch: Scratch | None = None) -> DataFrame:
    """Per mutation: applicable, any_new, hit_expected, their rates, the modal new code and the k commonest.

    ``pairs``: record_id, mutation, target_al, rejected_al, expected_diagnostic.
    Ties go to the smaller code.
    """
    scratch = scratch or Scratch(pairs.sparkSession, "calibration")
    pairs = scratch.write(pairs.select("record_id", "mutation", "target_al", "rejected_al", "expected_diagnostic"), "pairs")
    good = distinct_checked(pairs.select("record_id", "target_al").dropDuplicates(["record_id"]), "target_al", check, "good").select("record_id", "good")
    bad = distinct_checked(pairs.select("record_id", "mutation", "expected_diagnostic", "rejected_al"), "rejected_al", check, "bad")
    rows = scratch.write(bad.select("record_id", "mutation", "expected_diagnostic", "bad").join(good, "record_id"), "codes")
    new = new_codes(rows.select("record_id", "mutation", F.explode("good").alias("code")), rows.select("record_id", "mutation", F.explode("bad").alias("code")), "record_id", "mutation")
    per = new.groupBy("record_id", "mutation").agg(F.collect_set("code").alias("new"))
    flags = rows.join(per, ["record_id", "mutation"], "left").select("mutation", F.col("new").isNotNull().alias("any"), F.coalesce(F.arrays_overlap("new", "expected_diagnostic"), F.lit(False)).alias("hit"))
    base = flags.groupBy("mutation").agg(F.count("*").alias("applicable"), F.count_if("any").alias("any_new"), F.count_if("hit").alias("hit_expected"))
    rate = lambda c: F.round(F.coalesce(F.try_divide(c, F.col("applicable")), F.lit(0.0)), 3)
    hist = new.groupBy("mutation", "code").agg(F.sum("n").alias("n")).groupBy("mutation").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "code"))), 1, k).alias("h"))
    hist = hist.select("mutation", F.col("h")[0]["code"].alias("modal_code"), F.transform("h", lambda x: F.struct(x["code"].alias("code"), (-x["m"]).alias("n"))).alias("top_codes"))
    return base.join(hist, "mutation", "left").withColumn("any_rate", rate(F.col("any_new"))).withColumn("hit_rate", rate(F.col("hit_expected")))
