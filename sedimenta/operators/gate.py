"""Expensive validators behind memo tables: decide cheaply first, call once per distinct input, keep verdicts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.arrow import map_rows
from ..functions.text import norm_ws
from ..session import Scratch, spread

Check = Callable[[str], list[str]]
PAIRED = ("g5_error_fix", "g7_hard_negative")
COMPILED = ("g1_fim", "g2_sig2body", "g6_spec2object", "g8_warning_clean")


def memo_key(*cols: Column) -> Column:
    """One hash for what a verdict depends on; nulls count as empty."""
    return F.sha2(F.concat_ws("\u0000", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256)


def with_memo(df: DataFrame, text: str, memo: DataFrame | None, check: Check) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``codes`` of each text, and the memo rows (key, codes) that were missing.

    Known keys are joined; the check runs once per distinct unknown text. Null
    texts have null codes. A check that fails gives the one code ``EXCEPTION``.
    """

    def run(keys: list, texts: list) -> list[tuple]:
        out = []
        for key, x in zip(keys, texts):
            try:
                out.append((key, sorted(check(x))))
            except Exception:
                out.append((key, ["EXCEPTION"]))
        return out

    keyed = df.withColumn("_key", F.when(F.col(text).isNotNull(), memo_key(F.col(text))))
    if memo is None:
        memo = df.sparkSession.createDataFrame([], "key string, codes array<string>")
    unknown = keyed.where(F.col("_key").isNotNull()).select(F.col("_key").alias("key"), F.col(text).alias("text")).dropDuplicates(["key"]).join(memo.select("key"), "key", "left_anti")
    fresh = map_rows(unknown, run, "key string, codes array<string>")
    known = memo.unionByName(fresh).withColumnsRenamed({"key": "_key"})
    return keyed.join(known, "_key", "left").drop("_key"), fresh


def is_clean(codes: Column) -> Column:
    """No compiler error among the codes."""
    return ~F.exists(codes, lambda c: c.rlike(r"^AL\d|^EXCEPTION"))


def verbatim(candidate: Column, origin: Column) -> Column:
    """Is the candidate, whitespace aside, the origin or part of it?"""
    return F.coalesce(F.contains(norm_ws(origin), norm_ws(candidate)), F.lit(False)) & (norm_ws(candidate) != "")


def verdicts(candidates: DataFrame, baselines: DataFrame, check: Check, memo: DataFrame | None = None) -> DataFrame:
    """Candidates with kept, reason and via.

    ``candidates``: gen, target_al, rejected_al, app, origin (text of the app the
    target may be taken from; null if none). ``baselines``: app, error_clean.
    Text answers are kept unseen; a target found verbatim in an app that was
    clean is kept unseen; pairs need a sound and a broken side; the rest must
    compile. Only undecided rows reach the check, and the text that is emitted
    is the text that is checked.
    """
    base = candidates.join(baselines.select("app", "error_clean").dropDuplicates(["app"]), "app", "left")
    paired = F.col("gen").isin(*PAIRED)
    quick = F.when(F.col("target_al").isNull() & F.col("rejected_al").isNull(), "text").when(~paired & F.coalesce("error_clean", F.lit(False)) & verbatim(F.col("target_al"), F.col("origin")), "verbatim")
    split = base.withColumn("via", quick)
    decided = split.where("via is not null").withColumn("kept", F.lit(True)).withColumn("reason", F.col("via"))
    open_ = split.where("via is null")
    good, _ = with_memo(open_, "target_al", memo, check)
    good = good.withColumnRenamed("codes", "good_codes")
    bad, _ = with_memo(good, "rejected_al", memo, check)
    bad = bad.withColumnRenamed("codes", "bad_codes")
    sound, broken = F.coalesce(is_clean(F.col("good_codes")), F.lit(True)), F.coalesce(~is_clean(F.col("bad_codes")), F.lit(False))
    reason = F.when(~sound, "target has errors").when(paired & ~broken, "rejected side compiles").when(paired, "pair").otherwise("compiles")
    late = bad.withColumn("reason", reason).withColumn("kept", reason.isin("pair", "compiles")).withColumn("via", F.lit("check")).drop("good_codes", "bad_codes")
    return decided.unionByName(late)


def _in_files(places: DataFrame, files: DataFrame, hot: DataFrame, then: Callable[[str], tuple], schema: str) -> DataFrame:
    """(_place, then(text)) for every place whose member its file has: ``text`` is the file with the place's text in the member's stead.

    ``places``: app, path, _place, member, signature, text; ``files``: one row
    per app and path; ``hot``: app, path and _n, into how many parts a file with
    many places goes. A file's text stands before its places in one sorted
    stream, once per part, and is parsed once; no spliced text leaves its task.
    """
    from ..functions import al

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = src = None
        for batch in batches:
            out = []
            for app, path, part, place, member, signature, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place is None:
                    at, src = (app, path, part), text
                elif at == (app, path, part) and (m := al.find_member(src, member or "", signature)):
                    out.append((place, *then(al.splice(src, m, text))))
            columns = list(zip(*out)) if out else [()] * len(made)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, made)], schema=made)

    struct = T.StructType.fromDDL(f"_place long, {schema}")
    made = to_arrow_schema(struct)
    parts = F.coalesce("_n", F.lit(1))
    heads = files.join(hot, ["app", "path"], "left").select("app", "path", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"), *[F.lit(None).cast(k).alias(c) for c, k in (("_place", "long"), ("member", "string"), ("signature", "string"))], "text")
    rows = places.join(hot, ["app", "path"], "left").select("app", "path", F.pmod("_place", parts).cast("int").alias("_part"), "_place", "member", "signature", "text")
    keys = ["app", "path", "_part"]
    return spread(heads.unionByName(rows), *keys).sortWithinPartitions(*keys, F.col("_place").asc_nulls_first()).mapInArrow(run, struct)


def codes_in_file(places: DataFrame, files: DataFrame, check: Check, memo: DataFrame | None, scratch: Scratch, part: int = 1024) -> DataFrame:
    """(_place, codes) of every place that its file has, ``files`` and ``places`` as for ``_in_files``.

    The first pass gives every spliced text its memo key, the second checks one
    place of each key that the memo lacks. Splicing twice is cheaper than moving
    a file's text once per place.
    """

    def checked(text: str) -> tuple:
        try:
            return sha256(text.encode()).hexdigest(), sorted(check(text))
        except Exception:
            return sha256(text.encode()).hexdigest(), ["EXCEPTION"]

    hot = places.groupBy("app", "path").agg(F.ceil(F.count("*") / part).cast("int").alias("_n")).where("_n > 1")
    hot = scratch.write(hot, "hot-files")
    keys = scratch.write(_in_files(places, files, hot, lambda text: (sha256(text.encode()).hexdigest(),), "key string"), "keys")
    known = places.sparkSession.createDataFrame([], "key string, codes array<string>") if memo is None else memo.select("key", "codes")
    open_ = keys.join(known, "key", "left_anti") if memo is not None else keys
    first = scratch.write(open_.groupBy("key").agg(F.min("_place").alias("_place")).select("_place"), "first-places")
    fresh = _in_files(places.join(first, "_place", "left_semi"), files, hot, checked, "key string, codes array<string>").drop("_place")
    known = known.unionByName(scratch.write(fresh, "fresh-codes"))
    return scratch.write(keys.join(known, "key").select("_place", "codes"), "codes")


def verified(candidates: DataFrame, baselines: DataFrame, files: DataFrame, check: Check, *, mode: str = "inapp", memo: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Candidates with kept, reason and via, checked in the file they come from (``inapp``) or alone (``compile``).

    ``candidates``: gen, target_al, rejected_al, app, path, member, signature;
    ``files``: app, path, text; ``baselines``: app, error_clean. In-app, pairs
    count only in apps that were clean, and break them with the rejected side in
    place; other targets are clean with the target in place, or unseen where they
    are their member (or stand in their file) as it was and the app was clean;
    objects that do not stand in their file go into a fresh app under an id of
    their own. Every distinct file text is checked once, whatever its app, so a
    hot app is as many tasks as it has texts. Text answers are kept unseen.
    Candidates are written once and file texts meet them where they are looked
    at, so that neither the plan nor the work repeats what led to them.
    """
    from ..functions import al

    if mode == "compile":
        return verdicts(candidates.withColumn("origin", F.lit(None).cast("string")), baselines, check, memo)
    if mode != "inapp":
        raise ValueError(f"no such mode: {mode}")
    scratch = scratch or Scratch(candidates.sparkSession, "inapp")
    files = scratch.write(files.where("app is not null and path is not null and text is not null").groupBy("app", "path").agg(F.min("text").alias("text")), "files")
    place = lambda text: F.when(F.col(text).isNotNull(), F.xxhash64("app", "path", "member", "signature", text))
    base = candidates.join(baselines.select("app", "error_clean").dropDuplicates(["app"]), "app", "left").join(files.select("app", "path", F.lit(True).alias("_file")), ["app", "path"], "left")
    base = scratch.write(base.withColumns({"_good": place("target_al"), "_bad": place("rejected_al"), "_text": F.xxhash64("target_al")}), "candidates")
    paired, clean = F.col("gen").isin(*PAIRED), F.coalesce("error_clean", F.lit(False))
    whole = F.col("gen") == "g6_spec2object"
    early = F.when(F.col("target_al").isNull(), "text").when(F.col("_file").isNull(), "no origin").when(paired & ~clean, "origin not clean")
    asked = base.where(early.isNull() & ~paired & clean).select("app", "path", "_text", "target_al").dropDuplicates(["app", "path", "_text"])
    found = asked.join(files, ["app", "path"]).where(verbatim(F.col("target_al"), F.col("text"))).select("app", "path", "_text", F.lit(True).alias("_verbatim"))
    base = base.join(scratch.write(found, "verbatim"), ["app", "path", "_text"], "left")
    via = F.coalesce(early, F.when(~paired & clean & F.col("_verbatim"), "verbatim"), F.when(whole, "fresh-app"), F.lit("inapp"))
    base = scratch.write(base.withColumn("via", via).drop("_file", "_verbatim"), "seen")
    own = ["_good", "_bad", "_text"]
    done = base.where(~F.col("via").isin("fresh-app", "inapp")).withColumn("kept", F.col("via").isin("text", "verbatim")).withColumn("reason", F.col("via")).drop(*own)
    open_ = base.where(F.col("via").isin("fresh-app", "inapp"))

    def alone(keys: list, texts: list) -> list[tuple]:
        return [(k, al.with_object_id(al.wrapped(x)[0], 50000)) for k, x in zip(keys, texts)]

    new = open_.where("via = 'fresh-app'").select("_text", "target_al").dropDuplicates(["_text"])
    made = scratch.write(map_rows(new, alone, "_text long, in_file string"), "objects")
    fresh = scratch.write(with_memo(made, "in_file", memo, check)[0].select("_text", F.col("codes").alias("_fresh")), "fresh-objects")
    sides = [open_.where(f"{key} is not null" + more).select("app", "path", F.col(key).alias("_place"), "member", "signature", F.col(text).alias("text")) for key, text, more in (("_good", "target_al", " and via = 'inapp'"), ("_bad", "rejected_al", ""))]
    places = scratch.write(sides[0].unionByName(sides[1]).dropDuplicates(["_place"]), "places")
    codes = codes_in_file(places, files, check, memo, scratch)
    late = open_.join(codes.select(F.col("_place").alias("_good"), F.col("codes").alias("_in")), "_good", "left").join(codes.withColumnsRenamed({"_place": "_bad"}), "_bad", "left").join(fresh, "_text", "left")
    good = F.when(F.col("via") == "fresh-app", F.col("_fresh")).otherwise(F.col("_in"))
    sound, broken = F.coalesce(is_clean(good), F.lit(False)), F.coalesce(~is_clean(F.col("codes")), F.lit(False))
    reason = F.when(~sound, "target has errors").when(paired & ~broken, "rejected side compiles").when(paired, "pair").otherwise("compiles")
    late = late.withColumn("reason", reason).withColumn("kept", reason.isin("pair", "compiles")).drop(*own, "_in", "_fresh", "codes")
    return done.unionByName(late)


def pass_rates(verdicts_: DataFrame, *by: str) -> DataFrame:
    """(by, n_in, n_kept, pass_rate)."""
    n = verdicts_.groupBy(*by).agg(F.count("*").alias("n_in"), F.count_if("kept").alias("n_kept"))
    return n.withColumn("pass_rate", F.round(F.col("n_kept") / F.greatest("n_in", F.lit(1)), 3))


def baselines(apps: DataFrame, files: DataFrame, check: Check) -> DataFrame:
    """(app, error_clean, n_errors, error_codes, n_analyzer_hits, analyzer_rules, exception) of every app over its files.

    ``files``: app, text. Files are checked one by one, so an app of a third of
    all files is many tasks; a failing check is the app's exception.
    """
    from .extract import is_analyzer

    def run(apps_: list, texts: list) -> list[tuple]:
        rows = []
        for app, text in zip(apps_, texts):
            try:
                rows += [(app, c, None) for c in check(text)]
            except Exception as e:
                rows.append((app, None, f"{type(e).__name__}: {e}"))
        return rows

    found = map_rows(files.select("app", "text").where("app is not null and text is not null"), run, f"app {files.schema['app'].dataType.simpleString()}, code string, exception string")
    err = F.when(~is_analyzer(F.col("code")), F.col("code"))
    hit = F.when(is_analyzer(F.col("code")), F.col("code"))
    per = found.groupBy("app").agg(F.count(err).alias("n_errors"), F.array_sort(F.collect_set(err)).alias("error_codes"), F.count(hit).alias("n_analyzer_hits"), F.array_sort(F.collect_set(hit)).alias("analyzer_rules"), F.min("exception").alias("exception"))
    full = apps.select("app").distinct().join(per, "app", "left")
    return full.select("app", (F.coalesce("n_errors", F.lit(0)) == 0).__and__(F.col("exception").isNull()).alias("error_clean"), F.coalesce("n_errors", F.lit(0)).alias("n_errors"), F.coalesce("error_codes", F.array().cast("array<string>")).alias("error_codes"), F.coalesce("n_analyzer_hits", F.lit(0)).alias("n_analyzer_hits"), F.coalesce("analyzer_rules", F.array().cast("array<string>")).alias("analyzer_rules"), "exception")


def brackets_check(text: str) -> list[str]:
    """A stand-in for a compiler: balance of blocks and brackets, semicolons and keywords, as codes."""
    from ..functions.al import known_tokens

    t = known_tokens(text)
    low = [x.low for x in t]
    out = []
    depth = low.count("begin") + low.count("case") - low.count("end")
    if depth:
        out.append("AL0104")
    for a, b in (("(", ")"), ("[", "]"), ("{", "}")):
        if low.count(a) != low.count(b):
            out.append("AL0104")
    in_case, waiting = False, 0  # ifs whose then is still to come
    for i, w in enumerate(low):
        if w == "case":
            in_case = True
        elif w == "else" and i and low[i - 1] == ";" and not in_case:
            out.append("AL0110")
        elif w == "if":
            waiting += 1
        elif w == "then":
            if not waiting:
                out.append("AL0104")
            waiting = max(0, waiting - 1)
        elif w == "var" and i + 2 < len(low) and low[i + 1] in ("begin", "then", "end", "case", "trigger", "procedure") and low[i + 2] == ":":
            out.append("AL0105")
    out += ["AL0104"] * waiting
    known = set()
    begin = low.index("begin") if "begin" in low else len(low)
    for i in range(begin):
        if low[i] == ":" and i:
            known.add(low[i - 1])
    for i in range(begin, len(t)):
        if t[i].kind == "word" and low[i].endswith("2") and low[i] not in known and low[i][:-1] in known:
            out.append("AL0118")
    return out


def repaired(broken: DataFrame, repair: Callable[[str], tuple[str | None, str]]) -> DataFrame:
    """(record_id, fixed, method) for broken(record_id, text), the repair run once per row."""

    def run(ids: list, texts: list) -> list[tuple]:
        return [(rid, *(repair(x) if x is not None else (None, "unfixable:null"))) for rid, x in zip(ids, texts)]

    return map_rows(broken.select("record_id", "text"), run, "record_id long, fixed string, method string")
