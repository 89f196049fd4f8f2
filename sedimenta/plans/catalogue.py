"""The registry of queries: each wires operators to the whole tables of one folder.

``oracle_sql`` holds the same query for a SQL engine wherever SQL can say it;
the other queries are tested against plain models in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import repair as R
from ..functions import text as X
from ..functions.arrow import flat_map
from ..functions.paths import clean_path, group_of, place
from ..operators import assemble, decontam, dedup, extract, gate, generate, mutate, names, report, sections, split
from ..session import Scratch
from ..sources.tables import allowed_sources

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.one_per_id(_t(spark, sf, "members"), "member_id", "mined_at", "loaded_at")


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return _members(spark, sf).withColumnRenamed("member_id", "record_id")


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.one_per_id(_t(spark, sf, "candidates"), "cand_id", "made_at").select("*", "meta.path", "meta.object", "meta.repo")


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.one_per_id(_t(spark, sf, "source_files"), "file_id", "loaded_at")


def _apps(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "apps").withColumnRenamed("app_id", "app")


def _answer() -> F.Column:
    return F.coalesce(assemble.last_content(F.col("messages")), F.lit(""))


def _hits(spark: SparkSession, sf: str, col: str = "analyzer_hits") -> DataFrame:
    return _members(spark, sf).select("member_id", "path", "object_kind", "repo", F.explode(col).alias("h")).select("*", "h.code", "h.severity", "h.line").drop("h")


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    """Line ranges of members, laid out one after another in their file."""
    from pyspark.sql import Window as W

    w = W.partitionBy("path").orderBy("member_id").rowsBetween(W.unboundedPreceding, -1)
    m = _members(spark, sf).where("path is not null").withColumn("n", F.greatest(F.col("body_loc") + 6, F.lit(1)))
    return m.withColumn("start_row", F.coalesce(F.sum("n").over(w), F.lit(0))).select(F.col("member_id").alias("owner"), "path", "start_row", (F.col("start_row") + F.col("n") - 1).alias("end_row"))


# ---------------------------------------------------------------- corpus funnel, dedup, decontamination


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to split counts: exact dedup, benchmark passages out, whole sources held out, counts per split and language."""
    docs = dedup.exact_dedup(_t(spark, sf, "documents"), F.col("text"), "doc_id")
    leaked = decontam.containing(docs, "doc_id", F.col("text"), _t(spark, sf, "benchmark"), "item_id", "text")
    clean = docs.join(leaked.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_anti")
    part = F.when(split.held_out(F.lower(F.trim("source"))), "heldout").otherwise("train")
    return clean.groupBy(part.alias("part"), F.coalesce("lang", F.lit("unknown")).alias("lang")).agg(F.count("*").alias("n_docs"))


def exact_dedup_documents(spark, sf):
    """Documents kept by exact dedup of normalised text."""
    return dedup.exact_dedup(_t(spark, sf, "documents"), F.col("text"), "doc_id").select("doc_id")


def exact_dedup_candidates(spark, sf):
    """Candidates kept by exact dedup inside each generator, keyed by what their kind is deduplicated by."""
    c = _candidates(spark, sf)
    text = dedup.dedup_text(assemble.first_content(F.col("messages")), _answer(), F.col("target_al"), F.col("rejected_al"))
    return dedup.exact_dedup(c, text, "cand_id", "gen").select("cand_id", "gen")


def _failed(spark, sf, *exceptions: str) -> DataFrame:
    """Folder names of apps whose baseline failed (so), as path fragments."""
    a = _t(spark, sf, "apps").where(F.col("exception").isin(*exceptions) if exceptions else F.col("exception").isNotNull())
    return a.select(F.concat(F.lit("/"), F.element_at(F.split("app_dir", "/"), -2), F.lit("/")).alias("f"))


def _gated(spark, sf) -> DataFrame:
    """Candidates with the first gate that stops them: licence, a folder of an app that failed, a prompt of an automation account; and their dedup text."""
    c = decontam.licence_gate(_candidates(spark, sf), "repo", _t(spark, sf, "sources"))
    by_path = decontam.path_contaminated(F.col("path"), _failed(spark, sf), c).select("cand_id", F.lit(1).alias("bad_path"))
    block = decontam.blocklist(c.where(F.lower("meta.author").isin("build-agent", "merge-queue")).select(assemble.first_content(F.col("messages")).alias("prompt")), ["prompt"])
    by_prompt = decontam.equal_prompts(c, assemble.first_content(F.col("messages")), block.select("value")).select("cand_id", F.lit(1).alias("bad_prompt"))
    c = c.join(by_path, "cand_id", "left").join(by_prompt, "cand_id", "left")
    stop = F.when(~F.col("licence_ok"), "license").when(F.col("bad_path") == 1, "contam_path").when(F.col("bad_prompt") == 1, "contam_prompt")
    return c.select("cand_id", "gen", stop.alias("gate"), dedup.dedup_text(assemble.first_content(F.col("messages")), _answer(), F.col("target_al"), F.col("rejected_al")).alias("text"))


def filter_drop_reasons(spark, sf):
    """The gates in order: licence, path, prompt, exact duplicate; the first that hits counts."""
    c = _gated(spark, sf)
    kept = dedup.exact_dedup(c.where("gate is null"), F.col("text"), "cand_id", "gen").select("cand_id", F.lit("kept").alias("k"))
    return c.join(kept, "cand_id", "left").groupBy("gen", F.coalesce("gate", "k", F.lit("exact")).alias("reason")).agg(F.count("*").alias("n"))


def filter_near(spark, sf):
    """All gates and the near-duplicate one as the last; bands are hashes, so SQL has no counterpart (tests compare with a plain pass)."""
    scratch = Scratch(spark, "filter")
    c = scratch.write(_gated(spark, sf), "gated")
    exact = scratch.write(dedup.exact_dedup(c.where("gate is null"), F.col("text"), "cand_id", "gen").select("cand_id", "gen", "text"), "exact")
    near = dedup.keep_first(exact.select("cand_id"), dedup.minhash_bands(exact, "cand_id", F.col("text"), "gen"), scratch)
    c = c.join(exact.select("cand_id", F.lit("near").alias("n_")), "cand_id", "left").join(near.withColumn("k", F.lit("kept")), "cand_id", "left")
    return c.groupBy("gen", F.coalesce("gate", "k", "n_", F.lit("exact")).alias("reason")).agg(F.count("*").alias("n"))


def outside_slow_apps(spark, sf):
    """Members outside the apps whose baseline ran into the time limit."""
    return decontam.path_contaminated(F.col("path"), _failed(spark, sf, "timeout"), _members(spark, sf).select("member_id", "path"), outside=True).select("member_id")


def page_paths(spark, sf):
    """Documentation answers per generator's page path: in the teaching tree or not."""
    d = _candidates(spark, sf).where("meta.doc_section is not null").select(F.concat(F.lit("docs/"), "meta.doc_section", F.lit("/"), F.col("meta.heading")).alias("p"))
    return d.select(sections.path_teaches(F.col("p")).alias("teaches")).groupBy("teaches").agg(F.count("*").alias("n"))


def decontam_exact(spark, sf):
    """Documents of other sources whose whole normalised text is one of the docs portal."""
    d = _t(spark, sf, "documents").withColumn("portal", F.coalesce(F.regexp_replace(F.lower(F.trim("source")), r"[\s_]+", "-") == "docs-portal", F.lit(False)))
    block = decontam.blocklist(d.where("portal"), ["text"]).where("kind = 'prompt'").select("value")
    return decontam.equal_prompts(d.where("not portal"), F.col("text"), block).select("doc_id")


def decontam_substring(spark, sf):
    """Documents that contain a whole benchmark text of 40 characters or more."""
    return decontam.containing(_t(spark, sf, "documents"), "doc_id", F.col("text"), _t(spark, sf, "benchmark"), "item_id", "text").select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"))


def license_gate_members(spark, sf):
    """Members per repository that the licence gate passes or stops; unknown repositories pass."""
    return decontam.licence_gate(_members(spark, sf), "repo", _t(spark, sf, "sources")).groupBy("repo", "licence_ok").agg(F.count("*").alias("n"))


def allowed_repositories(spark, sf):
    return allowed_sources(_t(spark, sf, "sources")).select("src_key", "spdx", "src_role", "commit_id")


def shingle_stats(spark, sf):
    """Distinct five-word shingles per candidate answer."""
    c = _candidates(spark, sf)
    return c.select("cand_id", F.size(X.shingles(X.norm(_answer()), 5)).alias("n_shingles"))


def near_dup_pairs_exact(spark, sf):
    """Pairs of different candidate answers with shingle overlap of 0.8 or more, verified."""
    c = dedup.one_per_id(_t(spark, sf, "candidates").select("cand_id", _answer().alias("answer")), "cand_id")  # answers move, not whole rows
    return dedup.shared_shingle_pairs(c, "cand_id", F.col("answer"), scratch=Scratch(spark, "pairs")).select("id_a", "id_b", F.round("jaccard", 6).alias("jaccard"))


def near_dup_keep_first(spark, sf):
    """Candidates the sequential near-duplicate pass of each generator keeps (approximate bands, unverified, as defined)."""
    c = exact_dedup_candidates(spark, sf).join(_candidates(spark, sf).drop("gen"), "cand_id")
    text = dedup.dedup_text(assemble.first_content(F.col("messages")), _answer(), F.col("target_al"), F.col("rejected_al"))
    bands = dedup.minhash_bands(c, "cand_id", text, "gen")
    return dedup.keep_first(c.select("cand_id"), bands, Scratch(spark, "keep"))


# ---------------------------------------------------------------- samples, splits, caps


def hash_sample_members(spark, sf):
    return split.hash_sample(_members(spark, sf), F.col("path"), 10).select("member_id")


def heldout_by_group(spark, sf):
    """Candidates per generator held out with their folder."""
    c = _candidates(spark, sf)
    return c.withColumn("held", split.held_out(group_of(F.col("path"), F.col("object"), F.col("gen")))).groupBy("gen", "held").agg(F.count("*").alias("n"))


def kind_cap_candidates(spark, sf):
    """Candidates without a rejected side, at most 35 percent of them per generator."""
    c = _candidates(spark, sf).where("coalesce(length(rejected_al), 0) = 0")
    return split.kind_cap(c, "gen", _answer(), "cand_id", 0.35).select("cand_id", "gen")


def val_split_candidates(spark, sf):
    c = _candidates(spark, sf).select("cand_id")
    return split.val_split(c, "cand_id").select("cand_id", "is_val")


def stride_sample_members(spark, sf):
    m = _members(spark, sf).where("has_body and body_loc between 3 and 40").select("member_id")
    return split.stride_sample(m, "member_id", 110)


def seeded_take(spark, sf):
    """Fifty members in the order of a seeded hash (a sampling operator)."""
    h = F.sha1(F.concat(F.lit("7:"), F.col("member_id").cast("string")))
    return split.first_n(_members(spark, sf).select("member_id"), [h, F.col("member_id")], 50)


def triple_cap_mutants(spark, sf):
    """Mutants accepted under caps per mutation, file and app, in the order of their text's hash."""
    r = _records(spark, sf)
    pairs = mutate.error_fix_pairs(r).where("path is not null").withColumn("app", F.substring_index(F.replace("path", F.lit("\\"), F.lit("/")), "/", 5))
    pairs = pairs.withColumn("_id", F.concat_ws(":", "record_id", "position"))
    kept = split.triple_cap(pairs, {"mutation": 600, "path": 6, "app": 150}, [F.sha1("target_al"), F.col("position"), F.col("record_id")])
    return kept.select("record_id", "mutation")


# ---------------------------------------------------------------- apps, joins, incremental


def members_by_app(spark, sf):
    """The app of every member, by the deepest app folder above its path, else by its own app folder."""
    m = _members(spark, sf).select("member_id", "path", "app_dir")
    where = place(m.select(F.explode(F.array("path", "app_dir"))), _apps(spark, sf))
    by_path, by_dir = where.select("path", F.col("app").alias("a1")), where.select(F.col("path").alias("app_dir"), F.col("app").alias("a2"))
    return m.join(by_path, "path", "left").join(by_dir, "app_dir", "left").select("member_id", F.coalesce("a1", "a2").alias("app_id"))


def clean_app_members(spark, sf):
    """Members that the clean-app restriction keeps: their app is clean, or they are in none."""
    apps = _apps(spark, sf).select(F.col("app").alias("app_id"), "error_clean")
    return members_by_app(spark, sf).join(apps, "app_id", "left").where(F.col("app_id").isNull() | F.coalesce("error_clean", F.lit(False))).select("member_id")


def candidate_baselines(spark, sf):
    """Candidates with the baseline of their app (left join on the normalised folder)."""
    c = _candidates(spark, sf).select("cand_id", "gen", "path")
    where = place(c.select("path"), _apps(spark, sf))
    both = c.join(where, "path", "left").join(_apps(spark, sf).select("app", "error_clean", "symbol_version"), "app", "left")
    return both.groupBy("gen", "error_clean", "symbol_version").agg(F.count("*").alias("n"))


def resume_anti_join(spark, sf):
    """Members with a body for which no candidate was generated yet, by path and name."""
    from ..streaming.incremental import not_done

    key = lambda p, n: F.concat_ws("::", p, n)
    done = _candidates(spark, sf).select(key(clean_path(F.col("path")), F.col("meta.member")).alias("key"))
    m = _members(spark, sf).where("has_body and path is not null").withColumn("key", key(clean_path(F.col("path")), F.col("member_name")))
    return not_done(m, done, "key").select("member_id")


def severity_templates(spark, sf):
    """Analyzer findings per code with a message, from a two-part catalogue where the first part wins."""
    first = spark.createDataFrame([("AA0137", "unused variable"), ("LC0003", "magic number"), ("AW0006", "page style")], "code string, message string")
    safety = spark.createDataFrame([("LC0003", "from the safety net"), ("FC0001", "spacing"), ("DC0004", "missing documentation")], "code string, message string")
    catalogue = report.merged_by_priority([first, safety], "code")
    hits = _hits(spark, sf)
    return hits.join(F.broadcast(catalogue), "code", "left").groupBy("code", report.severity(F.col("severity")).alias("severity"), F.coalesce("message", F.lit("")).alias("message")).agg(F.count("*").alias("n"))


#: Names of the compiler codes in the tables, and what some analyzer rules say; and entries that win over the rules.
CODE_NAMES = {
    "AL0104": "ERR_SyntaxErrorTokenExpected", "AL0111": "ERR_SemicolonExpected", "AL0118": "ERR_NameNotInContext", "AL0132": "ERR_NoSuchMember", "AL0185": "ERR_AppObjectNotFound",
    "AL0432": "WRN_ObsoleteObjectReference", "AL0606": "ERR_BadTypeArgumentList",
}
RULE_TEXTS = {
    "AA0008": "Calls need parentheses", "AA0021": "Variables are sorted by type", "AA0137": "Unused variable", "AA0181": "Find and Next belong together", "AA0205": "Uninitialized variable", "AA0215": "Casing of file names",
    "AC0012": "Check the result of Get", "AW0006": "Page style", "DC0004": "Missing documentation", "FC0001": "Space around operators", "LC0003": "Magic number", "LC0015": "Use qualified names",
    "PC0007": "Avoid loops of database calls", "TA0002": "Test without assertion", "UI0005": "Caption missing",
}
OVERRIDES = [("AL0104", "high", "deterministic", "delete_token"), ("AL0111", "high", "deterministic", "delete_semicolon"), ("AL0132", "high", "model", "rename_member"), ("AL0432", "low", "model", "reference_obsolete")]


def _codes(spark, sf) -> DataFrame:
    names = spark.createDataFrame([*((c, n, None) for c, n in CODE_NAMES.items()), *((c, None, t) for c, t in RULE_TEXTS.items())], "code string, name string, text string")
    both = _hits(spark, sf).select("code", "severity").unionByName(_hits(spark, sf, "error_hits").select("code", "severity"))
    said = F.when(F.startswith("name", F.lit("ERR_")), "error").when(F.startswith("name", F.lit("WRN_")), "warning").otherwise(F.col("severity"))
    return both.join(names, "code", "left").withColumn("severity", said)  # of a compiler code its catalogue says how severe it is


def diagnostic_categories(spark, sf):
    """Findings of both kinds per category of their code, compiler codes by their name."""
    return _codes(spark, sf).groupBy(report.diagnostic_category(F.col("code"), F.col("name")).alias("category")).agg(F.count("*").alias("n"))


def error_catalogue(spark, sf):
    """The codes of the findings with category, likelihood, strategy and mutation; entries given by hand win."""
    given = spark.createDataFrame(OVERRIDES, "code string, likelihood string, strategy string, mutation string")
    return report.diagnostics_catalogue(_codes(spark, sf), given).drop("severity")


def likely_codes(spark, sf):
    """The 40 codes a writing model causes most likely, by the rules alone (a top-k report)."""
    return report.ranked_by_likelihood(report.diagnostics_catalogue(_codes(spark, sf)), 40).select("code", "likelihood", "strategy", "mutation")


# ---------------------------------------------------------------- diagnostics


def parse_diagnostics(spark, sf):
    """Compiler logs back to rows: the members' findings written as log lines and parsed again."""
    h = _hits(spark, sf).unionByName(_hits(spark, sf, "error_hits")).where("path is not null")
    line = F.concat(F.replace("path", F.lit("/"), F.lit("\\")), F.lit("("), "line", F.lit(",7): "), "severity", F.lit(" "), "code", F.lit(": found here"))
    logs = h.groupBy("repo", "path").agg(F.concat_ws("\n", F.lit("building"), F.collect_list(line), F.lit("done")).alias("log"))
    parsed = extract.parse_diagnostics(logs, "log", "repo")
    return parsed.groupBy("repo", "severity", "code", extract.is_analyzer(F.col("code")).alias("analyzer")).agg(F.count("*").alias("n"), F.sum("line").alias("lines"))


def diagnostics_interval_join(spark, sf):
    """Findings per member by line range: the interval join of findings and members of a file."""
    hits = _hits(spark, sf).select("path", "line", "code").where("path is not null")
    owned = extract.attribute(hits, _spans(spark, sf))
    return owned.groupBy("owner").agg(F.count("*").alias("n"), F.countDistinct("code").alias("n_codes"))


def near_hits(spark, sf):
    """Pairs of a compiler error and an analyzer finding of one member at most one line apart."""
    a = _hits(spark, sf, "error_hits").select("member_id", "line", F.col("code").alias("error"))
    b = _hits(spark, sf).select("member_id", "line", F.col("code").alias("finding"))
    return extract.near_hits(a, b, ["member_id"]).groupBy("error", "finding").agg(F.count("*").alias("n"))


def code_histogram_topk(spark, sf):
    return report.top_k(_hits(spark, sf), ["object_kind"], "code", 8)


def mode_code(spark, sf):
    return report.mode(_hits(spark, sf), ["object_kind"], "code")


def code_combinations(spark, sf):
    """How often a combination of codes occurs on one member."""
    per = _hits(spark, sf).groupBy("member_id").agg(F.array_join(F.array_sort(F.collect_list("code")), "|").alias("combination"))
    return per.groupBy("combination").agg(F.count("*").alias("n"))


def multiset_difference(spark, sf):
    """Codes that apps of the newest symbol versions show beyond those of the others, as multisets per repository."""
    codes = _apps(spark, sf).select(F.coalesce("repo", F.lit("")).alias("repo"), (F.col("symbol_version") >= "24").alias("new"), F.explode("error_codes").alias("code"))
    return mutate.new_codes(codes.where("not new"), codes.where("new"), "repo")


def baseline_codes(spark, sf):
    """Sorted distinct error codes per repository, and the rate of clean apps."""
    a = _apps(spark, sf).select(F.coalesce("repo", F.lit("")).alias("repo"), "error_clean", "app", "error_codes")
    codes = a.select("repo", F.explode("error_codes").alias("c")).groupBy("repo").agg(F.array_join(F.array_sort(F.collect_set("c")), ",").alias("codes"))
    rates = a.groupBy("repo").agg(F.count("*").alias("n_apps"), report.rate(F.count_if("error_clean"), F.count("*")).alias("clean_rate"))
    return rates.join(codes, "repo", "left")


def loc_buckets(spark, sf):
    return _members(spark, sf).groupBy("member_kind", report.loc_bucket(F.col("body_loc")).alias("bucket")).agg(F.count("*").alias("n"))


def rate_rollup(spark, sf):
    """Members with findings per object kind, with the row of all."""
    m = _members(spark, sf).withColumn("hit", (F.size("analyzer_hits") > 0).cast("int"))
    r = m.rollup("object_kind").agg(F.count("*").alias("n"), F.sum("hit").alias("n_hit"), report.rate(F.sum("hit"), F.count("*")).alias("rate"))
    return r.withColumn("object_kind", F.coalesce("object_kind", F.lit("ALL")))


def ranked_codes(spark, sf):
    """The 40 codes with the most findings (a top-k report)."""
    n = _hits(spark, sf).groupBy("code").agg(F.count("*").alias("n"))
    return split.first_n(n, [F.desc("n"), F.col("code")], 40)


def memo_lookup(spark, sf):
    """Distinct validator inputs per generator, and how many a memo of the pairs' targets would answer."""
    c = _candidates(spark, sf).where("target_al is not null").select("gen", gate.memo_key(F.col("target_al")).alias("key"))
    memo = _candidates(spark, sf).where("rejected_al is not null").select(gate.memo_key(F.col("target_al")).alias("key")).distinct().withColumn("known", F.lit(1))
    return c.distinct().join(memo, "key", "left").groupBy("gen").agg(F.count("*").alias("n_inputs"), F.count("known").alias("n_known"))


def work_chunks(spark, sf):
    """Pairs per app in chunks of 40: the units of work of the expensive stage."""
    c = _candidates(spark, sf).where("gen = 'g5_error_fix' and path is not null").withColumn("app", F.substring_index(clean_path(F.col("path")), "/", 5))
    return split.chunks(c, "app", order="cand_id").groupBy("app", "chunk").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- generation


def g1_candidates(spark, sf):
    g = generate.complete_body(_records(spark, sf))
    return g.select("record_id", "object", F.sha1(assemble.first_content(F.col("messages"))).alias("prompt_sha"), F.sha1(assemble.last_content(F.col("messages"))).alias("answer_sha"))


def g2_candidates(spark, sf):
    g = generate.body_from_intent(_records(spark, sf))
    return g.select("record_id", F.sha1(assemble.first_content(F.col("messages"))).alias("prompt_sha"))


def g3_candidates(spark, sf):
    g = generate.explain(_records(spark, sf))
    return g.select("record_id", assemble.last_content(F.col("messages")).alias("answer"))


def g5_candidates(spark, sf):
    return mutate.error_fix_pairs(_records(spark, sf)).select("record_id", "mutation", "rejected_al", F.array_join("expected_diagnostic", ",").alias("expected"))


def g6_candidates(spark, sf):
    f = _files(spark, sf)
    apps = _apps(spark, sf)
    clean = place(f.select("path"), apps).join(apps.where("error_clean").select("app"), "app").select("path")
    f = f.join(clean, "path", "left_semi")  # verbatim objects count only where their app compiles
    o = extract.objects(f, "file_id", "content").where("error is null").join(f.select("file_id", "repo", "path"), "file_id")
    return generate.objects_from_spec(o.withColumn("record_id", F.col("file_id") * 1000 + F.col("object_no"))).select("record_id", "object", assemble.first_content(F.col("messages")).alias("prompt"))


def g8_reviews(spark, sf):
    templates = spark.createDataFrame([("AA0137", "unused variable"), ("LC0003", "magic number")], "code string, message string")
    g = generate.review(_records(spark, sf), templates)
    return g.select("record_id", F.array_join("rules", ",").alias("rules"), assemble.last_content(F.col("messages")).alias("answer"))


def g7_probes(spark, sf):
    return generate.probes(_records(spark, sf)).groupBy("probe_of", "repo").agg(F.count("*").alias("n"))


def g7_hard_negatives(spark, sf):
    """Completions of a stand-in model that a stand-in check refuses, with their class."""
    fail = lambda prompt, attempt: prompt  # noqa: E731  # a model that repeats what it was asked
    g = generate.hard_negatives(generate.probes(_records(spark, sf)), fail, gate.brackets_check)
    return g.select("record_id", "probe_of", "hallucination_class", F.array_join("error_codes", ",").alias("codes"))


def page_sections(spark, sf):
    """Sections of documents at headings of level 2 and 3."""
    s = sections.sections(_t(spark, sf, "documents"), "doc_id", "text")
    return s.groupBy("id").agg(F.count("*").alias("n_sections"), F.sum(F.length("heading")).alias("heading_chars")).withColumnRenamed("id", "doc_id")


def page_references(spark, sf):
    """Documents that are reference pages, with the name and kind they document."""
    d = _t(spark, sf, "documents").select("doc_id", sections.reference(F.col("text")).alias("r"), sections.front_title(F.col("text")).alias("title"))
    return d.where("r is not null").select("doc_id", F.col("r.name").alias("name"), F.col("r.kind").alias("kind"), "title")


def page_questions(spark, sf):
    """Question-answer rows of documents: reference pages and teaching sections."""
    q = sections.page_questions(_t(spark, sf, "documents"), "doc_id", "text")
    return q.select(F.col("id").alias("doc_id"), "section", "kind", "question", F.length("answer").alias("answer_chars"))


def prose_filter(spark, sf):
    """Documents whose whole text would pass as a teaching body."""
    return _t(spark, sf, "documents").where("text is not null").select("doc_id", F.round(sections.prose_ratio(F.col("text")), 6).alias("prose_ratio"), sections.body_teaches(F.col("text")).alias("teaches"))


def extracted_members(spark, sf):
    """Members of the source files, per file: counts of procedures, triggers and bodies, and lines of bodies."""
    m = extract.members(_files(spark, sf), "file_id", "content")
    return m.groupBy("file_id").agg(F.count("member_no").alias("n_members"), F.count_if(F.col("member_kind") == "trigger").alias("n_triggers"), F.count_if("has_body").alias("n_bodies"), F.sum("body_loc").alias("loc"), F.count("error").alias("n_errors"))


def nearest_name(spark, sf):
    """Member names of candidates that no member has, with the one member name near them."""
    pool = _members(spark, sf).select("member_name").distinct()
    bad = _candidates(spark, sf).select(F.explode(F.regexp_extract_all("rejected_al", F.lit(r"\b(?:procedure|trigger) (\w+)"), F.lit(1))).alias("name")).distinct()
    return names.nearest_names(bad.join(pool, F.col("name") == F.col("member_name"), "left_anti"), pool)


def vocabulary(spark, sf):
    """Size of the vocabulary by initial letter."""
    return names.vocabulary(_members(spark, sf)).groupBy(F.lower(F.substring("name", 1, 1)).alias("initial")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- verification and repair


def verdicts(spark, sf):
    """Candidates through the gate with a stand-in check: kept or not, and why."""
    c = _candidates(spark, sf).select("cand_id", "gen", "path", "target_al", "rejected_al")
    where = place(c.select("path"), _apps(spark, sf))
    m = _members(spark, sf).select(clean_path(F.col("path")).alias("p"), "member_text").where("member_text is not null")
    same = m.groupBy("p", F.sha2(X.norm_ws(F.col("member_text")), 256).alias("h")).agg(F.min("member_text").alias("origin"))
    c = c.join(where, "path", "left").withColumn("p", clean_path(F.col("path"))).withColumn("h", F.sha2(X.norm_ws(F.col("target_al")), 256)).join(same, ["p", "h"], "left")
    v = gate.verdicts(c, _apps(spark, sf).select("app", "error_clean"), gate.brackets_check)
    return v.groupBy("gen", "kept", "reason", "via").agg(F.count("*").alias("n"))


def _findings(text: str) -> list:
    return [R.Finding(1, 1, c, {"AL0104": "'end' expected", "AL0105": "'var' is a keyword"}.get(c, "")) for c in gate.brackets_check(text)]


def autofix_loop(spark, sf):
    """Mutated members through the repair loop with the stand-in check, per mutation."""
    fixer = R.Repairer()
    pairs = mutate.error_fix_pairs(_records(spark, sf)).select("mutation", "target_al", "rejected_al")
    run = lambda texts: [[fixer.repair(x, _findings)] for x in texts]
    done = flat_map(pairs, ["rejected_al"], run, "fixed string, method string")
    return done.groupBy("mutation", "method").agg(F.count("*").alias("n"), F.count_if(F.col("fixed") == F.col("target_al")).alias("n_exact"))


def _trailing(text: str) -> list:
    """A stand-in analyzer: lines with blanks at their end."""
    return [R.Finding(i + 1, 1, "FC9001", "blanks at the end", "warning") for i, x in enumerate(text.split("\n")) if x.rstrip("\r") != x.rstrip("\r").rstrip(" \t")]


def _trimmed(text: str, f) -> str:
    lines = text.split("\n")
    end = "\r" if lines[f.line - 1].endswith("\r") else ""
    lines[f.line - 1] = lines[f.line - 1].rstrip("\r").rstrip(" \t") + end
    return "\n".join(lines)


def g8_fixed_members(spark, sf):
    """Members of source files as they read after a stand-in analyzer's fixes to their file (blanks put at line ends before)."""
    f = _files(spark, sf).select("file_id", "path", F.regexp_replace("content", ";(\r?\n)", "; $1").alias("content"))
    m = extract.members(f, "file_id", "content").where("error is null and has_body")
    m = m.select((F.col("file_id") * 1000 + F.col("object_no") * 100 + F.col("member_no")).alias("record_id"), F.col("file_id").alias("app"), F.lit("").alias("path"), F.col("member_name").alias("member"), "signature")
    fixed = generate.fixed_members(f.select(F.col("file_id").alias("app"), F.lit("").alias("path"), F.col("content").alias("text")), m, _trailing, _trimmed)
    return fixed.select("record_id", F.sha1("fixed_text").alias("fixed_sha"), F.array_join("applied_rules", ",").alias("rules"))


def inapp_pass_rates(spark, sf):
    """Mutants of extracted members, spliced into their files and checked there by the stand-in check: kept and pass rate per reason."""
    f = _files(spark, sf).select("file_id", "content")
    m = extract.members(f, "file_id", "content").where("error is null")
    m = m.withColumn("record_id", F.col("file_id") * 1000 + F.col("object_no") * 100 + F.col("member_no")).withColumn("repo", F.lit(None).cast("string")).withColumn("path", F.lit(""))
    pairs = mutate.error_fix_pairs(m).select("record_id", F.floor(F.col("record_id") / 1000).alias("app"), "path", "gen", "target_al", "rejected_al", "member", "signature", "mutation")
    clean = f.select(F.col("file_id").alias("app"), (F.col("file_id") % 5 != 0).alias("error_clean"))  # a fifth of the stand-in apps was not clean
    v = gate.verified(pairs, clean, f.select(F.col("file_id").alias("app"), F.lit("").alias("path"), F.col("content").alias("text")), gate.brackets_check, scratch=Scratch(spark, "inapp"))
    return gate.pass_rates(v, "mutation", "reason")


def calibration(spark, sf):
    """What each mutation provokes under the stand-in check."""
    pairs = mutate.error_fix_pairs(_records(spark, sf)).select("record_id", "mutation", "target_al", "rejected_al", "expected_diagnostic")
    c = mutate.calibration(pairs, gate.brackets_check)
    return c.select("mutation", "applicable", "any_new", "hit_expected", "any_rate", "hit_rate", "modal_code")


# ---------------------------------------------------------------- assembly


def sharegpt_rows(spark, sf):
    """Candidates as conversations: turns and their roles in order, with a hash of the text."""
    c = _candidates(spark, sf).select("cand_id", assemble.conversations(F.col("messages")).alias("v"))
    return c.select("cand_id", F.array_join(F.transform("v", lambda t: t["from"]), ",").alias("roles"), F.sha1(F.array_join(F.transform("v", lambda t: t["value"]), "\n")).alias("text_sha"))


def preference_pairs(spark, sf):
    p = assemble.preference(_candidates(spark, sf), "cand_id")
    return p.select("cand_id", F.sha1("prompt").alias("prompt_sha"), F.sha1("chosen").alias("chosen_sha"), F.sha1("rejected").alias("rejected_sha"))


def assembled_parts(spark, sf):
    """Where every candidate goes: held out, preference, capped, validation or training."""
    return assemble.routed(_candidates(spark, sf)).groupBy("gen", "part").agg(F.count("*").alias("n"))


def datacard(spark, sf):
    """One row: counts per part and generator."""
    card = assemble.datacard(assemble.routed(_candidates(spark, sf)).select("gen", "part"))
    return card.select(*[c for c in card.columns if not c.endswith("by_gen")], F.to_json("by_gen").alias("by_gen"), F.to_json("heldout_by_gen").alias("heldout_by_gen"))


def incremental_dedup(spark, sf):
    """Documents kept by the streaming variant of exact dedup over the same files."""
    from ..streaming.incremental import dedup_stream

    scratch = Scratch(spark, "stream")
    docs = _t(spark, sf, "documents")
    inbox = scratch.write(docs.select("doc_id", "text"), "inbox")
    dedup_stream(spark, f"{scratch.root}/inbox", inbox.schema, "text", f"{scratch.root}/sink", f"{scratch.root}/checkpoint", order="doc_id")
    return spark.read.parquet(f"{scratch.root}/sink").select("text_hash").distinct().agg(F.count("*").alias("n_kept"))


def events_per_day(spark, sf):
    """Events per day and type: the batch form of the windowed stream count."""
    from ..streaming.incremental import windowed_counts

    return windowed_counts(_t(spark, sf, "events"), "ts", "event_type").select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n")


_QUERIES = [
    exact_dedup_documents, exact_dedup_candidates, filter_drop_reasons, filter_near, outside_slow_apps, page_paths, decontam_exact, decontam_substring, license_gate_members, allowed_repositories, shingle_stats,
    near_dup_pairs_exact, near_dup_keep_first, hash_sample_members, heldout_by_group, kind_cap_candidates, val_split_candidates, stride_sample_members, seeded_take,
    triple_cap_mutants, members_by_app, clean_app_members, candidate_baselines, resume_anti_join, severity_templates, diagnostic_categories, error_catalogue, likely_codes, parse_diagnostics,
    diagnostics_interval_join, near_hits, code_histogram_topk, mode_code, code_combinations, multiset_difference, baseline_codes, loc_buckets, rate_rollup, ranked_codes,
    memo_lookup, work_chunks, g1_candidates, g2_candidates, g3_candidates, g5_candidates, g6_candidates, g7_probes, g7_hard_negatives, g8_reviews, page_sections,
    page_references, page_questions, prose_filter, extracted_members, nearest_name, vocabulary, verdicts, autofix_loop, g8_fixed_members, inapp_pass_rates, calibration, sharegpt_rows, preference_pairs,
    assembled_parts, datacard, incremental_dedup, events_per_day,
]


def queries() -> dict[str, Query]:
    return {"corpus_funnel": flagship} | {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    from .oracle import SQL

    return SQL
