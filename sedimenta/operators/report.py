"""Aggregates for reports: histograms, modes, rates, ranked lists, and a diagnostics catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def loc_bucket(loc: Column) -> Column:
    return F.when(loc == 0, "0").when(loc <= 2, "1-2").when(loc <= 10, "3-10").when(loc <= 30, "11-30").when(loc <= 60, "31-60").otherwise("60+")


def top_k(df: DataFrame, group: list[str], item: str, k: int) -> DataFrame:
    """(group, item, n, rank): the k commonest items of each group; ties to the smaller item. Counted before ranked."""
    n = df.groupBy(*group, item).agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(F.desc("n"), item))).where(F.col("rank") <= k)


def mode(df: DataFrame, group: list[str], item: str) -> DataFrame:
    """(group, item, n): the commonest item of each group; ties to the smaller item. No window, no sort."""
    n = df.groupBy(*group, item).agg(F.count("*").alias("n"))
    return n.groupBy(*group).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(item).alias("i"))).alias("b")).select(*group, F.col("b.i").alias(item), (-F.col("b.m")).alias("n"))


def rate(hits: Column, total: Column, digits: int = 3) -> Column:
    return F.round(hits / F.greatest(total, F.lit(1)), digits)


def merged_by_priority(parts: list[DataFrame], key: str) -> DataFrame:
    """Union of tables of one schema where earlier tables win a key; within a table the row's other columns break ties."""
    df = None
    for i, part in enumerate(parts):
        one = part.withColumn("_rank", F.lit(i))
        df = one if df is None else df.unionByName(one)
    others = [c for c in df.columns if c not in (key, "_rank")]
    best = df.groupBy(key).agg(F.min(F.struct("_rank", *others)).alias("_b"))
    return best.select(key, *[F.col(f"_b.{c}").alias(c) for c in others], F.col("_b._rank").alias("priority"))


def severity(text: Column) -> Column:
    """error, warning or info of any spelling; hidden counts as info, all else as warning."""
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.when(low == "error", "error").when(low.isin("info", "hidden"), "info").otherwise("warning")


# Category of analyzer codes by prefix.
ANALYZER_CATEGORY = {"AA": "analyzer-style", "AW": "analyzer-correctness", "AS": "metadata", "PTE": "metadata", "AC": "analyzer-correctness", "DC": "analyzer-style", "FC": "analyzer-style", "LC": "analyzer-correctness", "PC": "analyzer-correctness", "TA": "analyzer-correctness"}

# Patterns by which the name of a compiler diagnostic, in lower case and without ERR_, WRN_ or INF_, gives
# its category; the first category of which one occurs.
NAME_RULES = {
    "lexical": ["(invalid|bad|malformed).*(literal|comment|escape|token|character)", "unterminated", "invalidmultiline", "invaliddecimal", "invalidint", "invalidnumeric"],
    "obsoletion": ["obsolete", "deprecated", r"\bremoved\b"],
    "permission": ["permission", "license", "entitlement", "protectionlevel", "inaccessible", "isnotaccessible", "access(ibility)?modifier"],
    "metadata": [
        "manifest", r"app\.?json", "appjson", "package", "symbol", "nuget", "dependency", "runtimeversion", "projectmanifest", "translationapp", "xliff", r"\.app\b", "radfile", "fastpublish", "cache", "directory",
        "resourcefolder", "filedoesnotexist", "filenotfound", "packagefile",
    ],
    "syntax": ["expected", "syntaxerror", "unexpectedtoken", "orphaned", "illegalstatement", "illegalline", "identifierexpectedkw", "tokenexpected"],
    "binding": [
        "notfound", "undeclared", "undefined", "namenotincontext", "nosuchmember", "doesnotexist", "notdeclared", "cannotresolve", "unresolved", "unknown(type|trigger|object|member|property|dotnet|method|field)",
        "extensiontargetnotfound", "appobjectnotfound", "namespacenotfound", "missingassociated", "missingobjectproperty", "missingproperty", "ambigsymbol", "ambigmember", "ambigcall", "unknownidentifier",
    ],
    "type": [
        "typemismatch", "noimplicitconversion", "cannotconvert", "notconvertible", "badargcount", "noover?load", "ambigunary", "ambigbinary", "ambig", "noninvocable", "methodnameexpected",
        "operator.*(ambiguous|applied)", "wrongnumberof", "incompatibletype", "cannotimplicit", "propertytypefieldtype",
    ],
    "metadata of objects": ["duplicate", "primarykey", "fieldid", "objectid", "alreadydeclared", "alreadydefined"],
}
# Names of what a writing model often gets wrong, and of what it never causes.
LIKELY_NAMES = [
    "nosuchmember", "namenotincontext", "badargcount", "noninvocable", "methodnameexpected", "unknowntype", "unknowntrigger", "noimplicitconversion", "fieldnotfound", "eventnotfound", "controlnotfound",
    "actionnotfound", "namespacenotfound", "extensiontargetnotfound", "appobjectnotfound", "dataitem(orcolumn)?notfound", "undefinedoptionvalue", "ambigcall", "ambigmember", "ambigsymbol",
    "semicolonexpected", "identifierexpected", "syntaxerror", "unexpectedtoken", "closeparenexpected", "propertyusedasmethod", "duplicateproperty", "duplicatevariablename", "duplicateparamname",
    "invalidpropertyvalue", "invalidpropertyoptionvalue", "invalidrunobject", "unknowndotnetevent", "systemobjectnotfound", "fieldgroupnotfound", "viewnotfound", "analysisviewnotfound",
    "missingassociatedproperty", "noncustomizableproperty", "propertynotallowed", "fieldtypemismatch", "propertytypefieldtype", "nametypemismatch", "orphanedelse",
]
ENVIRONMENT_NAMES = [
    "duplicate.*id", "fieldid", "objectid", "primarykey", "manifest", "package", "symbol", "nuget", "radfile", "fastpublish", "internal", "analyzerdriver", "emit", "debugger", "telemetry", "licens",
    "entitlement", "projectmanifest", "translationapp", "xliff", "packagecache", "directorynotfound", "filenotfound", "resourcefolder", "appfiledoesnotexist", "obsoletetag", "checksum",
]
# Likelihood, strategy and mutation of compiler codes by category, where no rule before decides.
BY_CATEGORY = {
    "obsoletion": ("low", "model", "reference_obsolete"), "lexical": ("medium", "deterministic", "corrupt_literal"), "syntax": ("high", "deterministic", "delete_token"),
    "binding": ("high", "model", "rename_identifier"), "type": ("high", "model", "change_var_type"), "semantic": ("low", "model", None), "other": ("low", "model", None),
}
LIKELIHOODS = ["high", "medium", "low", "none"]
# Words of an analyzer rule's text that say its fix is a matter of form, and the mutation that undoes it.
FORM_WORDS = ["space", "parenthes", "casing", "lowercase", "uppercase", r"begin\.\.end", "blank line", "indent", "semicolon", "sorted", "suffix", "prefix"]
CORRECTABLE_WORDS = ["parenthes", "casing", "qualif", "order", "whitespace", "space", "semicolon", "using"]
FORM_MUTATIONS = [("parenthes", "strip_call_parens"), ("space", "mangle_operator_spacing"), ("casing|lowercase", "case_mismatch_keyword"), ("temporary.*prefix|prefix.*temporary", "drop_temp_prefix"), ("suffix", "drop_label_suffix")]


def first_match(text: Column, rules: list[tuple[str, str]], default: str | None) -> Column:
    """The label of the first rule whose pattern occurs; order matters."""
    out = F.lit(default).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(F.rlike(text, F.lit(pattern)), label).otherwise(out)
    return out


def _any(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def _bare(name: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(name, F.lit("")), "^(ERR|WRN|INF)_", ""))


def _prefix(code: Column) -> Column:
    return F.regexp_extract(code, r"^([A-Z]+)", 1)


def diagnostic_category(code: Column, name: Column) -> Column:
    """Category of a diagnostic: analyzers by the prefix of the code, compiler codes by their name; other without one."""
    known = F.create_map(*[F.lit(x) for kv in ANALYZER_CATEGORY.items() for x in kv])
    rules = [(_any(patterns), label.split(" ")[0]) for label, patterns in NAME_RULES.items()]
    by_name = first_match(_bare(name), [*rules, ("^(none|void|unknown)?$", "other")], "semantic")
    return F.when(_prefix(code) == "AL", by_name).otherwise(F.coalesce(F.element_at(known, _prefix(code)), F.lit("analyzer-style")))


def diagnostics_catalogue(codes: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(code, severity, category, likelihood, strategy, mutation) of every code: how likely a writing model causes it, and what mends it.

    ``codes``: code, severity, name, text (title and message of a rule);
    ``overrides``: code, likelihood, strategy, mutation, which win. Null names
    and texts count as empty, repeated codes once (the smallest row).
    """
    c = codes.where("code is not null").groupBy("code").agg(F.min(F.struct("severity", "name", "text")).alias("r")).select("code", severity(F.col("r.severity")).alias("severity"), "r.name", F.lower(F.coalesce("r.text", F.lit(""))).alias("text"))
    c = c.withColumn("category", diagnostic_category(F.col("code"), F.col("name"))).withColumn("p", _prefix(F.col("code"))).withColumn("bare", _bare(F.col("name")))
    cat = F.col("category")
    by = lambda k: F.coalesce(F.element_at(F.create_map(*[x for name, v in BY_CATEGORY.items() for x in (F.lit(name), F.lit(v[k]).cast("string"))]), cat), F.lit(None).cast("string"))
    idle = cat.isin("metadata", "permission") | F.rlike("bare", F.lit(_any(ENVIRONMENT_NAMES))) | ((F.col("severity") == "info") & (cat != "obsoletion"))
    likely = F.rlike("bare", F.lit(_any(LIKELY_NAMES))) & ~cat.isin("obsoletion", "lexical")
    called = F.when(cat == "syntax", "delete_token").when(cat == "binding", "rename_identifier").when(cat == "type", "rename_member")
    compiler = F.struct(
        F.when(idle, "none").when(likely, "high").when((cat == "semantic") & (F.col("severity") == "error"), "medium").otherwise(by(0)).alias("likelihood"),
        F.when(idle, "none").when(likely, F.when(cat == "syntax", "deterministic").otherwise("model")).otherwise(by(1)).alias("strategy"),
        F.when(~idle, F.when(likely, called).otherwise(by(2))).alias("mutation"),
    )
    broad = F.col("p").isin("AS", "AW", "PTE")
    form, mendable = F.rlike("text", F.lit(_any(FORM_WORDS))), (cat != "analyzer-correctness") | F.rlike("text", F.lit(_any(CORRECTABLE_WORDS)))
    analyzer = F.struct(
        F.when(F.col("p") == "AS", "none").when(~broad & form, "medium").otherwise("low").alias("likelihood"),
        F.when(~broad & (form | mendable), "analyzer-codefix").otherwise("model").alias("strategy"),
        F.when(~broad, first_match(F.col("text"), FORM_MUTATIONS, None)).alias("mutation"),
    )
    out = c.withColumn("rule", F.when(F.col("p") == "AL", compiler).otherwise(analyzer))
    if overrides is None:
        return out.select("code", "severity", "category", "rule.*")
    o = overrides.select("code", F.struct("likelihood", "strategy", "mutation").alias("given")).dropDuplicates(["code"])
    return out.join(o, "code", "left").select("code", "severity", "category", F.coalesce("given", "rule").alias("rule")).select("code", "severity", "category", "rule.*")


def ranked_by_likelihood(catalogue: DataFrame, k: int = 40) -> DataFrame:
    """The k codes a writing model causes most likely: high before medium, then by code (a top-k report)."""
    rank = F.array_position(F.array(*[F.lit(x) for x in LIKELIHOODS]), F.col("likelihood"))
    return catalogue.where(F.col("likelihood").isin("high", "medium")).orderBy(rank, "code").limit(k)


def markdown_table(df: DataFrame, limit: int = 1000) -> str:
    """A small result as a Markdown table; at most ``limit`` rows, for reading, not for data."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    rows = df.limit(limit).collect()
    out = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(out + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows]) + "\n"
