"""Blocklists and the gates that use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm

#: Licences whose code may be used; documentation repositories are exempt. Fixed values.
ALLOWED_LICENCES = ("MIT", "Apache-2.0", "MS-PL", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC")


def patch_paths(patch: Column) -> Column:
    """Paths a unified diff writes to."""
    return F.regexp_extract_all(patch, F.lit(r"(?m)^\+\+\+ b/(.+)$"), F.lit(1))


def blocklist(items: DataFrame, texts: list[str], patches: list[str] = (), paths: list[str] = ()) -> DataFrame:
    """(kind, value): distinct prompts and path fragments of benchmark items. Missing columns give nothing."""
    have = set(items.columns)
    out = items.sparkSession.createDataFrame([], "kind string, value string")
    for c in texts:
        if c in have:
            out = out.unionByName(items.select(F.lit("prompt").alias("kind"), norm(F.col(c)).alias("value")))
    for c in patches:
        if c in have:
            out = out.unionByName(items.select(F.lit("path").alias("kind"), F.explode(patch_paths(F.col(c))).alias("value")))
    for c in paths:
        if c in have:
            out = out.unionByName(items.select(F.lit("path").alias("kind"), F.replace(F.col(c), F.lit("\\"), F.lit("/")).alias("value")))
    return out.where("value <> ''").distinct()


def equal_prompts(df: DataFrame, text: Column, block: DataFrame) -> DataFrame:
    """Rows whose normalised text is a blocked prompt (an equi-join; null texts never are)."""
    b = block.select(F.sha2(norm(F.col(block.columns[0])), 256).alias("_b")).distinct()
    return df.withColumn("_b", F.sha2(norm(text), 256)).join(b, "_b", "left_semi").drop("_b")


def _grams(words: Column, n: int) -> Column:
    """Hashes of the runs of n words."""
    run = lambda i: F.xxhash64(F.lit(n), *[F.get(words, i + k) for k in range(n)])
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(0), F.size(words) - n), run)).otherwise(F.array().cast("array<bigint>"))


def _pieces(word: Column, n: int) -> Column:
    """Hashes of the stretches of n characters of a word of at least so many."""
    return F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.xxhash64(F.lit(-n), F.substring(word, i, F.lit(n))))


def containing(df: DataFrame, id_col: str, text: Column, items: DataFrame, item_id: str, item_text: str, *, min_chars: int = 40) -> DataFrame:
    """(id, item): rows whose normalised text contains an item's whole normalised text of at least ``min_chars``.

    An item may begin and end inside a word of the text, but the words between
    stand in it whole: three of them (or the longest, where there are only one or
    two; or, in items of one or two words, half ``min_chars`` characters of the
    longer one) are a key, by which texts and items meet in an equi-join, and
    only what meets is compared. Null texts contain nothing.
    """
    half = min_chars // 2
    i = items.select(F.col(item_id).alias("item"), norm(F.col(item_text)).alias("p")).where(F.length("p") >= min_chars).distinct()
    words = F.split("p", " ")
    inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(1)))
    longest = lambda a: F.array_max(F.transform(a, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    three = F.xxhash64(F.lit(3), *[F.get(inner, F.lit(k)) for k in range(3)])
    one, part = F.xxhash64(F.lit(1), longest(inner)), F.xxhash64(F.lit(-half), F.substring(longest(words), 1, half))
    i = i.withColumn("key", F.when(F.size(words) >= 5, three).when(F.size(words) >= 3, one).otherwise(part))
    base = df.select(F.col(id_col).alias("id"), norm(text).alias("t")).where("id is not null and t <> ''")

    def grams(w: Column) -> Column:
        long_ = F.flatten(F.transform(F.filter(w, lambda x: F.length(x) >= half), lambda x: _pieces(x, half)))
        return F.array_distinct(F.concat(_grams(w, 3), _grams(w, 1), long_))

    # the words are bound once; written into the inner lambdas they would be split again for every run
    keys = base.select("id", F.explode(F.get(F.transform(F.array(F.split("t", " ")), grams), F.lit(0))).alias("key"))
    met = keys.join(i.select("key", "item"), "key").select("id", "item").distinct()
    both = met.join(base.distinct(), "id").join(i.select("item", "p"), "item")
    return both.where(F.contains("t", "p")).select("id", "item").distinct()


def path_contaminated(path: Column, fragments: DataFrame, df: DataFrame, *, outside: bool = False) -> DataFrame:
    """Rows whose path contains a blocked fragment, or, ``outside``, all others; separators made equal, empty fragments ignored.

    Paths and fragments meet by the fragment's first eight characters (or all of
    a shorter one), each distinct path once; only what meets is compared.
    """
    slashes = lambda c: F.replace(c, F.lit("\\"), F.lit("/"))
    f = fragments.select(slashes(F.col(fragments.columns[0])).alias("_f")).where("_f <> ''").distinct().withColumn("_n", F.least(F.length("_f"), F.lit(8)))
    f = f.withColumn("_k", F.substring(F.col("_f"), F.lit(1), F.col("_n")))
    marked = df.withColumn("_p", slashes(path))
    p = marked.select("_p").where("_p is not null").distinct()
    sizes = f.select("_n").distinct()  # eight rows at most
    at = F.sequence(F.lit(1), F.length("_p") - F.col("_n") + 1)
    grams = p.join(F.broadcast(sizes), F.length("_p") >= F.col("_n")).select("_p", F.explode(F.array_distinct(F.transform(at, lambda i: F.substring(F.col("_p"), i, F.col("_n"))))).alias("_k"))
    hit = grams.join(f, "_k").where(F.contains("_p", "_f")).select("_p").distinct()
    return marked.join(hit, "_p", "left_anti" if outside else "left_semi").drop("_p")


def licence_gate(df: DataFrame, repo: str, sources: DataFrame, *, strict: bool = False) -> DataFrame:
    """Rows with ``licence_ok``: false iff the repository is known, its licence not allowed and it is no documentation.

    Unknown repositories pass, unless ``strict``.
    """
    s = sources.select(F.col("src_key").alias("_repo"), "spdx", "src_role").dropDuplicates(["_repo"])
    ok = F.when(F.col("_repo").isNull(), F.lit(not strict)).otherwise(F.coalesce(F.col("spdx").isin(*ALLOWED_LICENCES), F.lit(False)) | (F.coalesce("src_role", F.lit("")) == "docs"))
    return df.join(s, F.col(repo) == F.col("_repo"), "left").withColumn("licence_ok", ok).drop("_repo", "spdx", "src_role")
