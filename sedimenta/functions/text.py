"""Column expressions on texts; everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(col: Column) -> Column:
    """Whitespace runs to one blank, trimmed, lower case; null counts as empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), r"\s+", " ")))


def norm_ws(col: Column) -> Column:
    """Whitespace runs to one blank, trimmed; case kept."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), r"\s+", " "))


def hash_bucket(key: Column, n: int) -> Column:
    """First four bytes of the key's SHA-1 as a number, modulo n: stable over engines and runs."""
    return F.conv(F.substring(F.sha1(F.coalesce(key, F.lit(""))), 1, 8), 16, 10).cast("bigint") % n


def shingles(normalised: Column, k: int = 5) -> Column:
    """Distinct runs of k blank-separated words; a shorter text is one shingle of all its words."""

    # the array is bound once; written into the inner lambda it would be split again for every run
    def runs(words: Column) -> Column:
        n = F.greatest(F.lit(1), F.size(words) - (k - 1))
        return F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(words, i, F.lit(k)), " ")))

    return F.get(F.transform(F.array(F.split(normalised, " ")), runs), F.lit(0))


def shingle_hashes(normalised: Column, k: int = 5) -> Column:
    """Distinct hashes of the ``shingles``, made from the words without writing the runs out."""

    def runs(words: Column) -> Column:
        n = F.greatest(F.lit(1), F.size(words) - (k - 1))
        return F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(words, i, F.lit(k)))))

    return F.get(F.transform(F.array(F.split(normalised, " ")), runs), F.lit(0))


def without_comment_markers(col: Column) -> Column:
    """A comment without its leading slashes."""
    return F.trim(F.regexp_replace(F.trim(F.coalesce(col, F.lit(""))), r"(?m)^[ \t]*//+[ \t]?", ""))


def fenced(col: Column) -> Column:
    return F.concat(F.lit("```al\n"), col, F.lit("\n```"))


def first_fence(col: Column) -> Column:
    """The content of the first fence tagged al, else of the first fence, else null."""
    tagged = F.regexp_extract(col, r"(?s)```al[ \t]*\n(.*?)```", 1)
    any_ = F.regexp_extract(col, r"(?s)```[^\n]*\n(.*?)```", 1)
    hit = F.when(F.rlike(col, F.lit(r"(?s)```al[ \t]*\n.*?```")), tagged).when(F.rlike(col, F.lit(r"(?s)```[^\n]*\n.*?```")), any_)
    return trim_all(hit)


def body_loc(body: Column) -> Column:
    return F.when(F.coalesce(F.length(body), F.lit(0)) == 0, 0).otherwise(F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1)


def sentences(prose: Column) -> Column:
    return F.regexp_count(prose, F.lit(r"[.!?](\s|$)"))


def without_fences(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)```.*?```", " ")


def trim_all(col: Column) -> Column:
    """Trim of every kind of whitespace, not of blanks alone."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def major_minor(version: Column, fallback: str = "0.0") -> Column:
    """The first two numbers of a version; the fallback where there are none."""
    v = F.regexp_extract(F.coalesce(version, F.lit("")), r"^\s*v?(\d+\.\d+)", 1)
    return F.when(v != "", v).otherwise(fallback)
