"""Paths however they are spelled, and the app a path lies in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def path_parts(path: Column) -> Column:
    """Folders and name of a path: separators of both kinds, doubled or leading ones, '.', '..' and blanks around resolved."""
    raw = F.split(F.replace(F.trim(path), F.lit("\\"), F.lit("/")), "/")
    kept = F.filter(raw, lambda x: ~x.isin("", "."))
    up = F.aggregate(
        kept,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))),
    )
    return F.when(F.array_contains(kept, ".."), up).otherwise(kept)


def clean_path(path: Column) -> Column:
    return F.array_join(path_parts(path), "/")


def dirname(path: Column) -> Column:
    """Everything before the last slash; null where there is none."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(F.contains(p, F.lit("/")), F.regexp_replace(p, "/[^/]*$", ""))


def group_of(path: Column, obj: Column, gen: Column) -> Column:
    """What a row is held out with: the folder of its path, else its object, else its generator."""
    some = lambda c: F.when(c != "", c)
    return F.coalesce(some(dirname(path)), some(obj), gen)


def place(paths: DataFrame, apps: DataFrame) -> DataFrame:
    """(path, app): for each distinct path of the one-column table, the app whose folder is the deepest above it.

    ``apps``: app (a number), app_dir. Folders are compared without case; an
    exact match goes before one that differs in case, then the smaller app.
    Paths outside every app, and null paths, are absent. The work is one
    equi-join of the folders above each distinct path.
    """
    p = paths.toDF("path").where("path is not null").distinct()
    up = p.withColumn("parts", path_parts(F.col("path"))).select("path", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("parts"), F.lit(1))), lambda n: F.array_join(F.slice("parts", 1, n), "/"))).alias("dir"))
    up = up.withColumn("low", F.lower("dir"))
    a = apps.select("app", clean_path(F.col("app_dir")).alias("app_dir")).where("app_dir <> ''").withColumn("low", F.lower("app_dir"))
    hit = up.join(a, "low")
    best = F.max(F.struct(F.length("low").alias("depth"), (F.col("dir") == F.col("app_dir")).alias("exact"), (-F.col("app")).alias("minus")))
    return hit.groupBy("path").agg(best.alias("best")).select("path", (-F.col("best.minus")).alias("app"))
