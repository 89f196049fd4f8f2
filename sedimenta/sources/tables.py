"""Readers and writers: line-wise JSON, ragged TSV, source trees, Markdown trees, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import clean_path, dirname
from ..operators.decontam import ALLOWED_LICENCES

HIT = "array<struct<code:string,severity:string,line:int>>"
CORPUS = (
    "repo string, path string, object_kind string, object_id int, object_name string, is_test boolean, member_kind string, member_name string, is_local boolean, signature string, "
    f"doc_comment string, has_body boolean, body string, body_loc int, member_text string, object_head string, sibling_signatures array<string>, error_hits {HIT}, analyzer_hits {HIT}"
)
CANDIDATE = (
    "gen string, messages array<struct<role:string,content:string>>, target_al string, rejected_al string, mutation string, rules array<string>, "
    "meta struct<repo:string,path:string,object:string,member:string,signature:string,heading:string,doc_section:string,mutation_desc:string,expected_diagnostic:array<string>,author:string>"
)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, dead letters): line-wise JSON under a fixed schema; blank lines are skipped, unreadable ones and error rows set aside."""
    full = T.StructType.fromDDL(schema).add("_parse_error", T.StringType()).add("_corrupt", T.StringType())
    raw = spark.read.schema(full).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    raw = raw.select("*", F.col("_metadata.file_path").alias("_file"))
    bad = F.col("_corrupt").isNotNull() | F.col("_parse_error").isNotNull()
    return raw.where(~bad).drop("_corrupt", "_parse_error", "_file"), raw.where(bad).select("_file", F.coalesce("_parse_error", "_corrupt").alias("error"))


def write_jsonl(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """One JSON object per line; ``mode='append'`` adds finished rows."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_tsv(spark: SparkSession, path: str, n: int) -> DataFrame:
    """c0 .. c(n-1): ragged tab-separated lines padded with empty strings or cut to n columns; blank lines skipped."""
    parts = F.split("value", "\t")
    line = spark.read.text(path).where(F.trim("value") != "")
    return line.select(*[F.coalesce(F.try_element_at(parts, F.lit(i + 1)), F.lit("")).alias(f"c{i}") for i in range(n)])


def read_tree(spark: SparkSession, root: str, glob: str = "*.al") -> DataFrame:
    """(path, content): files below a folder, bytes decoded as UTF-8 with replacement; paths relative to it.

    Ordering is left to whoever needs it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    base = F.lit(root.rstrip("/") + "/")
    bare = F.regexp_replace("path", "^file:/*", "/")
    return files.select(F.replace(bare, base, F.lit("")).alias("path"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"), F.col("length").alias("n_bytes"))


def app_folders(paths: DataFrame, manifest: str = "app.json", excluded: str = ".alpackages") -> DataFrame:
    """(app_dir): folders that hold a manifest, except below package caches."""
    p = paths.select(F.replace(F.col(paths.columns[0]), F.lit("\\"), F.lit("/")).alias("p"))
    hit = p.where(F.rlike("p", F.lit(rf"(^|/){manifest.replace('.', '[.]')}$")) & ~F.contains("p", F.lit(excluded)))
    return hit.select(F.coalesce(dirname(F.col("p")), F.lit("")).alias("app_dir")).distinct()


def allowed_sources(manifest: DataFrame) -> DataFrame:
    """Rows of the repository manifest that may be used: an allowed licence or documentation, and fetched."""
    ok = F.coalesce(F.col("spdx").isin(*ALLOWED_LICENCES), F.lit(False)) | (F.coalesce("src_role", F.lit("")) == "docs")
    return manifest.where(ok & F.col("commit_id").isNotNull())


def normalised_paths(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, clean_path(F.col(col)))
