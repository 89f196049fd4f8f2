"""Mixing sources to target weights, in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

# The pre-tokenization pattern the byte-level vocabularies were made with, and where they lie.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
_ENCODINGS: dict[str, object] = {}


def encoding(path: str):
    """The byte-level BPE of a .tiktoken rank file, loaded once per worker."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        _ENCODINGS[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def source_key(col: F.Column) -> F.Column:
    """One spelling per source: lower case, hyphens for underscores and blanks; null stays null."""
    return F.regexp_replace(F.lower(F.trim(col)), r"[\s_]+", "-")


def token_counts(df: DataFrame, keep: list[str], text_col: str, tokenizer: str) -> DataFrame:
    """``keep`` columns and n_tokens of each text; a null text has 0.

    The tokenizer's file goes along to the executors. A task encodes a text once
    for as long as it remembers its hash, so a text that very many rows hold costs next to nothing.
    """
    df.sparkSession.sparkContext.addFile(tokenizer)
    name = os.path.basename(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(SparkFiles.get(name))
        known: dict[bytes, int] = {}
        for batch in batches:
            n = []
            for text in batch.column(len(keep)).to_pylist():
                if not text:
                    n.append(0)
                    continue
                h = xxhash.xxh3_128_digest(text)
                if h not in known:
                    if len(known) >= 200_000:  # bounds memory, changes no result
                        known.clear()
                    known[h] = len(enc.encode_ordinary(text))
                n.append(known[h])
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(n, pa.int64())], [*keep, "n_tokens"])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens bigint"
    return df.select(*keep, text_col).mapInArrow(run, schema)


def repetition_rates(have: dict[str, int], wanted: dict[str, tuple[float, int]], total: float) -> dict[str, float]:
    """How often each source's texts are to be used so that shares of ``total`` are met.

    A source that its cap (or lack of texts) holds below its share gives its
    cap; what is missing then goes to the others in proportion to their targets,
    again and again until no further cap binds.
    """
    rates = {s: 0.0 for s in wanted}
    free = {s for s, (share, cap) in wanted.items() if share > 0 and cap > 0 and have.get(s, 0) > 0}
    fixed = 0.0
    while free:
        weight = sum(wanted[s][0] for s in free)
        scale = max(0.0, total - fixed) / weight
        bound = {s for s in free if wanted[s][0] * scale > wanted[s][1] * have[s]}
        if not bound:
            for s in free:
                rates[s] = wanted[s][0] * scale / have[s]
            break
        for s in bound:
            rates[s] = float(wanted[s][1])
            fixed += rates[s] * have[s]
        free -= bound
    return rates


class Mixture:
    """documents(doc_id, source, n_tokens, copies): texts used at least once; report(): per wanted source."""

    def __init__(self, documents: DataFrame, stats: DataFrame):
        self.documents, self._stats = documents, stats

    def copies(self) -> DataFrame:
        """(doc_id, source, copy, n_tokens): one row per use of a text, copies counted from 1."""
        return self.documents.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "n_tokens")

    def report(self) -> DataFrame:
        """(source, target_share, max_repeats, n_texts, n_tokens, rate, mixed_tokens, actual_share); wanted sources without texts included."""
        used = self.documents.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"))
        full = self._stats.join(used, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
        total = full.agg(F.sum("mixed_tokens").alias("t"))
        return full.crossJoin(F.broadcast(total)).withColumn("actual_share", F.round(F.col("mixed_tokens") / F.greatest("t", F.lit(1)), 6)).drop("t")


def mix(documents: DataFrame, doc_id: str, text_col: str, source_col: str, targets: DataFrame, *, total_tokens: int | None = None, tokenizer: str = DEFAULT_TOKENIZER, seed: int = 29, scratch: Scratch | None = None) -> Mixture:
    """Use each wanted source's texts at rates that meet its share of ``total_tokens``.

    ``targets``: source, target_share, max_repeats; the driver reads them and the
    token counts of their sources, one row per wanted source.
    ``total_tokens`` defaults to all tokens of the wanted sources. A text stands
    once, however many documents repeat it, for the wanted source of its
    smallest id, so no text is used more than ``max_repeats`` times. A text is
    used floor(rate) times and once more if a seeded hash of its id falls below
    the fraction.

    Defined results: null ids and null or empty texts are left out; null and
    unwanted sources get nothing; shares or caps that are null or negative count
    as 0; repeated target rows of one source count once; empty tables give an
    empty mixture; other columns are not read.
    """
    spark = documents.sparkSession
    scratch = scratch or Scratch(spark, "mix")
    t = targets.select(source_key(F.col("source")).alias("source"), F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats"))
    t = t.where("source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("s")).select("source", "s.*")
    wanted = {r["source"]: (r["target_share"], r["max_repeats"]) for r in t.toLocalIterator()}

    base = documents.select(F.col(doc_id).alias("doc_id"), F.col(text_col).alias("text"), source_key(F.col(source_col)).alias("source")).where("doc_id is not null and length(text) > 0")
    some = spark.createDataFrame([(s,) for s, (share, _) in wanted.items() if share > 0], "source string")  # whether it is small enough to broadcast is seen from its size
    base = base.join(some, "source", "left_semi").withColumn("h1", F.xxhash64("text")).withColumn("h2", F.hash("text"))
    sized = scratch.write(token_counts(base, ["doc_id", "source", "h1", "h2"], "text", tokenizer), "sized")
    texts = sized.groupBy("h1", "h2", "n_tokens").agg(F.min(F.struct("doc_id", "source")).alias("d")).select("d.doc_id", "d.source", "n_tokens")
    texts = scratch.write(texts, "texts")
    stats = texts.groupBy("source").agg(F.count("*").alias("n_texts"), F.sum("n_tokens").alias("n_tokens"))
    have = {r["source"]: r["n_tokens"] for r in stats.collect()}
    rates = repetition_rates(have, wanted, total_tokens if total_tokens is not None else sum(have.values()))
    table = spark.createDataFrame([(s, *wanted[s], rates[s]) for s in sorted(wanted)], "source string, target_share double, max_repeats int, rate double")
    u = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    rated = texts.join(table.select("source", "rate"), "source")
    copies = (F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    used = rated.withColumn("copies", copies).where("copies > 0").select("doc_id", "source", "n_tokens", "copies")
    full = table.join(stats, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("n_texts", F.lit(0)).alias("n_texts"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.round("rate", 6).alias("rate"))
    return Mixture(scratch.write(used, "used"), full)
