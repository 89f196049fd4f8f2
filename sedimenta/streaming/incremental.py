"""Incremental runs, as an extension: the batch operators over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import norm


def not_done(df: DataFrame, done: DataFrame, *key: str) -> DataFrame:
    """Rows whose key is not among those done: how an interrupted stage resumes."""
    return df.join(done.select(*key).distinct(), list(key), "left_anti")


def dedup_stream(spark: SparkSession, source: str, schema, text: str, sink: str, checkpoint: str, *, order: str) -> None:
    """Append to ``sink`` the rows of newly arrived files whose normalised text it does not hold yet; ends when all are read.

    Exactly once per file (the checkpoint), idempotent per batch (the batch's
    number is a partition of the sink, overwritten if it runs again). Within a
    batch the smallest ``order`` wins.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def batch(df: DataFrame, number: int) -> None:
        keyed = df.withColumn("text_hash", F.sha2(norm(F.col(text)), 256))
        first = keyed.groupBy("text_hash").agg(F.min(order).alias(order))
        fresh = keyed.join(first, ["text_hash", order], "left_semi").dropDuplicates(["text_hash"])
        try:
            held = spark.read.parquet(sink).where(F.col("batch") != number)
            fresh = not_done(fresh, held, "text_hash")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, time: str, key: str, *, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Counts per tumbling window and key with a watermark; the same expression serves a batch."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
