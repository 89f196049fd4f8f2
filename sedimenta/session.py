"""Session construction and the shared scratch area used to cut lineage.

Nothing here sizes itself to a laptop: an existing session's settings win, and
only a session this library creates itself (tests, bench) gets local defaults.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CHECKPOINT_DIR: str | None = None


def local_session(app: str = "sedimenta", cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    ``spark.checkpoint.dir`` is read from the session and used as it is. Only
    where it is unset (tests, a laptop) a temporary folder is made, and only in
    local mode: on a cluster a machine-local folder would lose data with its
    executor, so a missing setting is an error there.
    """
    global _LOCAL_CHECKPOINT_DIR
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_CHECKPOINT_DIR is None or not os.path.isdir(_LOCAL_CHECKPOINT_DIR):
        _LOCAL_CHECKPOINT_DIR = tempfile.mkdtemp(prefix="sedimenta-")
        atexit.register(shutil.rmtree, _LOCAL_CHECKPOINT_DIR, ignore_errors=True)
    return f"file://{_LOCAL_CHECKPOINT_DIR}"


class Scratch:
    """Tables written to the shared folder; a lost executor re-reads, never recomputes.

    A written Parquet table rather than ``checkpoint()``: it is compressed,
    columnar, computed once, and gives the optimizer real sizes to plan with.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/sedimenta-{label}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Remove one table, or all of them; harmless after the session ended."""
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            fs.delete(path, True)
        except Exception:  # the JVM is gone; the cluster's cleaner owns the folder now
            pass


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores, for work that is heavy per row on a table that is small: adaptive execution would merge it into one task."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package where their PYTHONPATH does not name it; once per context."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home in known or getattr(context, "_sedimenta_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="sedimenta-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "sedimenta.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, files in os.walk(os.path.join(home, "sedimenta")):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    out.write(full, os.path.relpath(full, home))
    context.addPyFile(archive)
    context._sedimenta_shipped = True
