"""Source texts to rows: objects, members, diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import al
from ..functions.arrow import map_rows

MEMBER_SCHEMA = (
    "file_id long, object_no int, member_no int, object_kind string, object_id long, object_name string, is_test boolean, member_kind string, member_name string, is_local boolean, "
    "signature string, doc_comment string, has_body boolean, body string, body_loc int, member_text string, object_head string, sibling_signatures array<string>, start_row int, end_row int, error string"
)
OBJECT_SCHEMA = "file_id long, object_no int, kind string, object_id long, name string, is_test boolean, n_members int, text string, error string"


def members(files: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per member of every file, with object and siblings; a file that cannot be read gives one row with ``error``.

    Null and empty texts give none. Rows are 0-based lines of the file.
    """
    width = len(MEMBER_SCHEMA.split(", "))

    def run(ids: list, texts: list) -> list[tuple]:
        rows = []
        for fid, src in zip(ids, texts):
            try:
                for n, o in enumerate(al.objects(src)):
                    sibs, head = [m.signature for m in o.members], o.head
                    for k, m in enumerate(o.members):
                        body = src[m.body_start : m.body_end] if m.body_start is not None else ""
                        first = src.count("\n", 0, m.start)
                        rows.append((fid, n, k, o.kind, o.object_id, o.name, o.is_test, m.kind, m.name, m.is_local, m.signature, m.doc_comment, bool(body), body, body.count("\n") + 1 if body else 0, m.text, head, sibs, first, first + m.text.count("\n"), None))
            except Exception as e:  # dead letter, the other files go on
                rows.append((fid, *[None] * (width - 2), f"{type(e).__name__}: {e}"))
        return rows

    f = files.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and length(text) > 0")
    return map_rows(f, run, MEMBER_SCHEMA)


def objects(files: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per object of every file."""
    width = len(OBJECT_SCHEMA.split(", "))

    def run(ids: list, texts: list) -> list[tuple]:
        rows = []
        for fid, src in zip(ids, texts):
            try:
                rows += [(fid, n, o.kind, o.object_id, o.name, o.is_test, len(o.members), o.text, None) for n, o in enumerate(al.objects(src))]
            except Exception as e:
                rows.append((fid, *[None] * (width - 2), f"{type(e).__name__}: {e}"))
        return rows

    f = files.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and length(text) > 0")
    return map_rows(f, run, OBJECT_SCHEMA)


# A diagnostic line of the compiler.
DIAGNOSTIC = r"^([^\n(]*)\((\d+),(\d+)\):\s+(error|warning|info|hidden)\s+([A-Z]{2,3}\d{3,4}i?):\s+(.*)$"
#: Code prefixes of analyzers; every other code is the compiler's own.
ANALYZER_PREFIXES = ("AA", "AC", "AW", "DC", "FC", "LC", "PC", "TA", "UI")


#: Those whose findings the compile gate counts; the page rules are none of its business.
GATE_PREFIXES = ("AA", "AC", "DC", "FC", "LC", "PC", "TA", "UI")


def parse_diagnostics(logs: DataFrame, log_col: str, *keep: str) -> DataFrame:
    """(keep, path, line, col, severity, code, message): one row per diagnostic line of a log; other lines give none."""
    line = logs.where(F.col(log_col).isNotNull()).select(*keep, F.explode(F.split(log_col, "\r?\n")).alias("_l")).where(F.rlike("_l", F.lit(DIAGNOSTIC)))
    part = lambda n: F.regexp_extract("_l", DIAGNOSTIC, n)
    return line.select(*keep, F.replace(part(1), F.lit("\\"), F.lit("/")).alias("path"), part(2).cast("int").alias("line"), part(3).cast("int").alias("col"), part(4).alias("severity"), part(5).alias("code"), part(6).alias("message"))


# A diagnostic without a position, anywhere in a line.
LOOSE_DIAGNOSTIC = r"\b(error|warning|info|hidden)\s+([A-Z]{2,3}\d{3,4}i?):\s*(.*)$"


def parse_loose(logs: DataFrame, log_col: str, *keep: str) -> DataFrame:
    """(keep, severity, code, message): one row per line of a log that holds a diagnostic, with or without a position."""
    line = logs.where(F.col(log_col).isNotNull()).select(*keep, F.explode(F.split(log_col, "\r?\n")).alias("_l")).where(F.rlike("_l", F.lit(LOOSE_DIAGNOSTIC)))
    return line.select(*keep, *[F.regexp_extract("_l", LOOSE_DIAGNOSTIC, n).alias(c) for n, c in enumerate(("severity", "code", "message"), 1)])


def is_analyzer(code: Column, prefixes: tuple[str, ...] = ANALYZER_PREFIXES) -> Column:
    return F.substring(code, 1, 2).isin(*prefixes)


def unwrapped(diagnostics: DataFrame, shift: str = "shift") -> DataFrame:
    """Lines of diagnostics in the text itself, where it was checked inside a wrapper: less the lines that put it off, one at least."""
    return diagnostics.withColumn("line", F.greatest(F.col("line") - F.coalesce(F.col(shift), F.lit(0)), F.lit(1))).drop(shift)


def attribute(diagnostics: DataFrame, spans: DataFrame) -> DataFrame:
    """Diagnostics with the members whose lines they fall on: an interval join on the path.

    ``diagnostics``: path, line (from 1); ``spans``: path, start_row, end_row
    (from 0, both included). A line may fall on nested members, each gets it.
    Hot paths are cut into blocks of 64 lines, so the equi-join has no key that
    holds a whole file, and a span meets only diagnostics of its own blocks.
    """
    width = 64
    d = diagnostics.withColumn("_b", F.floor((F.col("line") - 1) / width))
    s = spans.where("start_row <= end_row").withColumn("_b", F.explode(F.sequence(F.floor(F.col("start_row") / width), F.floor(F.col("end_row") / width))))
    return d.join(s, ["path", "_b"]).where((F.col("line") - 1 >= F.col("start_row")) & (F.col("line") - 1 <= F.col("end_row"))).drop("_b")


def near_hits(a: DataFrame, b: DataFrame, on: list[str], distance: int = 1) -> DataFrame:
    """Pairs of rows of both sides with equal keys whose lines are at most ``distance`` apart."""
    x = a.withColumn("_l", F.explode(F.sequence(F.col("line") - distance, F.col("line") + distance))).withColumnRenamed("line", "line_a")
    return x.join(b.withColumnRenamed("line", "line_b").withColumn("_l", F.col("line_b")), [*on, "_l"]).drop("_l")
