"""Row-local Python logic over Arrow batches, with exact types on the way back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_rows(df: DataFrame, rows: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """``rows(*columns)`` turns the columns of a batch, as Python lists, into output tuples of the schema."""
    struct = T.StructType.fromDDL(schema)
    out = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = rows(*(c.to_pylist() for c in batch.columns))
            columns = list(zip(*made)) if made else [()] * len(out)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return df.mapInArrow(run, struct)


def flat_map(df: DataFrame, inputs: list[str], rows: Callable[..., list[list[tuple]]], schema: str) -> DataFrame:
    """Every row of ``df`` once per tuple that ``rows(*inputs)`` lists for it, with the tuple's columns behind its own: no join brings them back."""
    extra = T.StructType.fromDDL(schema)
    out = T.StructType([*df.schema.fields, *extra.fields])
    full, added = to_arrow_schema(out), to_arrow_schema(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = rows(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs))
            at = pa.array([i for i, several in enumerate(made) for _ in several], pa.int32())
            flat = [x for several in made for x in several]
            columns = list(zip(*flat)) if flat else [()] * len(added)
            kept = [c.take(at).cast(f.type) for c, f in zip(batch.columns, full)]
            yield pa.record_batch([*kept, *(pa.array(c, f.type) for c, f in zip(columns, added))], schema=full)

    return df.mapInArrow(run, out)
