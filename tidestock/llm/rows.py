"""Row-wise work inside tasks: Arrow batches in, bounded Arrow batches out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidestock.session import staged_lean  # noqa: F401  (used by the steps of this package)

MAX_ROWS, MAX_BYTES = 8192, 8 << 20


def _weight(value) -> int:
    """Bytes of a Python value, roughly; a list element costs a pointer and an object."""
    return len(value) if isinstance(value, (str, bytes)) else 36 * len(value) if isinstance(value, list) else 8


def map_rows(df: DataFrame, func: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """Apply ``func`` (an iterator of row tuples to row tuples) to every partition.

    Rows are turned into Python values a few hundred at a time and results are flushed by
    size, so memory holds one incoming batch, a slice of it and one outgoing batch.
    """
    target = to_arrow_schema(T.StructType.fromDDL(schema))

    def flush(out: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(c), f.type) for c, f in zip(zip(*out), target)]
        return pa.RecordBatch.from_arrays(columns, schema=target)

    def run(batches):
        def rows():
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    yield from zip(*(c.to_pylist() for c in batch.slice(start, 256).columns))

        out: list[tuple] = []
        size = 0
        for row in func(rows()):
            out.append(row)
            size += sum(map(_weight, row))
            if len(out) >= MAX_ROWS or size >= MAX_BYTES:
                yield flush(out)
                out, size = [], 0
        if out:
            yield flush(out)

    return df.mapInArrow(run, schema)


def together(rows: Iterable[tuple], characters: int) -> Iterator[list[tuple]]:
    """Lists of rows ``(key, text)`` with about so many characters."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[1] or "")
        if size >= characters or len(some) >= MAX_ROWS:
            yield some
            some, size = [], 0
    if some:
        yield some


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns c0, c1, ... so that no column clashes with an operator's own, and the new names of ``names``."""
    columns = df.columns
    renamed = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    return renamed, [f"c{columns.index(n)}" for n in names]


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
