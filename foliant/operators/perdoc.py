"""One document in, any number of rows out: grammars whose acceptance depends on what they accepted before."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


#: Documents and bytes of input that are taken apart at a time.
ROWS, BYTES = 100, 8 << 20


def portions(sizes: list[int], total: int = BYTES, rows: int = 200) -> Iterator[tuple[int, int]]:
    """(first, number) of consecutive rows, at most `rows` and together at most `total`; a larger row is alone."""
    first = held = 0
    for i, size in enumerate(sizes):
        if i > first and (held + size > total or i - first >= rows):
            yield first, i - first
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes) - first


def _sizes(batch: pa.RecordBatch) -> list[int]:
    out = np.zeros(batch.num_rows, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
            out += pc.coalesce(pc.binary_length(c).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        else:
            out += c.nbytes // max(batch.num_rows, 1)
    return out.tolist()


def per_document(df: DataFrame, columns: list[str | Column], make: Callable[..., Iterable[dict]],
        schema: str) -> DataFrame:
    """make(value of each column) -> rows, for each row of df; documents are independent, so nothing is shuffled.

    Spark hands over batches of so many bytes (spark.sql.execution.arrow.maxBytesPerBatch); of these, ROWS documents or
    BYTES are taken apart at a time.  Columns are taken by place, so that their names may clash.
    """
    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, n in portions(_sizes(b), rows=ROWS):
                part = b.slice(at, n)
                rows = [r for values in zip(*(c.to_pylist() for c in part.columns)) for r in make(*values)]
                yield from pa.Table.from_pylist(rows, schema=arrow).to_batches()

    given = [F.col(c) if isinstance(c, str) else c for c in columns]
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(given)]).mapInArrow(run, kind)
