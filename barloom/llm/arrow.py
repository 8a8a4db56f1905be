"""A column computed from another one inside Python tasks, with every other column passed through."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Values of one output batch, so that a batch of long texts is not held twice.
ROWS_OUT = 1000


def with_columns(df: DataFrame, source: str, fields: list[T.StructField],
                 start: Callable[[], Callable[[object], tuple]]) -> DataFrame:
    """``df`` with ``fields`` computed from column ``source``; columns of their names are replaced.

    ``start`` runs once per task and gives the function from a value to the tuple of new values.
    """
    names = [f.name for f in fields]
    schema = T.StructType([f for f in df.schema.fields if f.name not in names] + fields)
    kinds = [pa.float64() if isinstance(f.dataType, T.DoubleType) else
             pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for whole in batches:
            for k in range(0, len(whole), ROWS_OUT):
                batch = whole.slice(k, ROWS_OUT)
                values = [compute(v.as_py()) for v in batch.column(batch.schema.names.index(source))]
                kept = [n for n in batch.schema.names if n not in names]
                made = [pa.array([v[j] for v in values], kind) for j, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.names.index(n)) for n in kept), *made],
                    names=[*kept, *names])

    return df.mapInArrow(run, schema)
