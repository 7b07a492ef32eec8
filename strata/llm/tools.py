"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of the text contracts: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows turned into Python objects at a time.
SLICE = 64


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in small record batches, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_rows(df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable[[dict], list]],
             rows: int = SLICE) -> DataFrame:
    """``make()`` runs once per task; what it returns turns the column lists of a slice into output columns.

    Only `columns` are read, so further columns of `df`, whatever their names, play no part.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = make()
        for part in slices(batches, rows):
            out = work(part.to_pydict())
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, target)], schema=target)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)
