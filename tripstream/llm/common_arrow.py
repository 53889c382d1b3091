"""Columns computed batch by batch in Arrow, with every other column passed through untouched."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripstream.llm.pretokens import give_back

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
         "boolean": pa.bool_()}

#: Rows worked on at a time, so that what a batch is turned into needn't be held whole.
ROWS = 500


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null as the empty string."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def appended(
    docs: DataFrame, added: dict[str, str], make: Callable[[], Callable[[pa.RecordBatch], list]], keep: list[str] | None = None
) -> DataFrame:
    """docs (or its columns in keep) with columns added by name and type; make() gives one task's function from batch to columns."""
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in {a.lower() for a in added}]
    places = [docs.columns.index(c) for c in names]
    fields = [docs.schema[i] for i in places] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in added.items()]
    kinds = [ARROW[t] for t in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            made = [pa.array(v, k) for v, k in zip(work(batch), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), *made], names=[*names, *added])
        del work
        give_back()

    return docs.mapInArrow(run, T.StructType(fields))
