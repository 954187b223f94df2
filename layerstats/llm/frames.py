"""Adding columns to a frame with work over Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text worked on at a time; what a worker holds besides is some twenty times that.
PIECE_BYTES = 2 << 20


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return freed memory to the system. Spark uses Python workers again, and an idle one should hold little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``most`` bytes of text; a longer text is a run of its own."""
    sizes = np.zeros(batch.num_rows + 1, np.int64)
    texts = batch.column(column)
    if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type):
        lengths = pc.binary_length(texts).fill_null(0)
        np.cumsum(lengths.to_numpy(zero_copy_only=False), out=sizes[1:])
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(sizes, sizes[at] + most, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop
    give_back()


def with_columns(
    df: DataFrame,
    text: str,
    added: Sequence[tuple[str, T.DataType]],
    work: Callable[[pa.Array], Sequence[pa.Array]],
    keep_text: bool = True,
    after: Callable[[], None] = lambda: None,
) -> DataFrame:
    """``df`` with columns made from one text column, which goes if not ``keep_text``; a task ends with ``after``.

    An input column whose name equals a new one's, in whatever case, is replaced.
    Names that occur twice in ``df`` are refused, as Spark refuses to name them.
    """
    names = {name.lower() for name, _ in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in names and (keep_text or f.name != text)]
    source = free_name(df, "__text")
    inputs = df.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{text}`").cast("string").alias(source))
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, kind in added)])
    keep = [field.name for field in kept]
    make = [name for name, _ in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, source):
                columns = work(part.column(source))
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in keep), *columns], [*keep, *make])
        after()
        give_back()

    return inputs.mapInArrow(run, schema)
