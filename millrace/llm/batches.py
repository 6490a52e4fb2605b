"""Arrow batches of text as byte arrays, and the session settings the text passes rely on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import configure

#: A text pass holds one Arrow batch at a time; a batch ends at this many bytes or rows.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "32768",
}


def prepare(spark: SparkSession) -> SparkSession:
    """The runtime settings of the library plus bounded Arrow batches."""
    configure(spark)
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def text_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column with nulls as empty texts, as ``large_string``."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_string()).fill_null("")


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a ``large_string`` array, and where each begins (one more entry than texts)."""
    buffers = texts.buffers()
    if len(texts) == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    starts = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[starts[0] : starts[-1]]
    return data, starts - starts[0]


def runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive items as slices of about ``limit`` in total; a larger item stands alone."""
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > limit:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def with_columns(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``df`` followed by new columns, given as name and DDL type."""
    added = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))
    return T.StructType([*df.schema.fields, *added.fields])


def over_batches(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow``; what Arrow keeps for later goes back to the system after each partition.

    Workers live on between stages, and what they keep counts against the executor's memory.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(whole, schema)


def appended(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """``batch`` followed by new columns."""
    arrays = [*batch.columns, *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values())]
    return pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *columns])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` changed where needed so that none clashes with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


#: Rows up to which one side of a join is broadcast; such rows have a few fixed-size columns, so this is under 64 MB.
BROADCAST_ROWS = 1 << 19


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has few rows (``rows`` of them, or counted now); beyond, the join is shuffled."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df
