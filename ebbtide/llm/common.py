"""What the operators share: shipping the package, staged tables, batches of texts as bytes."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ebbtide.session import scratch_path

#: Rows of one Arrow batch at most; texts are long.
BATCH_ROWS = 1000
#: Bytes of one Arrow batch, more only if a row is larger; packed blocks and files are rows too.
BATCH_BYTES = 8 << 20
#: Bytes of text that one NumPy pass works on.
PIECE_BYTES = 1 << 20



def _give_back() -> None:
    """Large arrays go back to the system when freed. Workers live through many
    stages, and what each leaves in the allocator would add up."""
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 8 << 20)  # smallest block that is mapped by itself
        libc.mallopt(-1, 64 << 20)  # most free memory kept at the end of the heap
        pa.set_memory_pool(pa.system_memory_pool())


def trim() -> None:
    """Return what the allocator holds free; for the end of a task's work, since its
    worker lives on beside those of later stages."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


_give_back()
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package and small Arrow batches, once per application."""
    context = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ebbtide-code-"), "ebbtide_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: computed once, safe when executors go."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array with n + 1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts are about ``limit`` bytes, never less than one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        where = batch.schema.get_field_index(column)
        _, at = as_bytes(batch.column(where))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(k).type) for k, c in columns.items()],
        schema=schema,
    )


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a finaliser of shifts and odd multipliers)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x
