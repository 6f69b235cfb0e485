"""What several operators share: block-wise work on Arrow rows and small hashing helpers."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Bytes of text that a task turns into numpy arrays at once; one longer text is a block of its own.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def need(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns with clashing names cannot disturb an operator."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[df[n] for n in names])


def schema_of(text: str) -> StructType:
    return _parse_datatype_string(text)


#: Bytes of an Arrow batch: what a Python worker holds in several copies at once.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit of bytes in an Arrow batch to ``BATCH_BYTES`` where it is higher.

    The default of 64 MB, in several copies and workers, is more than a small executor has to spare.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None) or ""
    digits = now[:-1] if now[-1:] == "b" else now
    if not digits.isdigit() or int(digits) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def arrow_map(df: DataFrame, work: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` with columns as Arrow arrays by name, in and out.

    ``work`` gets one dict per Arrow batch and yields dicts of columns; batches are bounded in rows and
    bytes by the session's Arrow settings.
    """
    target = to_arrow_schema(schema_of(schema))
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({n: b.column(i) for i, n in enumerate(b.schema.names)} for b in batches)
        for out in work(columns):
            yield pa.RecordBatch.from_arrays(
                [as_array(out[f.name], f.type) for f in target], schema=target)
        out = None
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back to the machine: a worker that waits for its next task would hold it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def blocks(sizes: list[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to ``limit`` at most, or of one item."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def small_side(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """Hint a broadcast where the rows, of ``row_bytes`` each, are counted to be under ``limit`` bytes.

    Beyond that the join shuffles both sides, as without the hint.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def text_key(text: str = "text"):
    """64-bit hash of a text; with the id it names a row, as equal rows give equal results."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def filesystem(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path for local paths and any scheme that Arrow knows (file, hdfs, s3, gs, abfs)."""
    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return arrow_fs.LocalFileSystem(), local
    return arrow_fs.FileSystem.from_uri(path)
