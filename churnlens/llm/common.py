"""Helpers shared by the corpus operators: table access and byte views of Arrow text columns."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.session import size_shuffle_partitions


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their working folder
    (on a cluster it is installed or shipped with the job; a path that is not there does no harm)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


#: Compressed input that a shuffle partition stands for: operators shuffle up to about three times their input.
SHUFFLE_BYTES = 48 * 1024 * 1024


def read_table(spark: SparkSession, sf_dir: str, name: str, sized: bool = True) -> DataFrame:
    """A table of the folder; unless the user set their number, shuffle partitions follow its size (with
    ``sized=False``, for a table beside a query's main one, they stay)."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    if sized:
        size_shuffle_partitions(spark, [path], SHUFFLE_BYTES)
    return spark.read.parquet(path)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fold that is never learned from: crc32 of the id's text divisible by five.
    A null id is in neither fold, so this is false for it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def learnable(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 != 0, F.lit(False))


def byte_view(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets, without copying; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs_of_rows(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes each (a longer row stands alone)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def table_batches(table_rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(table_rows[f.name], f.type) for f in schema], schema=schema)
