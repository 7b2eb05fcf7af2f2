"""Packed numbers and bucketed scratch tables that several operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.session import scratch_path


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of their places, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(blob: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob, n * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).reshape(-1).view(kind)


def bucketed(table: DataFrame, key: str, name: str) -> DataFrame:
    """The rows as a scratch table bucketed by ``key``: a join by that key
    moves only the other side.  One bucket per shuffle partition."""
    spark = table.sparkSession
    path = scratch_path(spark, name)
    own = path.rsplit("/", 1)[1].replace("-", "_")
    table.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortBy(key) \
        .option("compression", "uncompressed").saveAsTable(own, format="parquet", path=path)
    return spark.table(own)
