"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Rows that Spark hands to Python go on in slices of about this many bytes, so memory does not follow the length of texts.
SLICE_BYTES = 4 << 20
#: Rows that Spark hands to Python at a time.
BATCH_ROWS = 1000


def scale(df: DataFrame) -> int:
    """Number of partitions to deal work out to: follows the splits of the input and is never below the session's setting."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * df.rdd.getNumPartitions())


def for_python(df: DataFrame) -> DataFrame:
    """`df`, about to be read by Python: the session's Arrow batches are cut down to `BATCH_ROWS`, since texts may be long."""
    key, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return df


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that hold about `limit` bytes of `column` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([0 if v is None else v for v in pc.binary_length(batch.column(column)).to_pylist()], np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            yield batch.slice(lo, hi - lo)
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links a-b: the smallest node each one is connected to."""
    label = np.arange(n)
    while a.size:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        new = new[label]
        if (new == label).all():
            break
        label = new
    return label
