"""Sums of matrices that the tasks of a scan fill."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 512
"""Rows of a matrix that travel together."""
MERGED, STEPS = 256, 2
"""Sums that one key adds in a step; steps before the last, enough for MERGED**STEPS tasks and as many times more as the last adds."""
_SCHEMA = "part long, chunk int, block binary"


def _emit(matrix: np.ndarray, part: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(matrix), ROWS):
        block = matrix[at : at + ROWS]
        if block.any():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([at // ROWS], pa.int32()), pa.array([block.tobytes()], pa.binary())], ["part", "chunk", "block"])


def _added(dtype: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for part, chunk, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                found, key = np.frombuffer(block.as_buffer(), dtype), (part // MERGED, chunk)
                if key in sums:
                    sums[key] += found
                else:
                    sums[key] = found.copy()
        for (part, chunk), block in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([chunk], pa.int32()), pa.array([block.tobytes()], pa.binary())], ["part", "chunk", "block"])

    return run


def matrix_sum(rows: DataFrame, fill: Callable[[Iterator[pa.RecordBatch], np.ndarray], None], shape: tuple[int, int], dtype: str = "<f4") -> np.ndarray:
    """Sum over all tasks of the matrix that fill(batches, matrix) fills from a task's rows.

    The matrix has the same size whatever the input; so has what reaches the driver.
    Sums are added as a tree: MERGED blocks of a chunk in each step, one at a time, dealt out
    by chunk and group, first over the session's shuffle partitions or one for each chunk; after STEPS of them a
    million tasks have left 16 blocks of a chunk for the last.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = np.zeros(shape, dtype)
        fill(batches, matrix)
        yield from _emit(matrix, TaskContext.get().partitionId())

    parts = rows.mapInArrow(run, _SCHEMA)
    n = -(-shape[0] // ROWS)
    # a number, for blocks are few and large: joined partitions would be read by fewer tasks than there are chunks
    many = max(n, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for k in range(STEPS):
        parts = parts.repartition(many if k == 0 else n, "chunk", F.floor(F.col("part") / MERGED)).mapInArrow(_added(dtype), _SCHEMA)
    whole = parts.withColumn("part", F.lit(0).cast("long")).repartition(n, "chunk").mapInArrow(_added(dtype), _SCHEMA)
    out = np.zeros(shape, dtype)
    for x in whole.collect():
        block = np.frombuffer(x["block"], dtype).reshape(-1, shape[1])
        out[x["chunk"] * ROWS : x["chunk"] * ROWS + len(block)] += block
    return out
