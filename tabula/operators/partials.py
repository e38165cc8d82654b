"""Sums of arrays over all rows, tile by tile.

A task reduces its rows to a few tiles (a matrix is cut into blocks of columns) and the tasks' tiles
are merged in a tree of grouped steps: ``FAN_IN`` of them at a time, so no task holds more than that
many states of one tile, however many tasks or columns there are.  The input is read by at most two
tasks a core (a narrow coalesce, no shuffle of rows), which bounds the number of states as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: States merged by one call.
FAN_IN = 16
#: Columns of a tile.
TILE = 256

_SCHEMA = "tile int, slot int, state binary"

Kernel = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]]


def tiles(p: int) -> list[tuple[int, slice, slice]]:
    """(number, rows, columns) of the tiles on and above the diagonal of a p x p matrix."""
    cuts = [slice(a, min(a + TILE, p)) for a in range(0, p, TILE)]
    return [(i * len(cuts) + j, cuts[i], cuts[j]) for i in range(len(cuts)) for j in range(i, len(cuts))]


def reduced(df: DataFrame, kernel: Kernel, merge: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add) -> DataFrame:
    """(tile, slot, state): one row per tile of ``kernel``, its tasks' flat arrays of doubles merged.

    ``kernel`` takes a task's Arrow batches and yields (tile, array).  Tiles are merged in the order
    of the tasks, so equal partitions give equal sums.
    """
    n_tasks = 2 * df.sparkSession.sparkContext.defaultParallelism

    def start(batches):
        slot = TaskContext.get().partitionId()
        for tile, state in kernel(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([tile], pa.int32()), pa.array([slot], pa.int32()), pa.array([np.ascontiguousarray(state, float).tobytes()], pa.binary())],
                names=["tile", "slot", "state"])

    def step(pdf):
        states = [np.frombuffer(s, float) for s in pdf.sort_values("slot")["state"]]
        total = states[0]
        for s in states[1:]:
            total = merge(total, s)
        return pd.DataFrame({"tile": pdf["tile"].iloc[:1], "slot": pdf["slot"].iloc[:1] // FAN_IN, "state": [total.tobytes()]})

    out = df.coalesce(n_tasks).mapInArrow(start, _SCHEMA)
    while n_tasks > 1:
        out = out.groupBy("tile", F.expr(f"slot div {FAN_IN}")).applyInPandas(step, _SCHEMA)
        n_tasks = -(-n_tasks // FAN_IN)
    return out


def column_matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A batch of double columns as (values with 0 for nulls, 1 where there is a value)."""
    x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
    there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
    return x, there.astype(float)


def array_matrix(column: pa.Array, p: int) -> np.ndarray:
    """An array<double> column as a matrix of width ``p``; null elements are NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), p).astype(float)
