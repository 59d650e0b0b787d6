"""Streams of sorted partitions in which the rows of a block come first and its visitors follow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shared import map_batches


def usable(vector: str) -> F.Column:
    """Whether an array is there, has components, and all of them are finite numbers."""
    whole = F.col(vector).isNotNull() & (F.size(vector) > 0)
    return F.coalesce(whole & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrays of equal length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def longs(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(name).to_numpy()


def top(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the ``count`` largest of each row; of equal ones those in the first columns."""
    if scores.shape[1] <= count:
        chosen = np.ones(scores.shape, dtype=bool)
    else:
        least = np.partition(scores, scores.shape[1] - count, axis=1)[:, -count]
        chosen = scores >= least[:, None]
        for row in np.flatnonzero(chosen.sum(axis=1) > count):
            equal = np.flatnonzero(scores[row] == least[row])
            chosen[row, equal[count - int((scores[row] > least[row]).sum()) :]] = False
    return np.nonzero(chosen)


def meet(rows: DataFrame, visitors: DataFrame, prepare: Callable, work: Callable, schema: str, combine: Callable = iter) -> DataFrame:
    """``work(block, visitors)`` for every ``block`` number, where ``block = prepare(rows of that number)``.

    Rows and visitors (of equal columns, ``block`` among them) are dealt by block and sorted so that a block's rows
    come first: one block is held at a time, its visitors pass by in batches.  ``combine`` may reduce the batches that
    a task makes before they are shuffled.
    """
    both = rows.withColumn("side", F.lit(0)).unionByName(visitors.withColumn("side", F.lit(1)), allowMissingColumns=True)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], None
        for batch in batches:
            block, side = longs(batch, "block"), longs(batch, "side")
            ends = np.flatnonzero((np.diff(block) != 0) | (np.diff(side) != 0)) + 1
            for start, end in zip(np.concatenate(([0], ends)), np.concatenate((ends, [len(block)])), strict=True):
                if end == start:
                    continue
                part = batch.slice(start, end - start)
                if block[start] != now:
                    now, held, ready = block[start], [], None
                if side[start] == 0:
                    held.append(part)
                elif held or ready is not None:
                    if ready is None:
                        ready, held = prepare(pa.Table.from_batches(held)), []
                    yield from work(ready, part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return combine(met(batches))

    return map_batches(both.repartition("block").sortWithinPartitions("block", "side"), run, schema)
