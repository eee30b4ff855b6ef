"""Columns of vectors: which take part, and their numbers in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each vector length: the rows that have it and their numbers as a matrix."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy() - column.offsets[0].as_py()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[starts[rows][:, None] + np.arange(size)]


def groups(
    batches: Iterator[pa.RecordBatch], keys: int
) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows equal in the first ``keys`` columns, from batches sorted by them.

    A group may reach over batches; only one is held at a time.
    """
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(column[a] for column in columns)
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held:
        yield held_key, pa.Table.from_batches(held)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, to hold fewer Python values at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)
