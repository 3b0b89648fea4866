"""Batches of rows in smaller parts, so that a task holds the Python values of some rows only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Rows that a task works on at once.
ROWS = 256


def smaller(batches: Iterator[pa.RecordBatch], rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, at most ``rows`` (or ``ROWS``) a batch; empty batches are left out."""
    step = rows or ROWS
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
