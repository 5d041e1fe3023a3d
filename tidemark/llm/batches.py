"""Arrow batches in small portions, so that a Python worker never holds the values of a whole batch."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa

#: Rows that are turned into Python objects at a time.
PORTION = 512


def values(column: pa.Array, portion: int = PORTION) -> Iterator[Any]:
    for first in range(0, len(column), portion):
        yield from column.slice(first, portion).to_pylist()


def portions(batches: Iterator[pa.RecordBatch], rows: int = PORTION) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
