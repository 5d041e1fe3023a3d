"""Vectors as rows of small integers, and tables that rounds of a clustering write and read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components beyond this are refused: squared distances and sums over a table have to fit into 64 bits.
LARGEST = 1 << 26
#: Vectors compared at a time; temporary arrays hold a few values for each and every entry.
PORTION = 4096


def usable(vector: Column) -> Column:
    """Is the vector there, without null and without components that are not finite?"""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``row, id, v``: usable vectors with every component as ``floor(scale * x)``; ``row`` holds all other columns."""
    def component(x: Column) -> Column:
        value = F.floor(F.lit(float(scale)) * x.cast("double"))
        too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("int")
        # Null without an error where it is not finite: Spark may compute it before it drops the row.
        return F.when(value.between(-LARGEST, LARGEST), value.cast("int")).when(F.abs(x) < float("inf"), too_large)

    vector = F.col(f"`{vector_col}`")
    rest = [F.col(f"`{c}`") for c in vectors.columns if c.lower() != vector_col.lower()]
    return vectors.where(usable(vector)).select(F.struct(*rest).alias("row"), F.col(f"`{id_col}`").alias("id"), F.transform(vector, component).alias("v"))


def matrix(lists: pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(lists), width)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width) if width else np.zeros(n + 1), pa.int32()), pa.array(values.ravel(), kind))


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, PORTION):
            yield batch.slice(first, PORTION)


def added(sums: DataFrame, size: int) -> np.ndarray:
    """The total of ``sums(sums array<long>)`` by position: one row per task goes in, ``size`` numbers come to the driver."""
    out = np.zeros(size, np.int64)
    totals = sums.select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    for r in totals.collect():
        out[r["at"]] = r["n"]
    return out


def means(totals: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Componentwise ``floor(sum / count)``; ``totals`` has a count after the components, and what nothing belongs to stays."""
    counts = totals[..., -1:]
    return np.where(counts > 0, totals[..., :-1] // np.maximum(counts, 1), before)


def by_number(number: Column, values: list) -> Column:
    """The literal with this position, from 0; for lists as short as a list of entries or centroids."""
    if not values:
        return F.lit(None)
    return F.get(F.array(*[F.lit(v) for v in values]), number)


