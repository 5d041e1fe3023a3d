"""Clustering that lets readers skip files: each file of a partition holds its own range of the cluster columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.tables import LakeTable, Values

SAMPLE = 4096
BITS = 6  # ranks of a column, as a power of two


def _ranks(rows: DataFrame, columns: tuple[str, ...], bits: int, sample: int) -> list[Column]:
    """Each column's place among the quantiles of a sample, 0 to ``2**bits - 1``; NULL is 0.

    ``sample`` rows are taken by the hash of all their columns, so the same rows give the same ranks; they only decide
    where files end, never which rows are found.
    """
    named = [F.col(f"`{c}`") for c in columns]
    taken = rows.orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])).limit(sample).select(*named)
    cuts = F.sequence(F.lit(1), F.lit((1 << bits) - 1))

    def quantiles(c: Column) -> Column:
        held = F.array_sort(F.collect_list(c))
        return F.transform(cuts, lambda k: F.get(held, F.floor(k * F.size(held) / (1 << bits)).cast("int")).cast("string"))

    found = taken.agg(*[quantiles(c).alias(f"q{n}") for n, c in enumerate(named)]).collect()[0]
    types = {f.name: f.dataType for f in rows.schema.fields}

    def rank(value: Column, bounds: list[Column]) -> Column:
        return F.size(F.filter(F.array(*bounds), lambda bound: bound <= value)) if bounds else F.lit(0)

    return [rank(named[n], [F.lit(text).cast(types[c]) for text in found[f"q{n}"] if text is not None]) for n, c in enumerate(columns)]


def z_value(rows: DataFrame, columns: tuple[str, ...], bits: int = BITS, sample: int = SAMPLE) -> Column:
    """The bits of all columns' ranks, dealt out in turn: rows near in this number are near in every column."""
    if not columns or bits * len(columns) > 62:
        raise ValueError("one column at least, and no more than 62 bits in all")
    ranks = _ranks(rows, columns, bits, sample)
    parts = []
    for bit in range(bits):
        for n, rank in enumerate(ranks):
            at = bit * len(columns) + len(columns) - 1 - n
            parts.append(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"), at))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def clustered(table: LakeTable, rows: DataFrame, pieces: int | None = None, zorder: bool = True) -> DataFrame:
    """Rows in the table's shape, in ranges of its cluster columns within each partition.

    With two columns or more the ranges are of their z-value, so a predicate on any of them skips files; ``zorder=False``
    orders by the first column, then the next.  ``pieces`` is the number of tasks (default: AQE's choice).  A value that a
    third of the rows share is split by a hash of the row.  Spark samples the rows to find the ranges, so store costly ones first.
    """
    if not table.cluster_by:
        raise ValueError(f"{table.name} has no cluster columns")
    shaped = table.shaped(rows)
    named = [F.col(f"`{c}`") for c in table.cluster_by]
    by = [z_value(shaped, table.cluster_by)] if zorder and len(named) > 1 else named
    everything = F.xxhash64(*[F.col(f"`{c}`") for c in shaped.columns])
    ranges = [*[F.col(f"`{c}`") for c in table.partition_by], *by, everything]
    keys = {f"__range{n}": c for n, c in enumerate(ranges)}
    laid = shaped.withColumns(keys)
    return (laid.repartitionByRange(pieces, *keys) if pieces else laid.repartitionByRange(*keys)).drop(*keys)


def overwrite_clustered(table: LakeTable, rows: DataFrame, pieces: int | None = None, zorder: bool = True) -> None:
    """CREATE OR REPLACE … CLUSTER BY … AS SELECT."""
    table.publish(clustered(table, rows, pieces, zorder), table.partitions() if table.partition_by else [])


def recluster(table: LakeTable, partitions: Iterable[Values] | None = None, pieces: int | None = None, zorder: bool = True) -> None:
    """Write partitions again (default: all), clustered; what many small merges left in many files is gathered."""
    if not table.partition_by:
        table.publish(clustered(table, table.read(), pieces, zorder), [])
        return
    chosen = table.partitions() if partitions is None else list(partitions)
    if chosen:
        table.publish(clustered(table, table.only(chosen), pieces, zorder), chosen)
