"""INSERT, UPDATE and DELETE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.tables import LakeTable


def update(df: DataFrame, assignments: dict[str, str | Column], where: str | Column) -> DataFrame:
    """Set columns on the rows where the predicate is true; all use the old values."""
    test = F.expr(where) if isinstance(where, str) else where
    types = {f.name: f.dataType for f in df.schema.fields}
    if set(assignments) - set(types):
        raise ValueError(f"no column {sorted(set(assignments) - set(types))}")

    def value(name: str) -> Column:
        old, new = F.col(f"`{name}`"), assignments.get(name)
        if new is None:
            return old
        new = F.expr(new) if isinstance(new, str) else new
        return F.when(test, new.cast(types[name])).otherwise(old).alias(name)

    return df.select(*[value(c) for c in df.columns])


def delete(df: DataFrame, where: str | Column) -> DataFrame:
    """Drop the rows where the predicate is true; where it is NULL they stay."""
    test = F.expr(where) if isinstance(where, str) else where
    return df.where(~F.coalesce(test, F.lit(False)))


def insert_rows(table: LakeTable, rows: DataFrame) -> None:
    """INSERT INTO t (columns) …; columns the rows do not have are NULL."""
    table.insert(rows)


def insert_values(table: LakeTable, columns: tuple[str, ...], *rows: tuple) -> None:
    """INSERT INTO t (columns) VALUES (…), (…); a value is a plain one or an expression such as the current time."""
    if any(len(row) != len(columns) for row in rows) or not rows:
        raise ValueError("every row needs a value for each of the columns")
    types = {f.name: f.dataType for f in table.schema.fields}

    def row_of(values: tuple) -> Column:
        cells = [v if isinstance(v, Column) else F.lit(v) for v in values]
        return F.struct(*[v.cast(types[c]).alias(c) for c, v in zip(columns, cells, strict=True)])

    one = table.spark.range(1).select(F.inline(F.array(*[row_of(r) for r in rows])))
    insert_rows(table, one)


def update_table(table: LakeTable, assignments: dict[str, str | Column], where: str) -> None:
    """UPDATE, rewriting only the partitions that hold a matching row."""
    moved = set(assignments) & (set(table.partition_by) | {d.source for _, d in table.derived})
    if moved:
        raise ValueError(f"cannot set partition columns {sorted(moved)}")
    _rewrite(table, where, lambda df: update(df, assignments, where))


def delete_table(table: LakeTable, where: str) -> None:
    """DELETE, rewriting only the partitions that hold a matching row."""
    _rewrite(table, where, lambda df: delete(df, where))


def _rewrite(table: LakeTable, where: str, change) -> None:
    if not table.partition_by:
        table.overwrite(change(table.read()))
        return
    # Only the predicate's and the partition columns are read to find the partitions.
    touched = table.partition_values(table.read().where(F.expr(where)))
    if touched:
        # No row changes its partition, so each is written by the task that read it.
        table.publish(table.shaped(change(table.only(touched))), touched)
