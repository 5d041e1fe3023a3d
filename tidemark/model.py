"""Roles of the columns in a change table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ChangeTable:
    """Which columns of a table play which part.

    ``key`` identifies a row, ``version`` orders its changes, ``tombstone`` is set
    once the row was deleted at the source, ``partition`` is the column the serving
    table is laid out by, ``fixed`` columns are written on insert and never again.
    """

    key: tuple[str, ...]
    version: str
    tombstone: str
    schema: T.StructType
    partition: str | None = None
    fixed: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.schema.fieldNames())

    @property
    def mutable(self) -> tuple[str, ...]:
        """Columns an update may overwrite: all but the key and the fixed ones."""
        return tuple(c for c in self.columns if c not in self.key and c not in self.fixed)


def _instants(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.TimestampType()) for n in names]


# The two change tables of the worked examples, with their columns
# in table order.
USERS = ChangeTable(
    key=("id",),
    version="updated_at",
    tombstone="deleted_at",
    schema=T.StructType(
        [T.StructField(n, T.StringType()) for n in ("id", "name", "email")]
        + _instants("created_at", "updated_at", "deleted_at")
    ),
    fixed=("created_at",),
)

TRANSAKSI = ChangeTable(
    key=("id_transaksi",),
    version="updated_at",
    tombstone="deleted_at",
    schema=T.StructType(
        [
            T.StructField("id_transaksi", T.StringType()),
            T.StructField("jumlah", T.DoubleType()),
            T.StructField("status", T.StringType()),
            T.StructField("tanggal_transaksi", T.DateType()),
        ]
        + _instants("created_at", "updated_at", "deleted_at")
    ),
    partition="tanggal_transaksi",
    fixed=("created_at",),
)
