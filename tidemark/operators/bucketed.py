"""Serving tables bucketed by their merge key: a merge reads them side by side with the batch and never exchanges them.

For tables that most merges touch throughout, so that finding partitions gains nothing.  The files of a version are
bucketed and sorted by key; a merge exchanges the batch into as many tasks as there are buckets, joins each with its own bucket,
and writes what comes out as that bucket's next version.  The table's location is then switched by one statement, so readers see
one version or the other, and a merge that fails leaves the table alone.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import MergeSpec, merge_branches, merge_into_nothing
from tidemark.session import micros_writer, staged


@dataclass(frozen=True)
class BucketedTable:
    """``keys`` are the columns that merges match on, all of them."""

    spark: SparkSession
    name: str
    root: str
    keys: tuple[str, ...]
    buckets: int

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def shaped(self, df: DataFrame) -> DataFrame:
        """The table's columns in its order and types; absent ones are NULL."""
        have = {c.lower() for c in df.columns}
        return df.select(*[(F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in self.read().schema.fields])

    def overwrite(self, df: DataFrame) -> None:
        """The next version from rows that lie anywhere: one exchange by key."""
        self._publish(self.shaped(df).repartition(self.buckets, *self.keys))

    def _publish(self, rows: DataFrame) -> None:
        version, passing = f"{self.root}/v-{uuid.uuid4().hex}", f"{self.name}_{uuid.uuid4().hex[:12]}"
        try:
            with micros_writer(rows.sparkSession):
                rows.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", version).saveAsTable(passing)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {passing}")  # its files are the version and stay
        self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{version}'")
        self.spark.catalog.refreshTable(self.name)

    def merged(self, batch: DataFrame, spec: MergeSpec, *, unique_source: bool = False) -> DataFrame:
        """The table after a merge, in tasks that hold one bucket each."""
        if set(spec.on) != set(self.keys):
            raise ValueError(f"{self.name} is bucketed by {self.keys}, the merge matches on {spec.on}")
        # Without new rows the merge is a left join, in which a small batch is broadcast: no exchange either.
        rows, added = merge_branches(self.read(), batch, spec, unique_source=unique_source, repeated_keys=False)
        return self.shaped(rows if added is None else rows.unionByName(added))

    def merge(self, source: DataFrame, spec: MergeSpec, *, unique_source: bool = False) -> None:
        """Merge a batch.  It is stored first; the table's rows are read once, joined where they lie, and written where they were read."""
        with staged(source) as (batch, _):
            if batch.isEmpty():
                return
            if self.read().isEmpty():
                self.overwrite(merge_into_nothing(batch, spec, self.read().schema, unique_source=unique_source))
            else:
                self._publish(self.merged(batch, spec, unique_source=unique_source))


def create_bucketed(spark: SparkSession, name: str, schema: T.StructType, root: str, keys: tuple[str, ...], buckets: int) -> BucketedTable:
    """CREATE TABLE IF NOT EXISTS … CLUSTERED BY the keys, without rows.

    Choose ``buckets`` so that one, at the size the table will have, fits a task: they stay as many.
    """
    unknown = set(keys) - set(schema.fieldNames())
    if unknown or not keys or buckets < 1:
        raise ValueError(f"keys of the schema and one bucket at least; not in the schema: {sorted(unknown)}")
    root = root.rstrip("/")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
              f"LOCATION '{root}/v-{uuid.uuid4().hex}'")
    return BucketedTable(spark, name, root, tuple(keys), buckets)
