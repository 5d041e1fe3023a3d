"""Catalog tables made of Parquet partitions.

A changed partition is written to a new folder and the catalog's location for it is
switched afterwards, for all changed partitions by one request.  Readers never see half a
partition, a failed job leaves the table as it was, and the replaced files stay on
storage until they are cleaned up, which is what the retention reports look at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import range_bucket
from tidemark.functions.timewin import instant_literal, naive_utc
from tidemark.session import list_glob, micros_writer, staged

ROOT = "tidemark.root"
CLUSTER = "tidemark.cluster_by"
DERIVED = "tidemark.derived."
UNITS = ("day", "month", "year")
BATCH = "batch_id"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
PARTITIONS_PER_STATEMENT = 500
LISTED_VALUES = 64  # beyond so many values of the leading column, all partitions are listed at once

Values = tuple  # one value per partition column


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, date):
        return f"date'{value}'"
    if isinstance(value, (int, float)):
        return str(value)
    return _quoted(str(value))


def _parse(text: str, dtype: T.DataType):
    if text == NULL_FOLDER:
        return None
    return _typed(unquote(text), dtype)


def _typed(text: str, dtype: T.DataType):
    if text == NULL_FOLDER:
        return None
    if isinstance(dtype, T.DateType):
        return date.fromisoformat(text)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(text)
    if isinstance(dtype, T.StringType):
        return text
    raise TypeError(f"tables are partitioned by dates, integers or text, not {dtype.simpleString()}")


def _any_of(tests: list[Column]) -> Column:
    """OR of many tests as a balanced tree, so a long list does not nest deeply."""
    if len(tests) <= 2:
        return reduce(lambda a, b: a | b, tests)
    half = len(tests) // 2
    return _any_of(tests[:half]) | _any_of(tests[half:])


def partition_filter(columns: tuple[str, ...], values: Iterable[Values]) -> Column:
    """Predicate on partition columns only, which prunes folders at planning time."""
    values = list(values)
    if not values:
        return F.lit(False)
    if len(columns) == 1:
        known = [v[0] for v in values if v[0] is not None]
        tests = [F.col(columns[0]).isin(known)] if known else []
        if len(known) < len(values):
            tests.append(F.col(columns[0]).isNull())
        return _any_of(tests)
    return _any_of([
        reduce(lambda a, b: a & b,
               [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(columns, row, strict=True)])
        for row in values
    ])


@dataclass(frozen=True)
class Derived:
    """A partition column computed from another: ``PARTITION BY DATE(ts)`` and its kin.

    ``rule`` is ``day``, ``month`` or ``year`` (in UTC for instants), or
    ``range_bucket:start:stop:step``.  Every rule is monotone in its source.
    """

    source: str
    rule: str

    def value(self, column: Column, dtype: T.DataType) -> Column:
        if self.rule in UNITS:
            day = (naive_utc(column) if isinstance(dtype, T.TimestampType) else column).cast("date")
            return day if self.rule == "day" else F.trunc(day, self.rule)
        kind, *bounds = self.rule.split(":")
        if kind != "range_bucket" or len(bounds) != 3:
            raise ValueError(f"unknown partition rule {self.rule}")
        return range_bucket(column, *map(int, bounds))

    @property
    def dtype(self) -> T.DataType:
        return T.DateType() if self.rule in UNITS else T.IntegerType()

    def fixed_by(self, on: tuple[str, ...]) -> bool:
        """Do equal ``on`` keys imply equal partitions?"""
        return self.source in on or (self.rule in UNITS and f"to_date({self.source})" in on)


def by_day(column: str) -> Derived:
    return Derived(column, "day")


def by_month(column: str) -> Derived:
    return Derived(column, "month")


def by_year(column: str) -> Derived:
    return Derived(column, "year")


def by_range(column: str, start: int, stop: int, step: int = 1) -> Derived:
    return Derived(column, f"range_bucket:{start}:{stop}:{step}")


@dataclass(frozen=True)
class LakeTable:
    spark: SparkSession
    name: str
    root: str
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    derived: tuple[tuple[str, Derived], ...] = ()

    # --- reading ---------------------------------------------------------------

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    @property
    def schema(self) -> T.StructType:
        return self.read().schema

    def is_empty(self) -> bool:
        """Stops at the first row found, looking into one partition before all of them."""
        if self.partition_by:
            known = self.partitions()
            if not known:
                return True
            if not self.only(known[:1]).isEmpty():
                return False
        return self.read().isEmpty()

    def partitions(self, first: object = None) -> list[Values]:
        """Partition values known to the catalog (folder names, not rows).

        ``first`` limits the listing to one value of the leading partition column.
        """
        types = {f.name: f.dataType for f in self.schema.fields}
        within = "" if first is None else f" PARTITION (`{self.partition_by[0]}`={_literal(first)})"
        out = []
        for (text,) in self.spark.sql(f"SHOW PARTITIONS {self.name}{within}").collect():
            parts = dict(p.split("=", 1) for p in text.split("/"))
            out.append(tuple(_parse(parts[c], types[c]) for c in self.partition_by))
        return out

    def partition_values(self, df: DataFrame) -> list[Values]:
        """Distinct partition values of a batch; as many as the table has folders at most."""
        return [tuple(r) for r in df.select(*self.partition_by).distinct().collect()]

    def only(self, values: Iterable[Values]) -> DataFrame:
        return self.read().where(partition_filter(self.partition_by, values))

    def range(self, column: str, low=None, high=None, closed: str = "both") -> DataFrame:
        """Rows with ``low <= column <= high`` (``closed="left"``: ``< high``); None is an open end.

        Partitions derived from the column are pruned by the same bounds, so readers
        need not know how the folders follow from it, and no file of a pruned folder
        is listed or opened.
        """
        rows = self.read()
        dtype = rows.schema[column].dataType
        derived = [(F.col(n), d) for n, d in self.derived if d.source == column]

        def bound(value) -> Column:
            return F.lit(value) if isinstance(dtype, T.NumericType) else instant_literal(value, dtype)

        if low is not None:
            rows = rows.where(F.col(column) >= bound(low))
            for folder, rule in derived:
                rows = rows.where(folder >= rule.value(bound(low), dtype))
        if high is not None:
            rows = rows.where(F.col(column) <= bound(high) if closed == "both" else F.col(column) < bound(high))
            for folder, rule in derived:
                rows = rows.where(folder <= rule.value(bound(high), dtype))
        return rows

    # --- writing ---------------------------------------------------------------

    def with_derived(self, df: DataFrame) -> DataFrame:
        """Compute the derived partition columns of a batch."""
        types = {f.name: f.dataType for f in df.schema.fields}
        return df.withColumns({n: d.value(F.col(d.source), types[d.source]) for n, d in self.derived}) if self.derived else df

    def shaped(self, df: DataFrame) -> DataFrame:
        """The table's columns in its order and types; absent ones are NULL, derived ones computed."""
        df = self.with_derived(df)
        have = {c.lower() for c in df.columns}
        return df.select(*[
            (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema.fields
        ])

    def spread(self, df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
        """Rows of a partition side by side.

        REBALANCE lets AQE merge small partitions into one task and cut a big one
        into several, so a day that holds a third of the rows is not one task's work.
        Columns in ``skip`` are constant and need no exchange.
        """
        by = [c for c in self.partition_by if c not in skip]
        return df.hint("rebalance", *by) if by else df

    def sorted(self, df: DataFrame) -> DataFrame:
        """Each task's rows by partition, then by the cluster columns."""
        order = (*self.partition_by, *self.cluster_by)
        return df.sortWithinPartitions(*order) if order else df

    def _write_version(self, df: DataFrame) -> str:
        version = f"{self.root}/v-{uuid.uuid4().hex}"
        # A micro-batch has a session of its own, whose settings its writes follow.
        with micros_writer(df.sparkSession):
            writer = self.sorted(df).write
            (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(version)
        return version

    def insert(self, df: DataFrame) -> None:
        """INSERT: add files to the partitions as they are."""
        with micros_writer(df.sparkSession):
            self.sorted(self.spread(self.shaped(df))).write.insertInto(self.name)

    def append_batch(self, df: DataFrame, batch_id: str) -> bool:
        """Append a batch under its own ``batch_id`` partition; what the batch holds already stays.

        Running a batch again adds the rows that it does not hold yet, equal in every column, so an
        append that is retried or replayed leaves the rows once, and a run that no longer finds
        a row, because the source has moved on, takes none away.  Only the partitions that get rows are
        written again, with all they held.  The rows are computed once.  Returns whether the run had any.
        """
        if not self.partition_by or self.partition_by[0] != BATCH:
            raise ValueError(f"{self.name} is not partitioned by {BATCH} first")
        rows = self.shaped(df.withColumn(BATCH, F.lit(batch_id)))
        if not self._held({batch_id}):
            return self.publish(self.spread(rows, skip=(BATCH,)), [])
        with staged(rows) as (run, _):
            if run.isEmpty():
                return False
            with staged(self._unheld(run, batch_id)) as (fresh, _):
                touched = self.partition_values(fresh)
                if touched:
                    self.publish(self.spread(self.only(touched).unionByName(fresh), skip=(BATCH,)), touched)
            return True

    def _unheld(self, rows: DataFrame, batch_id: str) -> DataFrame:
        """Rows that differ in some column from every row of the batch.

        Both sides are joined on a hash of all columns; a hash that very many rows share is split by AQE.
        """
        computed = {BATCH, *(n for n, _ in self.derived)}
        columns = [f.name for f in self.schema.fields if f.name not in computed]
        digest = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("__digest")
        there = self.read().where(F.col(BATCH) == batch_id).select(*[F.col(f"`{c}`") for c in columns], digest)
        same = reduce(lambda a, b: a & b, [F.col(f"n.`{c}`").eqNullSafe(F.col(f"h.`{c}`")) for c in columns])
        return rows.select("*", digest).alias("n").join(
            there.alias("h"), (F.col("n.__digest") == F.col("h.__digest")) & same, "left_anti").drop("__digest")

    def replace_partitions(self, df: DataFrame, touched: Iterable[Values]) -> None:
        """Publish ``df`` as the whole new content of the ``touched`` partitions.

        A touched partition without rows in ``df`` is dropped from the catalog.
        """
        self.publish(self.spread(self.shaped(df)), touched)

    def publish(self, rows: DataFrame, touched: Iterable[Values]) -> bool:
        """:meth:`replace_partitions` for rows in the table's shape, written from the tasks they are in.

        Rows that were read from this table still lie by partition and need no
        exchange.  All partitions that the catalog holds already are switched by one
        request.  Returns whether any partition was written.
        """
        version = self._write_version(rows)
        if not self.partition_by:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION {_quoted(version)}")
            self.spark.catalog.refreshTable(self.name)
            return True
        written, touched = self._written(version), set(touched)
        held = self._held({v[0] for v in (*touched, *written)})
        new = [(v, loc) for v, loc in written.items() if v not in held]
        for start in range(0, len(new), PARTITIONS_PER_STATEMENT):
            chunk = new[start:start + PARTITIONS_PER_STATEMENT]
            clauses = " ".join(f"PARTITION ({self._spec(v)}) LOCATION {_quoted(loc)}" for v, loc in chunk)
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {clauses}")
        self._relocate([(held[v], loc) for v, loc in written.items() if v in held])
        self.drop_partitions([v for v in touched if v in held and v not in written])
        self.spark.catalog.refreshTable(self.name)
        return bool(written)

    def _catalog(self):
        """The session catalog and this table's name in it."""
        state = self.spark._jsparkSession.sessionState()
        return state.catalog(), state.sqlParser().parseTableIdentifier(self.name)

    def _held(self, leading: set) -> dict[Values, object]:
        """The catalog's partitions under some values of the leading partition column, listed by those values."""
        types = {f.name: f.dataType for f in self.schema.fields}
        catalog, name = self._catalog()
        jvm, first = self.spark._jvm, self.partition_by[0]
        if None in leading or len(leading) > LISTED_VALUES:
            wanted = [jvm.scala.Option.empty()]
        else:
            specs = ({first: f"{value}"} for value in leading)
            wanted = [jvm.scala.Some(jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(spec)) for spec in specs]
        out = {}
        for spec in wanted:
            found = catalog.listPartitions(name, spec)
            for i in range(found.size()):
                part = found.apply(i)
                texts = (part.spec().apply(c) for c in self.partition_by)
                out[tuple(None if t is None else _typed(t, types[c]) for c, t in zip(self.partition_by, texts, strict=True))] = part
        return out

    def _relocate(self, moves: list[tuple[object, str]]) -> None:
        """Point partitions at new folders, all in one request to the catalog."""
        if not moves:
            return
        jvm = self.spark._jvm
        changed = []
        for part, location in moves:
            old = part.storage()
            place = jvm.scala.Some(jvm.org.apache.hadoop.fs.Path(location).toUri())
            storage = old.copy(place, old.inputFormat(), old.outputFormat(), old.serde(), old.compressed(), old.properties())
            changed.append(part.copy(part.spec(), storage, part.parameters(), part.createTime(), part.lastAccessTime(), jvm.scala.Option.empty()))
        catalog, name = self._catalog()
        catalog.alterPartitions(name, jvm.org.apache.spark.api.python.PythonUtils.toSeq(changed))

    def locations(self) -> list[str]:
        """Folders the current content is read from, as the catalog names them."""
        catalog, name = self._catalog()
        if not self.partition_by:
            return [catalog.getTableMetadata(name).location().toString()]
        found = catalog.listPartitions(name, self.spark._jvm.scala.Option.empty())
        return [found.apply(i).location().toString() for i in range(found.size())]

    def overwrite(self, df: DataFrame) -> None:
        """CREATE OR REPLACE TABLE … AS SELECT."""
        self.replace_partitions(df, self.partitions() if self.partition_by else [])

    def drop_partitions(self, values: Iterable[Values]) -> None:
        """Drop partitions; the table is external, so their files stay on storage."""
        values = list(values)
        for start in range(0, len(values), PARTITIONS_PER_STATEMENT):
            clauses = ", ".join(f"PARTITION ({self._spec(v)})" for v in values[start:start + PARTITIONS_PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {clauses}")

    def add_columns(self, fields: list[T.StructField]) -> list[T.StructField]:
        """ADD COLUMN IF NOT EXISTS for each field; returns those that were missing."""
        have = {c.lower() for c in self.read().columns}
        missing = [f for f in fields if f.name.lower() not in have]
        if missing:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({columns})")
        return missing

    def _spec(self, values: Values) -> str:
        return ", ".join(f"`{c}`={_literal(v)}" for c, v in zip(self.partition_by, values, strict=True))

    def _written(self, version: str) -> dict[Values, str]:
        """Partition folders a write produced."""
        types = {f.name: f.dataType for f in self.schema.fields}
        pattern = "/".join([version, *(f"{c}=*" for c in self.partition_by)])
        found = {}
        for location in list_glob(self.spark, pattern):
            names = location.split("/")[-len(self.partition_by):]
            values = tuple(_parse(n.split("=", 1)[1], types[c]) for n, c in zip(names, self.partition_by, strict=True))
            found[values] = location
        return found


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType, root: str, *,
                 partition_by: tuple[str, ...] = (), cluster_by: tuple[str, ...] = (),
                 derived: dict[str, Derived] | None = None, replace: bool = False) -> LakeTable:
    """CREATE TABLE IF NOT EXISTS, or CREATE OR REPLACE, with partition and cluster columns and no rows.

    Plain Parquet tables partition by stored columns only.  A column in ``derived``
    is added to the schema and filled on every write, e.g.
    ``partition_by=("created_day",), derived={"created_day": by_day("created_at")}``.
    """
    derived = derived or {}
    missing = [T.StructField(n, d.dtype) for n, d in derived.items() if n not in schema.fieldNames()]
    schema = T.StructType([*schema.fields, *missing])
    unknown = set(partition_by) | set(cluster_by) | {d.source for d in derived.values()}
    unknown -= set(schema.fieldNames())
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    root = root.rstrip("/")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    properties = {ROOT: root, CLUSTER: ",".join(cluster_by)}
    properties |= {DERIVED + n: f"{d.source}|{d.rule}" for n, d in derived.items()}
    listed = ", ".join(f"{_quoted(k)}={_quoted(v)}" for k, v in properties.items())
    if replace:
        # Plain Parquet tables have no CREATE OR REPLACE; the old files stay on storage.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {layout} "
        f"LOCATION {_quoted(f'{root}/v-{uuid.uuid4().hex}')} TBLPROPERTIES ({listed})"
    )
    return open_table(spark, name)


def open_table(spark: SparkSession, name: str) -> LakeTable:
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if ROOT not in properties:
        raise ValueError(f"{name} was not made by create_table")
    partition_by = tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    cluster_by = tuple(c for c in properties.get(CLUSTER, "").split(",") if c)
    derived = tuple(
        (k.removeprefix(DERIVED), Derived(*v.split("|", 1))) for k, v in properties.items() if k.startswith(DERIVED)
    )
    return LakeTable(spark, name, properties[ROOT], partition_by, cluster_by, derived)


def with_batch(schema: T.StructType) -> T.StructType:
    """A history schema: the table's columns plus the batch they came with."""
    return T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
