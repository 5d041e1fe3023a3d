"""What is known of a table's data files without opening them: Bloom filters of keys, smallest and largest values.

Files never change, so each is read once, when it is first met; rewritten partitions have new files, and what is known of
replaced ones is never asked for.  The index lies beside the table as two Parquet folders that
only grow: one row per file with its bounds, and the filters' words.  A run that fails in between leaves words
that belong to no file yet; the next run writes them again, and a bit that is set twice is set once.

A filter is an array of 64-bit words, as many as a power of two gives each key ``BITS`` bits.  A key sets up to four bits
of one word.  Words are made by an aggregate that combines before the shuffle, and probed by an equality join on the
word's place, so neither keys nor filters pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import path_exists, staged
from tidemark.tables import LakeTable, partition_filter

BITS = 12
MOST_WORDS = 1 << 24
LISTED_FILES = 10_000  # beyond so many files, a lookup reads their partitions

FILE = "_metadata.file_path"


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _place(hashed: Column, size: Column) -> tuple[Column, Column]:
    """The word a key belongs to and the bits it sets there."""
    word = F.shiftrightunsigned(hashed, 40).bitwiseAND(size.cast("long") - 1).cast("int")
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(4)]
    return word, reduce(lambda a, b: a.bitwiseOR(b), bits)


@dataclass(frozen=True)
class FileIndex:
    """An index of ``table``: a filter of the ``keys`` expressions, taken together, and bounds of the ``bounds`` columns."""

    table: LakeTable
    keys: tuple[str, ...] = ()
    bounds: tuple[str, ...] = ()

    @property
    def home(self) -> str:
        name = hashlib.sha256(repr((self.keys, self.bounds)).encode()).hexdigest()[:12]
        return f"{self.table.root}/_index-{name}"

    def _key_types(self) -> list[T.DataType]:
        return [f.dataType for f in self.table.read().select(*[F.expr(e) for e in self.keys]).schema.fields]

    @property
    def _file_schema(self) -> T.StructType:
        types = {f.name: f.dataType for f in self.table.schema.fields}
        layout = [T.StructField(c, types[c]) for c in self.table.partition_by]
        sides = [T.StructField(f"{side}_{k}", types[c]) for k, c in enumerate(self.bounds) for side in ("low", "high")]
        return T.StructType([T.StructField("__file", T.StringType()), T.StructField("__id", T.LongType()), T.StructField("__size", T.IntegerType()),
                             T.StructField("__rows", T.LongType()), *layout, *sides])

    def files(self) -> DataFrame:
        """What is known so far, of replaced files too: ``__file, __id, __size, __rows``, partition columns, ``low_n`` and ``high_n``."""
        spark, path = self.table.spark, f"{self.home}/files"
        if not path_exists(spark, path):
            return spark.createDataFrame([], self._file_schema)
        return spark.read.schema(self._file_schema).parquet(path).dropDuplicates(["__id"])

    def words(self) -> DataFrame:
        spark, path, schema = self.table.spark, f"{self.home}/words", "__id long, __size int, word int, mask long"
        return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)

    def current(self) -> DataFrame:
        """The table's files with their row counts and partitions, from the footers."""
        by = [F.col(f"`{c}`") for c in self.table.partition_by]
        return self.table.read().groupBy(F.col(FILE).alias("__file"), *by).agg(F.count(F.lit(1)).alias("__rows")).withColumn("__id", F.xxhash64("__file"))

    def refresh(self) -> int:
        """Index the files that are new since the last time; returns how many."""
        with staged(self.current()) as (now, _):
            return self._add(now)

    def _add(self, now: DataFrame) -> int:
        size = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("__rows") * BITS / 64)))).cast("int")
        fresh = now.join(self.files().select("__id"), "__id", "left_anti").withColumn("__size", F.least(size, F.lit(MOST_WORDS)))
        with staged(fresh) as (new, _):
            count = new.count()
            if not count:
                return 0
            rows = self.table.read()
            if self.table.partition_by:
                rows = self.table.only(self.table.partition_values(new))
            if count <= LISTED_FILES:
                rows = rows.where(F.col(FILE).isin([r["__file"] for r in new.select("__file").collect()]))
            if self.keys:
                keyed = rows.select(F.xxhash64(FILE).alias("__id"), *[F.expr(e).alias(f"k{n}") for n, e in enumerate(self.keys)])
                names = [f"k{n}" for n in range(len(self.keys))]
                keyed = keyed.where(_all([F.col(n).isNotNull() for n in names])).select("__id", F.xxhash64(*names).alias("h"))
                word, mask = _place(F.col("h"), F.col("__size"))
                placed = keyed.join(new.select("__id", "__size"), "__id").select("__id", "__size", word.alias("word"), mask.alias("mask"))
                placed.groupBy("__id", "__size", "word").agg(F.bit_or("mask").alias("mask")).write.mode("append").parquet(f"{self.home}/words")
            sides = [f(F.col(f"`{c}`")).alias(f"{side}_{k}") for k, c in enumerate(self.bounds) for side, f in (("low", F.min), ("high", F.max))]
            known = new
            if sides:
                found = rows.groupBy(F.xxhash64(FILE).alias("__id")).agg(*sides)
                known = new.join(found, "__id", "left")
            known.select(*self._file_schema.fieldNames()).write.mode("append").parquet(f"{self.home}/files")
            return count

    # --- asking ----------------------------------------------------------------------

    def files_with(self, keys: DataFrame) -> DataFrame:
        """Current files that may hold one of the keys (all that do, and a few per cent of the others).

        Probing compares every key with one word of every file.  Where that is more than the table has rows, all files
        are returned: reading their keys is cheaper then.
        """
        with staged(self.current()) as (now, _), staged(self._hashed(keys)) as (hashed, _):
            self._add(now)
            total = now.agg(F.count(F.lit(1)).alias("files"), F.sum("__rows").alias("__rows")).collect()[0]
            found = self.files().join(now.select("__id"), "__id", "left_semi")
            if hashed.count() * total["files"] <= (total["__rows"] or 0):
                sizes = [r["__size"] for r in self.files().select("__size").distinct().collect()]  # powers of two: 25 at most
                each = hashed.select("h", F.explode(F.array(*[F.lit(s) for s in sizes]).cast("array<int>")).alias("__size"))
                word, mask = _place(F.col("h"), F.col("__size"))
                asked = each.select("__size", word.alias("word"), mask.alias("bits")).distinct()
                hit = F.col("mask").bitwiseAND(F.col("bits")) == F.col("bits")
                held = self.words().join(asked, ["__size", "word"]).where(hit).select("__id").distinct()
                found = found.join(held, "__id", "left_semi")
            return self.table.spark.createDataFrame(found.collect(), found.schema)

    def _hashed(self, keys: DataFrame) -> DataFrame:
        """Hashes of the keys as the table types them; a NULL in a key matches nothing."""
        names = [F.col(f"`{c}`").cast(t).alias(f"k{n}") for n, (c, t) in enumerate(zip(keys.columns, self._key_types(), strict=True))]
        complete = keys.select(*names).where(_all([F.col(f"k{n}").isNotNull() for n in range(len(names))]))
        return complete.select(F.xxhash64(*[f"k{n}" for n in range(len(names))]).alias("h")).distinct()

    def rows_in(self, files: DataFrame) -> DataFrame:
        """The table's rows in some of its files; no other file is opened."""
        rows = self.table.read()
        if self.table.partition_by:
            rows = rows.where(partition_filter(self.table.partition_by, self.table.partition_values(files)))
        names = [r["__file"] for r in files.select("__file").limit(LISTED_FILES + 1).collect()]
        if len(names) <= LISTED_FILES:
            rows = rows.where(F.col(FILE).isin(names) if names else F.lit(False))
        return rows

    def partitions_with(self, keys: DataFrame) -> set[tuple]:
        """Partitions of the files that may hold one of the keys; as many as the table has at most."""
        return set(self.table.partition_values(self.files_with(keys)))

    def files_within(self, ranges: Mapping[str, tuple]) -> DataFrame:
        """Current files whose bounds meet every ``column: (low, high)``, both ends included, None for an open end."""
        unknown = set(ranges) - set(self.bounds)
        if unknown:
            raise ValueError(f"no bounds of {sorted(unknown)}")
        types = {f.name: f.dataType for f in self.table.schema.fields}
        with staged(self.current()) as (now, _):
            self._add(now)
            found = self.files().join(now.select("__id"), "__id", "left_semi")
            for column, (low, high) in ranges.items():
                k = self.bounds.index(column)
                if low is not None:
                    found = found.where(F.col(f"high_{k}") >= F.lit(low).cast(types[column]))
                if high is not None:
                    found = found.where(F.col(f"low_{k}") <= F.lit(high).cast(types[column]))
            return self.table.spark.createDataFrame(found.collect(), found.schema)

    def lookup(self, ranges: Mapping[str, tuple]) -> DataFrame:
        """The table's rows within the ranges, read from the files that can hold them only."""
        types = {f.name: f.dataType for f in self.table.schema.fields}
        rows = self.rows_in(self.files_within(ranges))
        for column, (low, high) in ranges.items():
            if low is not None:
                rows = rows.where(F.col(f"`{column}`") >= F.lit(low).cast(types[column]))
            if high is not None:
                rows = rows.where(F.col(f"`{column}`") <= F.lit(high).cast(types[column]))
        return rows
