"""File scans: globs, Hive folders, dated prefixes, inventories."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timewin import shifted_batch_date
from tidemark.tables import LakeTable


# Which files lie "below" a folder or pattern, for every reader that looks there.
BELOW = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}


def scan_below(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Every Parquet file below a folder or pattern, however deep, with a declared schema."""
    return spark.read.schema(schema).options(**BELOW).parquet(root)


def scan_glob(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """Every Parquet file under a wildcard; a new call sees newly landed files.

    With a declared schema no footer has to be read for inference, and columns a
    file does not have are NULL.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(pattern)


def scan_hive(spark: SparkSession, root: str, schema: T.StructType, partitions: dict[str, T.DataType]) -> DataFrame:
    """Folders ``a=…/b=…`` with declared partition types."""
    declared = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in partitions.items()]])
    return spark.read.schema(declared).option("basePath", root).parquet(root)


def scan_hive_repaired(spark: SparkSession, root: str, schema: T.StructType, partitions: dict[str, T.DataType]) -> DataFrame:
    """Like :func:`scan_hive`, leaving out folders whose value is not of the declared type.

    Folder values are read as text and cast, so ``year=null`` is dropped instead of
    failing the scan.  The filter uses partition columns alone, so those folders are
    pruned and never opened.
    """
    as_text = scan_hive(spark, root, schema, dict.fromkeys(partitions, T.StringType()))
    usable = [F.col(n).try_cast(t).isNotNull() for n, t in partitions.items()]
    kept = as_text
    for test in usable:
        kept = kept.where(test)
    return kept.withColumns({n: F.col(n).try_cast(t) for n, t in partitions.items()})


def export_folder(root: str, day: str) -> str:
    """Folder of one dated batch; ``day`` is ``YYYYMMDD``."""
    return f"{root.rstrip('/')}/export_{day}"


def scan_dated(spark: SparkSession, root: str, run_time: datetime, *, hours: int = 7,
               schema: T.StructType | None = None) -> DataFrame:
    """Only the folder of this run: the run time moved by ``hours``, as ``YYYYMMDD``."""
    return scan_glob(spark, f"{export_folder(root, shifted_batch_date(run_time, hours))}/*.parquet", schema)


def scan_dated_by_filter(spark: SparkSession, root: str, day: str, schema: T.StructType | None = None) -> DataFrame:
    """The same rows as a filter on the file path, for a frame over the whole prefix."""
    every = scan_glob(spark, f"{root.rstrip('/')}/export_*/*.parquet", schema)
    return every.where(F.col("_metadata.file_path").contains(f"/export_{day}/"))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and time of every Parquet file below a folder; no file is opened.

    The content column is pruned, so only the listing is paid for, and Spark lists
    large trees on the executors.
    """
    files = spark.read.format("binaryFile").options(**BELOW).load(root)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def active_folders(table: LakeTable) -> DataFrame:
    """Folders the catalog names as the table's content: one per partition, or the table's own.

    No row and no file is read, so a folder whose files hold no rows is active too.
    """
    return table.spark.createDataFrame([(plain_uri(location),) for location in table.locations()], "folder string")


def with_folder(files: DataFrame) -> DataFrame:
    """An inventory with the folder of each file, written as the catalog writes it."""
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    return files.withColumn("folder", F.regexp_replace(folder, "^file:/+", "file:/"))


def plain_uri(location: str) -> str:
    """``file:///x`` and ``file:/x`` as one."""
    return re.sub("^file:/+", "file:/", location.rstrip("/"))


def active_files(table: LakeTable) -> DataFrame:
    """Files of the current content, those without rows included.

    A partition is published as a folder, so a folder is active as a whole.
    """
    return with_folder(file_inventory(table.spark, table.root)).join(active_folders(table), "folder", "left_semi").drop("folder")
