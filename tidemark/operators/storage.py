"""Storage audit: what lies in a table's folder and what of it is still read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import version_number
from tidemark.sources.files import active_folders, file_inventory, with_folder
from tidemark.tables import LakeTable


def footprint(files: DataFrame) -> DataFrame:
    """File count and total bytes of an inventory."""
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def retained_files(table: LakeTable) -> DataFrame:
    """Files on storage that the table no longer reads, kept only for time travel."""
    files = with_folder(file_inventory(table.spark, table.root))
    return files.join(active_folders(table), "folder", "left_anti").drop("folder")


def storage_report(table: LakeTable) -> DataFrame:
    """Active and retained files and bytes side by side with the row count."""
    present = with_folder(file_inventory(table.spark, table.root))
    active = active_folders(table).withColumn("active", F.lit(True))
    marked = present.join(active, "folder", "left_outer").withColumn("active", F.coalesce("active", F.lit(False)))
    kept = F.col("active")
    sizes = marked.agg(
        F.count_if(kept).alias("active_files"),
        F.coalesce(F.sum(F.when(kept, F.col("length"))), F.lit(0)).alias("active_bytes"),
        F.count_if(~kept).alias("retained_files"),
        F.coalesce(F.sum(F.when(~kept, F.col("length"))), F.lit(0)).alias("retained_bytes"),
    )
    rows = table.read().agg(F.count(F.lit(1)).alias("rows"))
    # Both sides are single-row aggregates.
    return sizes.join(rows, F.lit(True))


def latest_version(files: DataFrame, group: list[str], name: str) -> DataFrame:
    """The metadata file with the highest version number in each group."""
    numbered = files.withColumn("version", version_number(F.col(name)))
    return numbered.groupBy(*group).agg(
        F.max_by(name, F.struct("version", name)).alias(name), F.max("version").alias("version")
    )
