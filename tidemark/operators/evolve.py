"""Schema drift: find new columns in landed files and widen the table before loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import scan_below
from tidemark.sources.footers import fields_of, file_fields, schema_union
from tidemark.tables import BATCH, LakeTable


def schema_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A declared schema as rows (name, current_type)."""
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in schema.fields], "name string, current_type string"
    )


def schema_diff(union: DataFrame, table_schema: T.StructType) -> DataFrame:
    """Every column of the files or the table, with its status.

    ``new``: to be added; ``unsupported``: new, but no table type fits it; ``known``:
    in both; ``absent``: in the table only, read as NULL and never dropped.  Names
    are compared without regard to case, as the catalog does.
    """
    table = schema_frame(union.sparkSession, table_schema).alias("h")
    incoming = union.alias("f")
    joined = incoming.join(table, F.lower("f.name") == F.lower("h.name"), "full_outer")
    return joined.select(
        F.coalesce("h.name", "f.name").alias("name"),
        F.col("f.incoming_type"), F.col("f.table_type"), F.col("h.current_type"), F.col("f.seen_first"),
        F.when(F.col("f.name").isNull(), "absent").when(F.col("h.name").isNotNull(), "known")
        .when(F.col("f.table_type").isNull(), "unsupported").otherwise("new").alias("status"),
    )


def new_columns(union: DataFrame, table_schema: T.StructType) -> DataFrame:
    """Incoming columns the table does not have (an anti join on the name)."""
    table = schema_frame(union.sparkSession, table_schema).select(F.lower("name").alias("known"))
    return union.join(table, F.lower(union["name"]) == table["known"], "left_anti")


def missing_fields(union: DataFrame, table_schema: T.StructType) -> list[T.StructField]:
    """Fields to add, in the order they were first seen; as many as there are new columns."""
    rows = new_columns(union, table_schema).orderBy("seen_first").collect()
    refused = [f"{r['name']} ({r['incoming_type']})" for r in rows if r["table_type"] is None]
    if refused:
        raise ValueError("unsupported type for a new column: " + ", ".join(refused))
    return [T.StructField(r["name"], T.DataType.fromDDL(r["table_type"])) for r in rows]


def evolve_table(table: LakeTable, landing: str) -> list[T.StructField]:
    """Add the columns landed files have and the table lacks; a second run adds none."""
    union = schema_union(file_fields(table.spark, landing))
    return table.add_columns(missing_fields(union, table.schema))


def file_columns(table: LakeTable) -> T.StructType:
    """The table's columns that come from files: all but the batch and the derived ones."""
    computed = {BATCH, *(n for n, _ in table.derived)}
    return T.StructType([f for f in table.schema.fields if f.name not in computed])


def evolve_append_files(table: LakeTable, files: DataFrame, batch_id: str) -> list[T.StructField]:
    """Widen the table by what some files (``path``) hold, then append their rows as one batch.

    The driver holds the paths of one batch, as Spark's reader takes them.
    """
    paths = [r["path"] for r in files.select("path").collect()]
    if not paths:
        return []
    added = table.add_columns(missing_fields(schema_union(fields_of(files)), table.schema))
    table.append_batch(table.spark.read.schema(file_columns(table)).parquet(*paths), batch_id)
    return added


def evolve_append(table: LakeTable, landing: str, batch_id: str) -> list[T.StructField]:
    """Widen the table, then append the landed files with the widened schema.

    Files are read with the table's columns, so one without a column gives NULL.  Both
    steps look at the same files: all below ``landing``, however deep.
    """
    added = evolve_table(table, landing)
    table.append_batch(scan_below(table.spark, landing, file_columns(table)), batch_id)
    return added
