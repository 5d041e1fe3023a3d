"""Schemas of Parquet files, read from their footers on the executors."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlencode, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.types import sql_type_name
from tidemark.sources.files import BELOW

FOOTER_SCHEMA = "path string, position int, name string, incoming_type string, table_type string"


# Schemes of Hadoop's connectors under the names the footer library knows.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasbs": "abfss", "wasb": "abfs"}


def store_of(path: str, options: dict[str, str]) -> tuple[str, str]:
    """URI of the store a file lies in, with options as its query, and the file's path below it.

    ``file:/…`` has no host part; every other store is its scheme and host.
    """
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return "file:///", unquote(parts.path) if parts.scheme else path
    query = f"?{urlencode(options)}" if options else ""
    return f"{SCHEMES.get(parts.scheme, parts.scheme)}://{parts.netloc}/{query}", unquote(parts.path)


class _Stores:
    """File systems by store, each opened once per task."""

    def __init__(self, options: dict[str, str]):
        self.options, self.open = options, {}

    def find(self, path: str):
        import pyarrow.fs as pafs

        store, inner = store_of(path, self.options)
        if store not in self.open:
            self.open[store] = (pafs.LocalFileSystem(), "") if store == "file:///" else pafs.FileSystem.from_uri(store)
        filesystem, base = self.open[store]
        return filesystem, base.rstrip("/") + inner


def _table_type(arrow_type) -> str | None:
    from pyspark.errors import PySparkException
    from pyspark.sql.pandas.types import from_arrow_type

    try:
        return sql_type_name(from_arrow_type(arrow_type))
    except (ValueError, PySparkException):
        return None


def read_footers(batches: Iterator[pd.DataFrame], options: dict[str, str] | None = None) -> Iterator[pd.DataFrame]:
    """One row per field of each file.  ``table_type`` is NULL for a type no table column can take."""
    import pyarrow.parquet as pq

    stores = _Stores(options or {})
    for batch in batches:
        rows = []
        for path in batch["path"]:
            filesystem, inner = stores.find(path)
            for position, field in enumerate(pq.read_schema(inner, filesystem=filesystem)):
                rows.append((path, position, field.name, str(field.type), _table_type(field.type)))
        yield pd.DataFrame(rows, columns=["path", "position", "name", "incoming_type", "table_type"])


def file_fields(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """Fields of every Parquet file below ``root``: only footers are read, never rows.

    Executors open the store themselves; ``options`` such as ``region``, ``endpoint_override``
    or ``access_key`` are what its URI takes, and without them they use their own credentials.

    ``mergeSchema`` cannot do this: it fails where two files give a column different
    types, and here the first file's type is wanted.
    """
    return fields_of(spark.read.format("binaryFile").options(**BELOW).load(root).select("path"), **options)


def fields_of(files: DataFrame, **options: str) -> DataFrame:
    """:func:`file_fields` of listed files (``path``)."""
    # Files are packed into scan tasks by size; spread them by count, as a footer costs the same in each.
    return files.repartition("path").mapInPandas(lambda batches: read_footers(batches, options), FOOTER_SCHEMA)


def schema_union(fields: DataFrame) -> DataFrame:
    """One row per column name: the type in the first file that has it, and whether others disagree."""
    order = F.struct("path", "position")
    return fields.groupBy("name").agg(
        F.min_by("incoming_type", order).alias("incoming_type"),
        F.min_by("table_type", order).alias("table_type"),
        F.min(order).alias("seen_first"),
        F.count(F.lit(1)).alias("files"),
        (F.size(F.collect_set("incoming_type")) > 1).alias("conflict"),
    )
