"""Batch files: names, typed export, landing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timewin import DEFAULT_ZONE, batch_date, previous_day_window
from tidemark.functions.types import conform
from tidemark.session import delete_path, micros_writer
from tidemark.sources.files import export_folder


def batch_name(table: str, run_end: datetime, is_initial: bool, *, label: str = "", zone: str = DEFAULT_ZONE) -> str:
    """``batch_<table>_full_load`` on the first load, else the day the batch covers.

    Tables that share a landing prefix stay apart by their names.
    """
    if is_initial:
        return f"batch_{table}_full_load"
    start, _ = previous_day_window(run_end, zone)
    return f"batch_{table}_{label}{start:%Y%m%d}"


def export_micros(df: DataFrame, path: str, schema: T.StructType | None = None, sort: tuple[str, ...] = ()) -> bool:
    """Write a batch with microsecond instants; an empty batch leaves no folder.

    Returns whether anything was written.  The folder is replaced, so exporting the
    same batch again leaves it once.
    """
    if schema is not None:
        df = conform(df, schema)
    if sort:
        df = df.sortWithinPartitions(*sort)
    # Rows are counted as they are written, so the source is asked once.
    written = Observation()
    with micros_writer(df.sparkSession):
        df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    if not written.get["rows"]:
        delete_path(df.sparkSession, path)
        return False
    return True


def export_dated(df: DataFrame, root: str, run_end: datetime, schema: T.StructType, zone: str = DEFAULT_ZONE) -> str | None:
    """Write a typed batch into the dated folder of the run; None if there was nothing to write."""
    folder = export_folder(root, batch_date(run_end, zone))
    return folder if export_micros(df, folder, schema) else None
