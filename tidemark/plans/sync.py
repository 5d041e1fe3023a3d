"""The ingest flows, each composed of the operators.

Every flow takes the times it depends on as arguments and can be run again for the
same run end: a batch keeps what it holds and takes what is new, exports replace their folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timewin import DEFAULT_ZONE, batch_date, lookback_cutoff, previous_day_window
from tidemark.model import ChangeTable
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.merge import MergeSpec, hard_delete_guarded, merge_table, soft_delete
from tidemark.sinks.files import batch_name, export_dated, export_micros
from tidemark.sources.extract import extract_for_load, extract_previous_day
from tidemark.sources.files import export_folder, scan_hive_repaired
from tidemark.sources.json_rows import json_to_rows, rows_to_json
from tidemark.streaming.ingest import batches_to_merge, ingest_batch, ingest_ephemeral, merged
from tidemark.tables import BATCH, LakeTable, by_range, create_table, open_table, table_exists


@dataclass(frozen=True)
class Load:
    """What a flow did: which kind of load, under which batch name, and whether it had rows."""

    is_initial: bool
    batch: str
    wrote: bool


def holds_no_rows(spark: SparkSession, name: str) -> bool:
    """Is this the first load?  A missing table counts as empty; any other failure is raised."""
    return not table_exists(spark, name) or open_table(spark, name).is_empty()


def merge_recent(history: LakeTable, serving: LakeTable, change: ChangeTable, spec: MergeSpec, now: datetime, *,
                 zone: str = DEFAULT_ZONE, days: int | None = 2, batches: tuple[str, ...] = ()) -> None:
    """Merge the newest version of each key changed within the look-back (None: the whole history).

    ``batches`` are merged whatever their change times.  The filter comes before the
    deduplication, so a key is represented by its newest row of those.
    """
    low = None if days is None else lookback_cutoff(now, zone, days)
    changes = history.range(change.version, low).select(*change.columns)
    if batches and days is not None:
        late = history.read().where(F.col(BATCH).isin(list(batches)))
        changes = changes.unionByName(late.select(*change.columns))
    merge_table(serving, latest_per_key(changes, change.key, change.version), spec, unique_source=True)


def sync_direct(source: DataFrame, history: LakeTable, serving: LakeTable, change: ChangeTable, run_end: datetime, *,
                now: datetime | None = None, zone: str = DEFAULT_ZONE, via_json: bool = False, closed: str = "left") -> Load:
    """Previous day's changes straight into the history, then a hard-delete merge.

    ``via_json`` sends the rows through bounded JSON arrays first, for a source that
    hands them over that way; the rows are the same.  The source is asked once: whether
    it had rows is what the append wrote.
    """
    start, _ = previous_day_window(run_end, zone)
    batch = f"{start:%Y%m%d}"
    rows = extract_previous_day(source.select(*change.columns), change.version, run_end, zone, closed)
    if via_json:
        fields = T.StructType([f for f in history.schema.fields if f.name in change.columns])
        rows = json_to_rows(rows_to_json(rows), "payload", fields)
    wrote = history.append_batch(rows, batch)
    merge_recent(history, serving, change, hard_delete_guarded(change), now or run_end, zone=zone)
    return Load(False, batch, wrote)


def export_load(source: DataFrame, landing: str, history_name: str, change: ChangeTable, run_end: datetime, *,
                zone: str = DEFAULT_ZONE, label: str = "incremental_", schema: T.StructType | None = None,
                closed: str = "left", batch_of: str | None = None) -> Load:
    """Export everything if the history is empty, else the previous day, as a batch named after ``batch_of`` (the history)."""
    is_initial = holds_no_rows(source.sparkSession, history_name)
    rows = source.select(*change.columns)
    if not is_initial:
        rows = extract_previous_day(rows, change.version, run_end, zone, closed)
    name = batch_name(batch_of or history_name.split(".")[-1], run_end, is_initial, label=label, zone=zone)
    wrote = export_micros(rows, f"{landing.rstrip('/')}/{name}", schema or change.schema)
    return Load(is_initial, name, wrote)


def sync_landing(source: DataFrame, landing: str, history: LakeTable, serving: LakeTable, change: ChangeTable,
                 run_end: datetime, *, now: datetime | None = None, zone: str = DEFAULT_ZONE,
                 days: int | None = 2, first_days: int | None = None, schema: T.StructType | None = None,
                 closed: str = "left", batch_of: str | None = None) -> Load:
    """Export to the landing folder, append and clear it, then a hard-delete merge.

    The merge takes the look-back and every batch that was appended and not merged yet,
    so what a failed run left behind is served however late.  A first load is served
    whole (``first_days`` limits it).
    """
    load = export_load(source, landing, history.name, change, run_end, zone=zone, label="", schema=schema, closed=closed, batch_of=batch_of)
    ingest_ephemeral(history, f"{landing.rstrip('/')}/*", schema or change.schema, label=load.batch, to_merge=True)
    waiting = batches_to_merge(history)
    merge_recent(history, serving, change, hard_delete_guarded(change), now or run_end, zone=zone,
                 days=first_days if load.is_initial else days, batches=tuple(waiting))
    merged(history, waiting)
    return load


def sync_dated(source: DataFrame, landing: str, history: LakeTable, serving: LakeTable, change: ChangeTable, *,
               change_day: date, run_end: datetime, zone: str = DEFAULT_ZONE, schema: T.StructType | None = None,
               spec: MergeSpec | None = None) -> Load:
    """The dated flow: typed export to the run's folder, append, soft-delete merge.

    Rows are chosen by ``change_day`` while the folder is named by the run's end;
    the two need not be the same day.  Folders are kept, but a run that finds no rows
    leaves none, and ingests none.
    """
    schema = schema or change.schema
    is_initial = serving.is_empty()
    rows = extract_for_load(source.select(*change.columns), change.version, is_initial, change_day)
    folder = export_dated(rows, landing, run_end, schema, zone)
    day = batch_date(run_end, zone)
    if folder is not None:
        ingest_batch(history, f"{export_folder(landing, day)}/*.parquet", day, schema)
    ends = (None, None) if is_initial else (change_day, change_day + timedelta(days=1))
    changes = history.range(change.version, *ends, closed="left").select(*change.columns)
    newest = latest_per_key(changes, change.key, change.version)
    merge_table(serving, newest, spec or soft_delete(change), unique_source=True)
    return Load(is_initial, day, folder is not None)


def migrate_hive(spark: SparkSession, raw: str, schema: T.StructType, partitions: dict[str, T.DataType], name: str,
                 root: str, bucket_on: str, start: int, stop: int, step: int = 1,
                 cluster_by: tuple[str, ...] = ()) -> LakeTable:
    """Hive folders into a managed table partitioned by an integer range of one column.

    If that column is one of the folders', the rows already lie by partition and are
    written by the tasks that read them; otherwise they are exchanged first.
    """
    rows = scan_hive_repaired(spark, raw, schema, partitions)
    bucket = f"{bucket_on}_bucket"
    table = create_table(spark, name, rows.schema, root, partition_by=(bucket,), cluster_by=cluster_by,
                         derived={bucket: by_range(bucket_on, start, stop, step)})
    if bucket_on in partitions:
        table.publish(table.shaped(rows), table.partitions())
    else:
        table.overwrite(rows)
    return table
