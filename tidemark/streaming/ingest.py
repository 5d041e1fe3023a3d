"""Ingest landed files: once each, as a batch or as an available-now stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timewin import naive_utc
from tidemark.model import ChangeTable
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.evolve import evolve_append_files
from tidemark.operators.merge import MergeSpec, merge_table
from tidemark.session import delete_path, list_glob, path_exists, touch
from tidemark.sources.files import scan_glob
from tidemark.tables import BATCH, LakeTable

REMOVALS = 8  # folders removed at a time; the calls wait on the store


def ingest_batch(table: LakeTable, pattern: str, batch_id: str, schema: T.StructType | None = None) -> bool:
    """Append the files under a pattern that identifies one batch, keeping the files.

    The batch id names the files' partition in the history, so ingesting a batch
    again adds what it does not hold yet and never doubles or removes a row.
    """
    if not path_exists(table.spark, pattern):
        return False
    table.append_batch(scan_glob(table.spark, pattern, schema), batch_id)
    return True


def ingest_ephemeral(table: LakeTable, pattern: str, schema: T.StructType | None = None, *,
                     label: str = "landing", to_merge: bool = False) -> list[str]:
    """Append the batch folders under a pattern, then remove exactly those; returns them.

    Only folders whose writer finished (``_SUCCESS``) are taken, and the driver handles
    folders, never files.  The list of a run's folders is stored before anything else.
    If a run fails, the next one finds the list and finishes that batch first: it
    appends the folders again under the same batch id unless that was done, and
    removes them.  A folder that lands meanwhile is the next run's; a writer must not
    replace one that has landed.  Runs must not overlap.

    ``to_merge`` notes appended batches until :func:`merged` is called for them.
    """
    spark = table.spark
    pending = [p.rsplit("/", 2)[-2] for p in list_glob(spark, f"{table.root}/_batches/*/_SUCCESS")]
    taken = [f for batch_id in pending for f in _finish(table, batch_id, schema, to_merge)]
    folders = [p.rsplit("/", 1)[0] for p in list_glob(spark, f"{pattern.rstrip('/')}/_SUCCESS")]
    if folders:
        batch_id = f"{label}-{uuid.uuid4().hex}"
        spark.createDataFrame([(f,) for f in folders], "path string").coalesce(1).write.parquet(_listing(table, batch_id))
        taken += _finish(table, batch_id, schema, to_merge)
    return taken


def _listing(table: LakeTable, batch_id: str) -> str:
    return f"{table.root}/_batches/{batch_id}"


def _finish(table: LakeTable, batch_id: str, schema: T.StructType | None, to_merge: bool) -> list[str]:
    spark, listing = table.spark, _listing(table, batch_id)
    folders = [r["path"] for r in spark.read.schema("path string").parquet(listing).collect()]
    appended = f"{listing}/_appended"
    if not path_exists(spark, appended):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        table.append_batch(reader.parquet(*folders), batch_id)
        touch(spark, appended)
    if to_merge:
        touch(spark, f"{table.root}/_to_merge/{batch_id}")
    with ThreadPoolExecutor(REMOVALS) as removals:
        list(removals.map(lambda folder: delete_path(spark, folder), folders))
    delete_path(spark, listing)
    return folders


def batches_to_merge(table: LakeTable) -> list[str]:
    """Batches that were appended and not merged yet."""
    return sorted(p.rsplit("/", 1)[1] for p in list_glob(table.spark, f"{table.root}/_to_merge/*"))


def merged(table: LakeTable, batches: list[str]) -> None:
    for batch_id in batches:
        delete_path(table.spark, f"{table.root}/_to_merge/{batch_id}")


def stream_files(spark: SparkSession, pattern: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Landed files as a stream; the checkpoint remembers which paths were taken.

    A file rewritten under its old name is not read again: re-export a day with
    :func:`ingest_batch` or under a new name.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(pattern)


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def _batch_name(prefix: str, number: int) -> str:
    return f"{prefix}{number:012d}"


def ingest_stream(table: LakeTable, pattern: str, schema: T.StructType, checkpoint: str, *,
                  prefix: str = "stream-", max_files: int | None = None) -> StreamingQuery:
    """Append every file that landed since the last run, once.

    A micro-batch that is replayed after a failure has the same number and so
    finds its rows in their partition.
    """
    def append(batch: DataFrame, number: int) -> None:
        table.append_batch(batch, _batch_name(prefix, number))

    return _run(stream_files(table.spark, pattern, schema, max_files), checkpoint, append)


def evolve_stream(table: LakeTable, pattern: str, checkpoint: str, *, prefix: str = "stream-", max_files: int = 1000,
                  then: Callable[[LakeTable, str], None] | None = None) -> StreamingQuery:
    """:func:`ingest_stream` for files whose columns change: each micro-batch widens the table before it is appended.

    The stream carries paths, so no schema is fixed when it starts; rows are read once, with the schema that the
    micro-batch's own footers have led to.  A replayed micro-batch has the same files under the same number: it adds no
    column and no row twice.  A new column of a type that no table column can take stops the stream before
    anything of that micro-batch is loaded.  ``then(table, batch_id)`` runs after each append, for a merge of that batch.
    """
    files = (
        table.spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", max_files).option("pathGlobFilter", "*.parquet").load(pattern).select("path"))

    def step(batch: DataFrame, number: int) -> None:
        name = _batch_name(prefix, number)
        evolve_append_files(table, batch, name)
        if then is not None:
            then(table, name)

    return _run(files, checkpoint, step)


def newest_with_batch(history: LakeTable, change: ChangeTable, batch_id: str) -> DataFrame | None:
    """The newest row, over the whole history, of every key in one of its batches; None for an empty batch.

    Only rows as new as the batch's oldest one can be newer than its rows, so older folders of
    the history are not read: a batch that comes in order reads little more than itself, a late one
    reads from its own time on.  The history is the state, and it ages out by its partitions.
    """
    rows = history.read().where(F.col(BATCH) == batch_id)
    dtype = rows.schema[change.version].dataType
    least = F.min(change.version)
    if isinstance(dtype, T.TimestampType):
        least = naive_utc(least)
    if not isinstance(dtype, T.NumericType):
        least = least.cast("string")
    found = rows.agg(least.alias("least"), F.count(change.version).alias("dated"), F.count(F.lit(1)).alias("rows")).collect()[0]
    if not found["rows"]:
        return None
    # A NULL version is oldest: any row of its key is newer.
    low = found["least"] if found["dated"] == found["rows"] else None
    since = history.range(change.version, low).select(*change.columns).alias("h")
    keys = rows.select(*change.key).distinct().alias("b")
    same = reduce(lambda a, b: a & b, [F.col(f"h.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in change.key])
    return latest_per_key(since.join(keys, same, "left_semi"), change.key, change.version)


def merge_stream(history: LakeTable, serving: LakeTable, change: ChangeTable, spec: MergeSpec, pattern: str,
                 schema: T.StructType, checkpoint: str, *, prefix: str = "stream-",
                 max_files: int | None = None) -> StreamingQuery:
    """Append each micro-batch to the history and then merge the newest rows of its keys into the serving table.

    Newest means of all that has come so far, so files may come in any order, one that is older than
    what was merged changes nothing, and a replayed micro-batch merges the same rows again.  A key whose
    tombstone came first stays deleted.  Partition the history by the change time to have
    late batches read only what lies after them.  Every micro-batch is a partition of the history:
    choose the trigger and ``max_files`` so that there are few, or gather old ones with
    ``history.append_batch(rows of several batches, name)`` and ``drop_partitions``.
    """
    def step(batch: DataFrame, number: int) -> None:
        name = _batch_name(prefix, number)
        history.append_batch(batch, name)
        newest = newest_with_batch(history, change, name)
        if newest is not None:
            merge_table(serving, newest, spec, unique_source=True)

    return _run(stream_files(history.spark, pattern, schema, max_files), checkpoint, step)
