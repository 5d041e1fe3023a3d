"""Ingest, streams, schema drift, storage audit and the composed flows: checked queries."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checks.changes import HARD_SQL, SOFT_SQL
from tidemark.checks.fixtures import (
    CHANGES_SQL, HIST_SQL, MERGE_SQL, RUNS, SRC_SQL, TAXI_FOLDERS, TAXI_SCHEMA, TAXI_SQL, TX, TX_SCHEMA, TXSRC_SQL, USER, USER_SCHEMA, USERS_SQL,
    civil, days, folder, history_table, hive_folders, hours, landed_by_run, monthly_table, new_table, table, taxi, tx_changes, tx_history, tx_source,
    tx_target, users,
)
from tidemark.checks.registry import query
from tidemark.functions.timewin import batch_date, naive_utc
from tidemark.model import TRANSAKSI, ChangeTable
from tidemark.operators.dml import delete_table, update_table
from tidemark.operators.evolve import evolve_append, schema_diff
from tidemark.operators.history import as_of
from tidemark.operators.merge import hard_delete_guarded, soft_delete
from tidemark.operators.storage import footprint, retained_files, storage_report
from tidemark.plans.sync import (
    export_load, merge_recent, migrate_hive, sync_dated, sync_direct, sync_landing,
)
from tidemark.session import path_exists, stored
from tidemark.sinks.files import export_dated, export_micros
from tidemark.sources.files import active_files, export_folder, file_inventory, scan_dated, scan_glob
from tidemark.sources.footers import file_fields, schema_union
from tidemark.sources.json_rows import json_to_rows, rows_to_json
from tidemark.streaming.ingest import evolve_stream, ingest_batch, ingest_ephemeral, ingest_stream, merge_stream
from tidemark.tables import BATCH, LakeTable, by_day, by_year

# Ends on 2026-08-16 00:00 in Jakarta, so the previous local day is the 15th.
USERS_RUN = datetime(2026, 8, 15, 17, tzinfo=UTC)

# --- tables ---------------------------------------------------------------------------


@query("select * from orders")
def ctas_copy(spark: SparkSession, sf: str) -> DataFrame:
    """CREATE OR REPLACE … AS SELECT: the second content replaces the first."""
    orders = table(spark, sf, "orders")
    copy = new_table(spark, "copy", orders.schema)
    copy.overwrite(orders.where("o_orderstatus = 'F'"))
    copy.overwrite(orders)
    return copy.read()


@query(f"with {HIST_SQL}\nselect k, amt, st, d, c_at, u_at, del, cast(date_trunc('year', c_at) as date) made from hist")
def clustered_write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Partitioned by a date derived from an instant, sorted by two cluster columns."""
    clustered = new_table(spark, "clustered", TX_SCHEMA, ("made",), ("k", "st"), {"made": by_year("c_at")})
    clustered.overwrite(tx_history(spark, sf))
    return clustered.read()


@query(f"""with {TXSRC_SQL} select *, cast(date_trunc('month', d) as date) m from txsrc
where d >= date '1997-11-20' and d <= date '1998-02-03'""")
def hidden_partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A filter on the date prunes the month folders that follow from it."""
    serving = monthly_table(spark, "hidden")
    serving.overwrite(tx_source(spark, sf))
    return serving.range("d", "1997-11-20", "1998-02-03")


# --- ingest ---------------------------------------------------------------------------


@query("""select *, case when ts < timestamp '2024-01-10 00:00:00' then '20240110'
when ts < timestamp '2024-01-20 00:00:00' then '20240120' else '20240131' end as batch_id from events""")
def ingest_immutable_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Each run reads its own folder, all folders stay; the first is ingested twice and counts once."""
    landing, schema = landed_by_run(spark, sf)
    history = history_table(spark, "events", schema)
    days = [batch_date(run.run_end) for run in RUNS]
    for day in (*days, days[0]):
        ingest_batch(history, f"{export_folder(landing, day)}/*.parquet", day, schema)
    return history.read()


@query("select *, cast(0 as bigint) as files_left from events", name="ingest_ephemeral")
def ingest_ephemeral_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Consumed files are removed, so the static wildcard brings every row once."""
    events = table(spark, sf, "events")
    landing = folder(spark, "landing")
    history = history_table(spark, "events", events.schema)
    for name, part in (("clicks", "event_type = 'click'"), ("others", "event_type <> 'click'")):
        export_micros(events.where(part), f"{landing}/{name}")
        ingest_ephemeral(history, f"{landing}/*", events.schema)
    left = footprint(file_inventory(spark, landing)).select(F.col("files").alias("files_left"))
    return history.read().drop(BATCH).join(F.broadcast(left), F.lit(True))


@query("select event_id, ts, user_id, event_type, value, props from events")
def ingest_stream_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """A run takes the files that are new since the last; a run without new files adds nothing."""
    events = table(spark, sf, "events")
    landing, checkpoint = folder(spark, "landing"), folder(spark, "checkpoint")
    history = history_table(spark, "events", events.schema)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for name, part in (("export_1", early), ("export_2", ~early)):
        export_micros(events.where(part), f"{landing}/{name}")
        ingest_stream(history, f"{landing}/export_*", events.schema, checkpoint)
    ingest_stream(history, f"{landing}/export_*", events.schema, checkpoint)
    return history.read().drop(BATCH)


@query(MERGE_SQL + SOFT_SQL)
def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Every micro-batch is appended and then merged into the serving table."""
    changes = tx_changes(spark, sf)
    landing, checkpoint = folder(spark, "landing"), folder(spark, "checkpoint")
    history = history_table(spark, "tx", TX_SCHEMA, "u_at")
    serving = monthly_table(spark, "serving")
    serving.overwrite(tx_target(spark, sf))
    for version in (1, 2):
        batch = changes.where(F.col("u_at") == F.col("c_at") + days(F.lit(version)))
        export_micros(batch, f"{landing}/export_{version}")
        merge_stream(history, serving, TX, soft_delete(TX), f"{landing}/export_*", TX_SCHEMA, checkpoint)
    return serving.read().drop("m")


@query(f"""with {TXSRC_SQL},
moved as (select k, amt + 500 amt, st, d, c_at, timestamp '2002-01-05 00:00:00' + (cast(k as bigint) % 24) * interval '1' hour u_at, del from txsrc where cast(k as bigint) % 3 = 0),
versions as (select *, 1 as run from txsrc union all select *, 3 as run from moved),
evening as (select k, count(*) n from txsrc where u_at <= timestamp '1997-06-30 18:00:00' and del is null group by k)
select v.*, cast(coalesce(n, 0) as bigint) as held_before, cast(coalesce(n, 0) as bigint) as held_after from versions v left join
(select e.k, n, u_at from evening e join txsrc using (k)) h on v.k = h.k and v.u_at = h.u_at""")
def append_rerun_keeps_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A batch is run four times: whole, when a third of its rows have moved on, when nothing is found, and with the moved rows.

    ``held_before`` and ``held_after`` say whether a version was the live one on an evening, as of the first run and as of the last.
    """
    first = tx_source(spark, sf).withColumn("run", F.lit(1))
    there = F.col("k").cast("long") % 3 == 0
    moved = first.where(there).withColumns({"amt": F.col("amt") + 500, "run": F.lit(3),
                                       "u_at": civil("2002-01-05 00:00:00") + hours(F.col("k").cast("long") % 24)})
    history = history_table(spark, "tx", T.StructType([*TX_SCHEMA.fields, T.StructField("run", T.IntegerType())]), "u_at")
    evening = lambda: as_of(history.read().where("u_at <= timestamp_ntz'1997-06-30 18:00:00'"), TX, "1997-06-30 18:00:00").select("k", "u_at")
    history.append_batch(first, "day")
    before = stored(evening())
    for rerun in (first.where(~there), first.limit(0), moved, first):
        history.append_batch(rerun, "day")
    marked = history.read().drop(BATCH, "changed")
    for name, held in (("held_before", before), ("held_after", evening())):
        marked = marked.join(held.withColumn(name, F.lit(1).cast("long")), ["k", "u_at"], "left").fillna(0, [name])
    return marked


LATE_SQL = f"""with {CHANGES_SQL}, {SRC_SQL},
before as (select cast(o_orderkey as varchar) k, o_totalprice amt, o_orderstatus st, cast(o_orderdate as date) d, o_orderdate c_at, o_orderdate u_at,
                  case when false then o_orderdate end del from orders where o_orderstatus <> 'P')
select coalesce(s.k, t.k) k, coalesce(s.amt, t.amt) amt, coalesce(s.st, t.st) st, coalesce(s.d, t.d) d, coalesce(t.c_at, s.c_at) c_at,
       coalesce(s.u_at, t.u_at) u_at, s.del from before t full join src s on t.k = s.k where s.k is null or s.del is null"""


@query(LATE_SQL)
def stream_merge_late_file(spark: SparkSession, sf: str) -> DataFrame:
    """The second folder is older than the first, in which some rows are deleted: newest rows and deletions hold."""
    changes = tx_changes(spark, sf)
    landing, checkpoint = folder(spark, "landing"), folder(spark, "checkpoint")
    history = history_table(spark, "tx", TX_SCHEMA, "u_at")
    serving = monthly_table(spark, "serving")
    serving.overwrite(tx_target(spark, sf))
    for version in (2, 1):
        batch = changes.where(F.col("u_at") == F.col("c_at") + days(F.lit(version)))
        export_micros(batch, f"{landing}/export_{version}")
        merge_stream(history, serving, TX, hard_delete_guarded(TX), f"{landing}/export_*", TX_SCHEMA, checkpoint)
    return serving.read().drop("m")


# --- full or incremental load ---------------------------------------------------------


@query(f"with {USERS_SQL} select *, 'batch_users_full_load' as batch from users")
def load_cold_start(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing in the history yet: everything is exported."""
    landing = folder(spark, "export")
    history = history_table(spark, "users", USER_SCHEMA, "updated_at")
    load = export_load(users(spark, sf), landing, history.name, USER, USERS_RUN, batch_of="users")
    return scan_glob(spark, f"{landing}/{load.batch}/*.parquet", USER_SCHEMA).withColumn("batch", F.lit(load.batch))


@query(f"""with {USERS_SQL} select *, 'batch_users_incremental_20260815' as batch from users
where updated_at >= timestamp '2026-08-15 00:00:00' and updated_at < timestamp '2026-08-16 00:00:00'""")
def load_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The history has rows: only the previous day is exported."""
    landing = folder(spark, "export")
    history = history_table(spark, "users", USER_SCHEMA, "updated_at")
    history.append_batch(users(spark, sf).where("updated_at < timestamp_ntz'2026-08-15 00:00:00'"), "first")
    load = export_load(users(spark, sf), landing, history.name, USER, USERS_RUN, batch_of="users")
    return scan_glob(spark, f"{landing}/{load.batch}/*.parquet", USER_SCHEMA).withColumn("batch", F.lit(load.batch))


@query(f"with {USERS_SQL} select count(*) as rows_kept, false as wrote from users")
def load_empty_batch(spark: SparkSession, sf: str) -> DataFrame:
    """No change on the day: nothing is written, the history stays as it is."""
    landing = folder(spark, "export")
    history = history_table(spark, "users", USER_SCHEMA, "updated_at")
    history.append_batch(users(spark, sf), "first")
    load = export_load(users(spark, sf), landing, history.name, USER, datetime(2027, 1, 1, tzinfo=UTC))
    return history.read().agg(F.count(F.lit(1)).alias("rows_kept")).withColumn("wrote", F.lit(load.wrote))


# --- schema drift ---------------------------------------------------------------------

ORDERS_BASE = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()), T.StructField("status", T.StringType()),
])


# Columns of landed orders: those of the first batches, and those that came later.
EARLY = {"order_id": "o_orderkey", "customer_id": "o_custkey", "status": "o_orderstatus"}
LATER = {"order_date": "cast(o_orderdate as date)", "created_at": "o_orderdate", "item_count": "cast(o_orderkey % 9 as int)"}
LAST = {"priority": "o_orderpriority", "total": "o_totalprice"}


def _landed(rows: DataFrame, columns: dict[str, str], path: str) -> None:
    export_micros(rows.select(*[F.expr(e).alias(n) for n, e in columns.items()]), path)


def _drifted(spark: SparkSession, sf: str, second: str = "o_orderstatus <> 'F'") -> tuple[str, DataFrame]:
    """Two landed batches, the second with three more columns; the target knows the first's."""
    o = table(spark, sf, "orders")
    landing = folder(spark, "drift")
    _landed(o.where("o_orderstatus = 'F'"), EARLY, f"{landing}/batch_1")
    _landed(o.where(second), EARLY | LATER, f"{landing}/batch_2")
    return landing, o


def _conflicting(spark: SparkSession, sf: str) -> str:
    """The drifted batches and a third, in which the status is a number and a nested column comes along."""
    landing, o = _drifted(spark, sf)
    nested = F.struct(F.col("o_orderkey").alias("key")).alias("detail")
    export_micros(o.select(F.col("o_orderkey").alias("order_id"), F.length("o_orderstatus").alias("status"), nested), f"{landing}/batch_3")
    return landing


@query("""select * from (values ('order_id', 'bigint', false), ('customer_id', 'bigint', false), ('status', 'string', true),
('order_date', 'date', false), ('created_at', 'timestamp', false), ('item_count', 'bigint', false), ('detail', cast(null as varchar), false))
v(name, table_type, conflict) where (select count(*) from orders) > 0""", name="schema_union")
def schema_union_files(spark: SparkSession, sf: str) -> DataFrame:
    """The first file's type of each column, and which columns come in several."""
    landing = _conflicting(spark, sf)
    return schema_union(file_fields(spark, landing)).select("name", "table_type", "conflict")


@query("""select * from (values ('order_id', 'bigint', 'known'), ('customer_id', 'bigint', 'known'),
('status', 'string', 'known'), ('note', cast(null as varchar), 'absent'), ('order_date', 'date', 'new'), ('created_at', 'timestamp', 'new'),
('item_count', 'bigint', 'new'), ('detail', cast(null as varchar), 'unsupported')) v(name, table_type, status) where (select count(*) from orders) > 0""", name="schema_diff")
def schema_diff_files(spark: SparkSession, sf: str) -> DataFrame:
    landing = _conflicting(spark, sf)
    declared = T.StructType([*ORDERS_BASE.fields, T.StructField("note", T.StringType())])
    return schema_diff(schema_union(file_fields(spark, landing)), declared).select("name", "table_type", "status")


EVOLVED_SQL = """select o_orderkey order_id, o_custkey customer_id, o_orderstatus status,
case when o_orderstatus <> 'F' then cast(o_orderdate as date) end order_date,
case when o_orderstatus <> 'F' then strftime(o_orderdate, '%Y-%m-%d') end created_day,
case when o_orderstatus <> 'F' then o_orderkey % 9 end item_count from orders"""


def _evolved_rows(df: DataFrame, *more: str) -> DataFrame:
    day = naive_utc(F.col("created_at")).cast("date").cast("string")
    return df.select("order_id", "customer_id", "status", "order_date", day.alias("created_day"), "item_count", *more)


@query(EVOLVED_SQL, name="evolve_append")
def evolve_and_append(spark: SparkSession, sf: str) -> DataFrame:
    """The table gets the new columns first; batches without them read NULL.  A rerun adds none."""
    landing, _ = _drifted(spark, sf)
    target = history_table(spark, "orders", ORDERS_BASE)
    for batch in ("batch_1", "batch_2", "batch_2"):
        evolve_append(target, f"{landing}/{batch}", batch)
    return _evolved_rows(target.read())


@query(EVOLVED_SQL)
def sync_evolving_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Both batches at once: one schema for files that differ."""
    landing, _ = _drifted(spark, sf)
    target = history_table(spark, "orders", ORDERS_BASE)
    evolve_append(target, f"{landing}/*/*.parquet", "both")
    return _evolved_rows(target.read())


@query(EVOLVED_SQL)
def evolve_nested_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The landing folder itself: drift and rows come from the same files, however deep they lie."""
    landing, _ = _drifted(spark, sf)
    target = history_table(spark, "orders", ORDERS_BASE)
    evolve_append(target, landing, "both")
    return _evolved_rows(target.read())


@query(EVOLVED_SQL.replace(" from orders", """,
case when o_orderstatus = 'P' then o_orderpriority end priority, case when o_orderstatus = 'P' then o_totalprice end total from orders"""))
def stream_evolving_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Three folders land between the runs of one stream, each with columns the one before did not have; the last run finds nothing."""
    landing, orders = _drifted(spark, sf, second="o_orderstatus = 'O'")
    checkpoint, target = folder(spark, "checkpoint"), history_table(spark, "orders", ORDERS_BASE)
    for run in (1, 2, 3, 3):
        if run == 3 and not path_exists(spark, f"{landing}/batch_3"):
            _landed(orders.where("o_orderstatus = 'P'"), EARLY | LATER | LAST, f"{landing}/batch_3")
        evolve_stream(target, f"{landing}/batch_[1-{run}]", checkpoint)
    return _evolved_rows(target.read(), *LAST)


# --- storage --------------------------------------------------------------------------

CHANGED = "m >= DATE'1998-01-01' AND m < DATE'1999-01-01' AND st = 'F'"


@query(f"""with {TXSRC_SQL} select cast(date_trunc('month', d) as date) m, count(*) as rows_held, count(distinct st) as statuses
from txsrc where d >= date '1998-01-01' and d < date '1999-01-01' group by 1""", name="retained_files")
def retained_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What the files left behind by a delete still hold: the old content of its partitions."""
    serving = monthly_table(spark, "audit")
    serving.overwrite(tx_source(spark, sf))
    delete_table(serving, CHANGED)
    stored = spark.read.schema(TX_SCHEMA).option("recursiveFileLookup", True).parquet(serving.root)
    held = stored.withColumn("path", F.col("_metadata.file_path")).join(retained_files(serving), "path", "left_semi")
    return held.groupBy(F.trunc("d", "month").alias("m")).agg(
        F.count(F.lit(1)).alias("rows_held"), F.countDistinct("st").alias("statuses"))


@query(f"""with {TXSRC_SQL} select count(*) filter (not (d >= date '1998-01-01' and d < date '1999-01-01' and st = 'F')) as rows,
count(*) filter (d >= date '1998-01-01' and d < date '1999-01-01') as rows_retained, true as bytes_grew, true as all_counted from txsrc""")
def storage_after_delete(spark: SparkSession, sf: str) -> DataFrame:
    """A delete lowers the row count while the bytes on storage grow until files are cleaned up."""
    serving = monthly_table(spark, "audit")
    serving.overwrite(tx_source(spark, sf))
    before = footprint(file_inventory(spark, serving.root)).select(F.col("bytes").alias("bytes_before"))
    # One row, read now: the frame would otherwise be computed after the delete.
    before = spark.createDataFrame(before.collect(), before.schema)
    delete_table(serving, CHANGED)
    report, present = storage_report(serving), footprint(file_inventory(spark, serving.root))
    rows_retained = _rows_in(serving, retained_files(serving)).agg(F.count(F.lit(1)).alias("rows_retained"))
    joined = report.join(before, F.lit(True)).join(present, F.lit(True)).join(rows_retained, F.lit(True))
    return joined.select(
        "rows", "rows_retained", (F.col("bytes") > F.col("bytes_before")).alias("bytes_grew"),
        (F.col("active_bytes") + F.col("retained_bytes") == F.col("bytes")).alias("all_counted"))


def _rows_in(table: LakeTable, files: DataFrame) -> DataFrame:
    """The rows that the given files of a table's folder hold, with the partition folder each lies in."""
    stored = table.spark.read.schema(TX_SCHEMA).options(recursiveFileLookup="true").parquet(table.root)
    return stored.withColumn("path", F.col("_metadata.file_path")).join(files.select("path"), "path", "left_semi")


@query("select count(*) as rows_active, 0 as rows_read, count(*) as rows_retained, true as live_files from orders")
def active_files_emptied(spark: SparkSession, sf: str) -> DataFrame:
    """After deleting everything the table's own file, without rows, is still active; only the replaced ones are not."""
    serving = new_table(spark, "emptied", TX_SCHEMA)
    serving.overwrite(tx_source(spark, sf))
    before = _rows_in(serving, active_files(serving)).count()
    delete_table(serving, "true")
    live = footprint(active_files(serving)).select((F.col("files") > 0).alias("live_files"))
    retained = _rows_in(serving, retained_files(serving)).agg(F.count(F.lit(1)).alias("rows_retained"))
    now = serving.read().agg(F.count(F.lit(1)).cast("int").alias("rows_read"))
    return now.join(retained, F.lit(True)).join(live, F.lit(True)).withColumn("rows_active", F.lit(before).cast("bigint"))


@query("select o_orderstatus as x, count(*) as n from orders group by 1")
def active_file_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Partitions the current files belong to, with the rows of those files: replaced ones are not among them."""
    orders = table(spark, sf, "orders")
    copy = new_table(spark, "active", orders.schema, ("o_orderstatus",))
    copy.overwrite(orders)
    copy.overwrite(orders)
    status = F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1)
    stored = spark.read.options(recursiveFileLookup="true").parquet(copy.root).withColumn("path", F.col("_metadata.file_path"))
    return stored.join(active_files(copy), "path", "left_semi").groupBy(status.alias("x")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {TXSRC_SQL} select cast(date_trunc('month', d) as date) m, 1::bigint as folders, count(*) as rows_held
from txsrc group by 1""")
def storage_footprint(spark: SparkSession, sf: str) -> DataFrame:
    """Folders of each month in a table's inventory, and the rows of the listed files."""
    serving = monthly_table(spark, "footprint")
    serving.overwrite(tx_source(spark, sf))
    rows = _rows_in(serving, file_inventory(spark, serving.root))
    month, place = F.regexp_extract("path", "/m=([^/]+)/", 1).cast("date"), F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    return rows.groupBy(month.alias("m")).agg(F.countDistinct(place).alias("folders"), F.count(F.lit(1)).alias("rows_held"))


@query("""select cast(o_orderkey as varchar) id_transaksi, o_totalprice jumlah, o_orderstatus status,
case when o_orderkey % 50 <> 1 then cast(o_orderdate as date) end tanggal_transaksi, o_orderdate created_at, o_orderdate updated_at,
case when o_orderkey % 11 = 0 then o_orderdate end deleted_at from orders""")
def export_typed_dated(spark: SparkSession, sf: str) -> DataFrame:
    """A typed batch in the run's dated folder, exported twice, read back by its run time."""
    o = table(spark, sf, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    raw = o.select(
        key.alias("id_transaksi"), F.col("o_totalprice").cast("string").alias("jumlah"), F.col("o_orderstatus").alias("status"),
        F.when(key % 50 == 1, "?").otherwise(day.cast("date").cast("string")).alias("tanggal_transaksi"),
        day.alias("created_at"), day.alias("updated_at"), F.when(key % 11 == 0, day).alias("deleted_at"))
    landing = folder(spark, "data_transaksi")
    for _ in range(2):
        export_dated(raw, landing, USERS_RUN, TRANSAKSI.schema)
    batch = scan_dated(spark, landing, USERS_RUN, schema=TRANSAKSI.schema)
    return batch.withColumns({c: naive_utc(F.col(c)) for c in ("created_at", "updated_at", "deleted_at")})


@query(f"with {USERS_SQL} select * from users")
def insert_from_json(spark: SparkSession, sf: str) -> DataFrame:
    """INSERT … SELECT from JSON arrays into the history, under a batch that is run twice."""
    history = history_table(spark, "users", USER_SCHEMA, "updated_at")
    payload = rows_to_json(users(spark, sf))
    for _ in range(2):
        history.append_batch(json_to_rows(payload, "payload", USER_SCHEMA), "20260815")
    return history.read().select(*USER.columns)


# --- composed flows -------------------------------------------------------------------

DIRECT_SQL = f"""with {USERS_SQL},
before as (select id, 'old' as name, email, created_at, created_at as updated_at, case when false then created_at end deleted_at
           from users where email <> 'BUILDING'),
batch as (select * from users where updated_at >= timestamp '{{low}} 00:00:00' and updated_at < timestamp '2026-08-16 00:00:00')
select coalesce(t.id, s.id) id, case when s.id is not null then s.name else t.name end as name,
       case when s.id is not null then s.email else t.email end as email, coalesce(t.created_at, s.created_at) created_at,
       case when s.id is not null then s.updated_at else t.updated_at end updated_at,
       case when t.id is not null then t.deleted_at else s.deleted_at end deleted_at
from before t full outer join batch s on t.id = s.id where s.id is null or s.deleted_at is null"""


def _user_tables(spark: SparkSession, sf: str):
    history = history_table(spark, "users", USER_SCHEMA, "updated_at")
    serving = new_table(spark, "main_users", USER_SCHEMA, ("made",), ("id",), {"made": by_day("created_at")})
    known = users(spark, sf).where("email <> 'BUILDING'")
    serving.overwrite(known.withColumns({
        "name": F.lit("old"), "updated_at": F.col("created_at"), "deleted_at": F.lit(None).cast("timestamp_ntz")}))
    return history, serving


@query(DIRECT_SQL.replace("{low}", "2026-08-15"))
def sync_direct_users(spark: SparkSession, sf: str) -> DataFrame:
    """Window extract, append, look-back merge with hard deletes; run with and without the JSON hop."""
    history, serving = _user_tables(spark, sf)
    for via_json in (False, True):
        sync_direct(users(spark, sf), history, serving, USER, USERS_RUN, via_json=via_json)
    return serving.read().drop("made")


EVENT = ChangeTable(key=("event_id",), version="ts", tombstone="gone", fixed=(), schema=T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType()),
    T.StructField("gone", T.TimestampNTZType())]))


@query("""with e as (select event_id, case when event_id % 3 = 0 then date_trunc('day', ts) + interval '86399' second + interval '500' millisecond else ts end ts,
value from events) select event_id, ts, value, case when false then ts end as gone from e where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-12'""")
def sync_direct_fractions(spark: SparkSession, sf: str) -> DataFrame:
    """Two days' runs over all events, a third of them changed in half of their day's last second: none is lost."""
    e = table(spark, sf, "events")
    late = F.date_trunc("day", "ts").cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(86399.5))
    source = e.select("event_id", F.when(F.col("event_id") % 3 == 0, late).otherwise(F.col("ts")).alias("ts"), "value",
                      F.lit(None).cast("timestamp_ntz").alias("gone"))
    history, serving = history_table(spark, "events", EVENT.schema, "ts"), new_table(spark, "main_events", EVENT.schema)
    for day in (10, 11):
        sync_direct(source, history, serving, EVENT, datetime(2024, 1, day, 17, tzinfo=UTC))
    return serving.read()


@query(DIRECT_SQL.replace("{low}", "2026-08-14"))
def sync_landing_users(spark: SparkSession, sf: str) -> DataFrame:
    """Export to the landing folder, append and clear it, merge what changed in the look-back of two days."""
    history, serving = _user_tables(spark, sf)
    history.append_batch(users(spark, sf).where("updated_at < timestamp_ntz'2026-08-15 00:00:00'"), "first")
    sync_landing(users(spark, sf), folder(spark, "landing"), history, serving, USER, USERS_RUN)
    return serving.read().drop("made")


@query(f"""with {USERS_SQL} select * from users where deleted_at is null""")
def sync_landing_first_load(spark: SparkSession, sf: str) -> DataFrame:
    """First load with the flow's defaults, served whole."""
    history = history_table(spark, "users", USER_SCHEMA, "updated_at")
    serving = new_table(spark, "main_users", USER_SCHEMA, (), ("id",))
    sync_landing(users(spark, sf), folder(spark, "landing"), history, serving, USER, USERS_RUN)
    return serving.read()


@query(f"""with {USERS_SQL} select * from users where deleted_at is null""")
def sync_landing_recovered(spark: SparkSession, sf: str) -> DataFrame:
    """A run fails after its export, quiet days follow, then a busy one: every change is served, however late."""
    rows = users(spark, sf)
    landing = folder(spark, "landing")
    history = history_table(spark, "users", USER_SCHEMA, "updated_at")
    serving = new_table(spark, "main_users", USER_SCHEMA, (), ("id",))
    first = rows.where("updated_at < timestamp_ntz'2026-08-05 00:00:00'")
    sync_landing(first, landing, history, serving, USER, datetime(2026, 8, 4, 17, tzinfo=UTC))
    known = rows.where("updated_at < timestamp_ntz'2026-08-06 00:00:00'")
    export_load(known, landing, history.name, USER, datetime(2026, 8, 5, 17, tzinfo=UTC), label="")  # then the run fails
    for day in (8, 9):
        sync_landing(known, landing, history, serving, USER, datetime(2026, 8, day, 17, tzinfo=UTC))
    export_micros(rows.where("updated_at >= timestamp_ntz'2026-08-06 00:00:00'"), f"{landing}/all_at_once", USER_SCHEMA)
    sync_landing(rows, landing, history, serving, USER, datetime(2026, 9, 3, 17, tzinfo=UTC))
    return serving.read()


@query(f"""with {TXSRC_SQL} select k, case when cast(u_at as date) = date '1998-03-04' then amt + 700 else amt end amt, st, d, c_at, u_at,
case when cast(u_at as date) = date '1998-03-04' then u_at else del end del from txsrc""")
def sync_dated_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """First load of everything, then one day of changes and soft deletes through a dated folder, run twice."""
    source = tx_source(spark, sf)
    landing = folder(spark, "data")
    history = history_table(spark, "tx", TX_SCHEMA, "u_at")
    serving = monthly_table(spark, "final")
    day = F.col("u_at").cast("date") == F.lit("1998-03-04").cast("date")
    later = source.withColumns({"amt": F.when(day, F.col("amt") + 700).otherwise(F.col("amt")),
                                "del": F.when(day, F.col("u_at")).otherwise(F.col("del"))})
    runs = [(source, datetime(1998, 3, 3, 20, tzinfo=UTC)), (later, datetime(1998, 3, 4, 20, tzinfo=UTC)),
            (later, datetime(1998, 3, 4, 20, tzinfo=UTC))]
    for rows, run_end in runs:
        sync_dated(rows, landing, history, serving, TX, change_day=date(1998, 3, 4), run_end=run_end)
    return serving.read().drop("m")


@query(MERGE_SQL + HARD_SQL)
def lookback_merge(spark: SparkSession, sf: str) -> DataFrame:
    """History to serving with hard deletes, looking back over all of it."""
    history = history_table(spark, "tx", TX_SCHEMA, "u_at")
    history.append_batch(tx_changes(spark, sf), "all")
    serving = new_table(spark, "serving", TX_SCHEMA, (), ("k",))
    serving.overwrite(tx_target(spark, sf))
    merge_recent(history, serving, TX, hard_delete_guarded(TX), datetime(2001, 12, 1, tzinfo=UTC), days=None)
    return serving.read()


@query(f"""with {TAXI_SQL} select vendor_id, pickup_datetime, dropoff_datetime,
case when passenger_count is null and data_file_year = 1999 then 1 else passenger_count end passenger_count, trip_distance,
case when data_file_year = 1997 and data_file_month = 2 and vendor_id = 1 then total_amount + 5.0::double else total_amount end total_amount,
data_file_year, data_file_month from taxi where not (vendor_id = 1 and trip_distance > 45) and not (total_amount < 0)""")
def migrate_hive_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Hive folders, one of them unusable, into a managed table; then delete, repair and raise."""
    trips = taxi(spark, sf)
    lost = (F.col("vendor_id") == 1) & (F.col("trip_distance") > 45)
    named = trips.withColumn("data_file_year", F.when(lost, "null").otherwise(F.col("data_file_year").cast("string")))
    raw = hive_folders(named, folder(spark, "raw"), tuple(TAXI_FOLDERS))
    home = new_table(spark, "home", TAXI_SCHEMA)
    managed = migrate_hive(spark, raw, TAXI_SCHEMA, TAXI_FOLDERS, f"{home.name}_managed", f"{home.root}_managed",
                           "data_file_month", 1, 12)
    delete_table(managed, "total_amount < 0")
    update_table(managed, {"passenger_count": "1"}, "passenger_count IS NULL AND data_file_year = 1999")
    update_table(managed, {"total_amount": "total_amount + 5.0D"},
                 "data_file_year = 1997 AND data_file_month = 2 AND vendor_id = 1")
    return managed.read().drop("data_file_month_bucket")

