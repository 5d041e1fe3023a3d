"""Deduplication, merges, row changes and past states: checked queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks.fixtures import (
    CHANGES_SQL, HIST_SQL, MERGE_SQL, SRC_SQL, TAXI_SQL, TX, TXSRC_SQL, monthly_table, new_table, table, taxi,
    tx_changes, tx_history, tx_source, tx_target,
)
from tidemark.checks.registry import query
from tidemark.functions.timewin import current_civil
from tidemark.operators.aggregates import grouped_totals, top_rows
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.dml import delete_table, insert_rows, insert_values, update_table
from tidemark.operators.history import as_of, expired, latest_state
from tidemark.operators.merge import (
    MergeSpec, hard_delete_guarded, hard_delete_unguarded, merge, merge_table, soft_delete,
)
from tidemark.session import stored
from tidemark.tables import LakeTable, by_range

# --- newest row per key ---------------------------------------------------------------


@query(f"with {HIST_SQL}, {SRC_SQL}\nselect * from src")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(tx_history(spark, sf), TX.key, TX.version)


@query("""select user_id, event_type, event_id, hour from (
select *, row_number() over (partition by user_id order by hour desc nulls last, event_type desc, event_id desc) rn
from (select user_id, event_type, event_id, case when event_id % 17 <> 0 then date_trunc('day', ts) end as hour from events) e) q
where rn = 1""")
def dedup_ties(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    coarse = F.when(F.col("event_id") % 17 != 0, F.date_trunc("day", "ts").cast("timestamp_ntz"))
    rows = e.select("user_id", "event_type", "event_id", coarse.alias("hour"))
    return latest_per_key(rows, ("user_id",), "hour")


# --- merges ---------------------------------------------------------------------------

SOFT_SQL = """
select coalesce(t.k, s.k) k, case when s.k is not null then s.amt else t.amt end amt,
       case when s.k is not null then s.st else t.st end st, coalesce(t.d, s.d) d, coalesce(t.c_at, s.c_at) c_at,
       case when s.k is not null then s.u_at else t.u_at end u_at, case when s.k is not null then s.del else t.del end del
from tgt t full outer join src s on t.k = s.k and t.d = s.d"""
HARD_SQL = """
select coalesce(t.k, s.k) k, case when s.k is not null then s.amt else t.amt end amt,
       case when s.k is not null then s.st else t.st end st,
       case when s.k is not null then s.d else t.d end d, coalesce(t.c_at, s.c_at) c_at,
       case when s.k is not null then s.u_at else t.u_at end u_at,
       case when t.k is not null then t.del else s.del end del
from tgt t full outer join src s on t.k = s.k
where s.k is null or s.del is null"""
UNGUARDED_SQL = """
select coalesce(t.k, s.k) k, case when s.k is not null then s.amt else t.amt end amt,
       case when s.k is not null then s.st else t.st end st, coalesce(t.d, s.d) d, coalesce(t.c_at, s.c_at) c_at,
       case when s.k is not null then s.u_at else t.u_at end u_at, case when s.k is not null then s.del else t.del end del
from tgt t full outer join src s on t.k = s.k and t.d = s.d
where not (t.k is not null and s.k is not null and s.del is not null)"""


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    """Newest change per key, stored once because a merge reads it three times."""
    return stored(latest_per_key(tx_changes(spark, sf), TX.key, TX.version))


def _merged(spark: SparkSession, sf: str, spec: MergeSpec) -> DataFrame:
    return merge(tx_target(spark, sf), _batch(spark, sf), spec, unique_source=True)


@query(MERGE_SQL + HARD_SQL)
def merge_hard_delete(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, hard_delete_guarded(TX))


@query(MERGE_SQL + UNGUARDED_SQL)
def merge_hard_delete_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, hard_delete_unguarded(TX, ("k", "to_date(c_at)")))


@query(MERGE_SQL + SOFT_SQL)
def merge_soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, soft_delete(TX))


@query(MERGE_SQL + SOFT_SQL)
def merge_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Merging the same batch again changes nothing."""
    batch = _batch(spark, sf)
    once = stored(merge(tx_target(spark, sf), batch, soft_delete(TX), unique_source=True))
    return merge(once, batch, soft_delete(TX), unique_source=True)


@query(MERGE_SQL + SOFT_SQL)
def merge_checked_source(spark: SparkSession, sf: str) -> DataFrame:
    """The same batch, with its keys checked for duplicates at run time."""
    return merge(tx_target(spark, sf), _batch(spark, sf), soft_delete(TX))


MOVED_SQL = f"with {TXSRC_SQL}, {CHANGES_SQL}, {SRC_SQL}, moved as (select k, amt, st, d + 40 d, c_at, u_at, del from src)\n"


def _moved(spark: SparkSession, sf: str) -> DataFrame:
    """The newest change of every key, all with another partition value."""
    return _batch(spark, sf).withColumn("d", F.date_add("d", 40))


@query(MOVED_SQL + """select t.k, t.amt, t.st, t.d, t.c_at, t.u_at, t.del from txsrc t
union all select s.k, s.amt, s.st, s.d, s.c_at, s.u_at, s.del from moved s""")
def merge_moved_partition(spark: SparkSession, sf: str) -> DataFrame:
    """A key whose partition value changed does not match and gets a second row."""
    return merge(tx_source(spark, sf), _moved(spark, sf), soft_delete(TX), unique_source=True)


@query(MOVED_SQL + """select t.k, coalesce(s.amt, t.amt) amt, coalesce(s.st, t.st) st, coalesce(s.d, t.d) d, t.c_at,
       coalesce(s.u_at, t.u_at) u_at, case when s.k is not null then s.del else t.del end del
from txsrc t left join moved s on t.k = s.k""")
def merge_on_key_only(spark: SparkSession, sf: str) -> DataFrame:
    """Matching on the key alone moves the row to its new partition value."""
    return merge(tx_source(spark, sf), _moved(spark, sf), soft_delete(TX, on=("k",)), unique_source=True, repeated_keys=False)


@query(f"""with {TXSRC_SQL}, {CHANGES_SQL}, {SRC_SQL},
older as (select k, amt, st, d, c_at, u_at - interval '36' hour u_at, del from src)
select t.k, case when s.u_at > t.u_at then s.amt else t.amt end amt, case when s.u_at > t.u_at then s.st else t.st end st,
       t.d, t.c_at, case when s.u_at > t.u_at then s.u_at else t.u_at end u_at,
       case when s.u_at > t.u_at then s.del else t.del end del
from txsrc t left join older s on t.k = s.k""")
def merge_version_guard(spark: SparkSession, sf: str) -> DataFrame:
    """With the guard an older batch row does not overwrite a newer target row."""
    older = _batch(spark, sf).withColumn("u_at", F.col("u_at") - F.make_dt_interval(hours=F.lit(36)))
    return merge(tx_source(spark, sf), older, soft_delete(TX, guard_version=True), unique_source=True)


def _serving(spark: SparkSession, sf: str) -> LakeTable:
    serving = monthly_table(spark, "serving")
    serving.overwrite(tx_target(spark, sf))
    return serving


@query(MERGE_SQL + SOFT_SQL)
def merge_table_soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Only the batch's own months are rewritten, then switched in the catalog."""
    serving = _serving(spark, sf)
    batch = latest_per_key(tx_changes(spark, sf), TX.key, TX.version)
    merge_table(serving, batch, soft_delete(TX), unique_source=True)
    return serving.read().drop("m")


@query(MERGE_SQL + HARD_SQL)
def merge_table_hard_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Matches may lie in any month; those months are found first."""
    serving = _serving(spark, sf)
    batch = latest_per_key(tx_changes(spark, sf), TX.key, TX.version)
    merge_table(serving, batch, hard_delete_guarded(TX), unique_source=True)
    return serving.read().drop("m")


# --- insert, update, delete -----------------------------------------------------------


def _managed(spark: SparkSession, sf: str) -> LakeTable:
    """Trips partitioned by an integer range of the month."""
    trips = taxi(spark, sf)
    managed = new_table(spark, "trips", trips.schema, ("bucket",), derived={"bucket": by_range("data_file_month", 1, 12)})
    managed.overwrite(trips)
    return managed


@query(f"with {TAXI_SQL} select *, cast(data_file_month as integer) as bucket from taxi")
def ctas_range_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return _managed(spark, sf).read()


@query(f"""with {TAXI_SQL} select vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, total_amount,
data_file_year, data_file_month from taxi
union all select vendor_id, pickup_datetime, case when false then pickup_datetime end, passenger_count,
case when false then 0.5::double end, total_amount, data_file_year, data_file_month
from taxi where data_file_year = 2000 and data_file_month = 6""")
def dml_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Columns that are not listed are NULL."""
    managed = _managed(spark, sf)
    insert_rows(managed, taxi(spark, sf).where("data_file_year = 2000 and data_file_month = 6").drop("dropoff_datetime", "trip_distance"))
    return managed.read().drop("bucket")


@query(f"""with {TAXI_SQL}, rows_ as (select vendor_id, passenger_count, total_amount, data_file_month, pickup_datetime from taxi
union all select * from (values (91, 2, 7.5::double, 4::bigint, now()::timestamp), (92, null, 0.25::double, 13::bigint, now()::timestamp)) v)
select vendor_id, passenger_count, total_amount, data_file_month, pickup_datetime >= timestamp '2020-01-01 00:00:00' as is_new from rows_""")
def dml_insert_values(spark: SparkSession, sf: str) -> DataFrame:
    """Literal rows with the current civil time, and no value for the other columns."""
    managed = _managed(spark, sf)
    names = ("vendor_id", "passenger_count", "total_amount", "data_file_month", "pickup_datetime")
    insert_values(managed, names, (91, 2, 7.5, 4, current_civil("Asia/Jakarta")), (92, None, 0.25, 13, current_civil()))
    new = F.col("pickup_datetime") >= F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return managed.read().select(*names[:4], new.alias("is_new"))


@query(f"""with {TAXI_SQL} select vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
case when data_file_year = 1997 and data_file_month = 2 and vendor_id = 1 then total_amount + 5.0::double else total_amount end total_amount,
data_file_year, data_file_month from taxi""")
def dml_update(spark: SparkSession, sf: str) -> DataFrame:
    managed = _managed(spark, sf)
    update_table(managed, {"total_amount": "total_amount + 5.0D"},
                 "data_file_year = 1997 AND data_file_month = 2 AND vendor_id = 1")
    return managed.read().drop("bucket")


@query(f"""with {TAXI_SQL} select vendor_id, pickup_datetime, dropoff_datetime,
case when passenger_count is null and data_file_year = 1998 then 1 else passenger_count end passenger_count,
trip_distance, total_amount, data_file_year, data_file_month from taxi""")
def dml_update_null(spark: SparkSession, sf: str) -> DataFrame:
    managed = _managed(spark, sf)
    update_table(managed, {"passenger_count": "1"}, "passenger_count IS NULL AND data_file_year = 1998")
    return managed.read().drop("bucket")


@query(f"with {TAXI_SQL} select * from taxi where not (total_amount < 0)")
def dml_delete(spark: SparkSession, sf: str) -> DataFrame:
    managed = _managed(spark, sf)
    delete_table(managed, "total_amount < 0")
    return managed.read().drop("bucket")


@query(f"with {TAXI_SQL} select * from taxi where passenger_count is null or passenger_count <= 3")
def dml_delete_unknown(spark: SparkSession, sf: str) -> DataFrame:
    """Rows for which the predicate is NULL stay."""
    managed = _managed(spark, sf)
    delete_table(managed, "passenger_count > 3")
    return managed.read().drop("bucket")


@query(f"with {TAXI_SQL} select * from taxi where data_file_month not in (4, 9)")
def dml_delete_partition(spark: SparkSession, sf: str) -> DataFrame:
    """A delete that empties partitions drops them."""
    managed = _managed(spark, sf)
    delete_table(managed, "data_file_month IN (4, 9)")
    return managed.read().drop("bucket")


@query(f"""with {TAXI_SQL} select vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
case when data_file_month = 2 then 0.0::double else total_amount end total_amount, data_file_year, data_file_month
from taxi where data_file_month <> 5""")
def partition_replace_and_drop(spark: SparkSession, sf: str) -> DataFrame:
    managed = _managed(spark, sf)
    february = managed.only([(2,)]).withColumn("total_amount", F.lit(0.0))
    managed.replace_partitions(february, [(2,)])
    managed.drop_partitions([(5,)])
    return managed.read().drop("bucket")


# --- preview and totals ---------------------------------------------------------------


@query(f"""with {TAXI_SQL} select vendor_id, pickup_datetime, passenger_count, trip_distance, total_amount
from taxi where data_file_year = 1997 and data_file_month = 2
order by total_amount desc, pickup_datetime, vendor_id, passenger_count, trip_distance limit 10""")
def preview_topk(spark: SparkSession, sf: str) -> DataFrame:
    month = taxi(spark, sf).where("data_file_year = 1997 and data_file_month = 2")
    shown = month.select("vendor_id", "pickup_datetime", "passenger_count", "trip_distance", "total_amount")
    return top_rows(shown, "total_amount", 10, ("pickup_datetime", "vendor_id", "passenger_count", "trip_distance"))


@query(f"""with {TAXI_SQL} select passenger_count, count(*) total_trips,
cast(sum(cast(total_amount as decimal(18,2))) as double) total_revenue
from taxi where data_file_year = 1997 and data_file_month = 2 group by passenger_count order by total_trips desc""")
def olap_group(spark: SparkSession, sf: str) -> DataFrame:
    month = taxi(spark, sf).where("data_file_year = 1997 and data_file_month = 2")
    return grouped_totals(month, "passenger_count", "total_amount", "total_trips", "total_revenue")


# --- past states ----------------------------------------------------------------------


@query(f"""with {HIST_SQL} select k, amt, st, d, c_at, u_at, del from
(select *, row_number() over (partition by k order by u_at desc) rn from hist where u_at <= timestamp '1998-01-01 00:00:00') q
where rn = 1 and del is null""")
def as_of_history(spark: SparkSession, sf: str) -> DataFrame:
    return as_of(tx_history(spark, sf), TX, "1998-01-01 00:00:00")


@query(f"with {HIST_SQL}, {SRC_SQL}\nselect * from src where del is null")
def as_of_now(spark: SparkSession, sf: str) -> DataFrame:
    return latest_state(tx_history(spark, sf), TX)


@query(f"with {TXSRC_SQL} select k, del from txsrc where del <= timestamp '1998-06-01 00:00:00' - interval '48' hour")
def retention_managed(spark: SparkSession, sf: str) -> DataFrame:
    """Deleted longer ago than the shortest window; of all rows, some are deleted later than that moment."""
    return expired(tx_source(spark, sf), TX, "1998-06-01 00:00:00", 48).select("k", "del")


@query(f"with {TXSRC_SQL} select k, del from txsrc where del <= timestamp '1998-06-01 00:00:00' - interval '168' hour")
def retention_native(spark: SparkSession, sf: str) -> DataFrame:
    return expired(tx_source(spark, sf), TX, "1998-06-01 00:00:00", 168).select("k", "del")
