"""Scans, extracts, types and time: checked queries."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks.fixtures import (
    RUNS, TAXI_FOLDERS, TAXI_SCHEMA, TAXI_SQL, USER, USERS_SQL, folder, hive_folders, landed_by_run, table, taxi, users,
)
from tidemark.checks.registry import query
from tidemark.functions import timewin
from tidemark.functions.scalars import compact_day, json_value, range_bucket, storage_uri
from tidemark.functions.types import conform, to_text
from tidemark.model import TRANSAKSI
from tidemark.operators.storage import latest_version
from tidemark.session import stored
from tidemark.sinks.files import export_micros
from tidemark.sources.extract import (
    extract_between, extract_day, extract_for_load, extract_full, extract_previous_day, extract_recent,
)
from tidemark.sources.files import scan_dated, scan_dated_by_filter, scan_glob, scan_hive, scan_hive_repaired
from tidemark.sources.json_rows import json_to_rows, rows_to_json
from tidemark.sources.ranges import quantile_ranges

RUN_END = datetime(2024, 1, 10, 18, tzinfo=UTC)  # 01:00 on the 11th in Jakarta
ORDER_NOW = datetime(1998, 3, 5, 18, 30, tzinfo=UTC)


@query("select * from orders", name="scan_glob")
def scan_glob_files(spark: SparkSession, sf: str) -> DataFrame:
    landing = folder(spark, "glob")
    orders = table(spark, sf, "orders")
    filled = F.col("o_orderstatus") == "F"
    orders.where(filled).write.parquet(f"{landing}/first")
    before = scan_glob(spark, f"{landing}/*/*.parquet", orders.schema)
    orders.where(~filled).write.parquet(f"{landing}/second")
    after = scan_glob(spark, f"{landing}/*/*.parquet", orders.schema)
    # The earlier scan keeps its file list, the new one has every file.
    return before.unionByName(after.where(~filled))


@query(f"""with {TAXI_SQL}
select vendor_id, pickup_datetime, passenger_count, trip_distance, total_amount
from taxi where data_file_year = 1997 and data_file_month = 2""")
def hive_scan_pruned(spark: SparkSession, sf: str) -> DataFrame:
    root = hive_folders(taxi(spark, sf), folder(spark, "taxi"), tuple(TAXI_FOLDERS))
    trips = scan_hive(spark, root, TAXI_SCHEMA, TAXI_FOLDERS)
    month = trips.where((F.col("data_file_year") == 1997) & (F.col("data_file_month") == 2))
    return month.select("vendor_id", "pickup_datetime", "passenger_count", "trip_distance", "total_amount")


@query(f"with {TAXI_SQL} select * from taxi where not (vendor_id = 1 and trip_distance > 45)")
def hive_bad_partition(spark: SparkSession, sf: str) -> DataFrame:
    trips = taxi(spark, sf)
    lost = (F.col("vendor_id") == 1) & (F.col("trip_distance") > 45)
    named = trips.withColumn("data_file_year", F.when(lost, "null").otherwise(F.col("data_file_year").cast("string")))
    root = hive_folders(named, folder(spark, "taxi"), tuple(TAXI_FOLDERS))
    return scan_hive_repaired(spark, root, TAXI_SCHEMA, TAXI_FOLDERS)


@query(f"with {USERS_SQL} select * from users", name="extract_full")
def extract_all(spark: SparkSession, sf: str) -> DataFrame:
    return extract_full(users(spark, sf), USER.columns)


@query("""select event_id, ts, event_type from events
where ts >= timestamp '2024-01-10 00:00:00' and ts <= timestamp '2024-01-10 23:59:59'""")
def extract_window(spark: SparkSession, sf: str) -> DataFrame:
    return extract_previous_day(table(spark, sf, "events").select("event_id", "ts", "event_type"), "ts", RUN_END)


@query("""select event_id, ts, event_type from events
where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-11 00:00:00'""")
def extract_window_half_open(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return extract_previous_day(events, "ts", RUN_END, closed="left")


@query("""select event_id, user_id from events
where ts >= timestamp '2024-01-05 06:00:00' and ts <= timestamp '2024-01-20 12:30:00'""")
def extract_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract_between(table(spark, sf, "events"), "ts", datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 12, 30), closed="both")
    return rows.select("event_id", "user_id")


@query("""select event_id, case when event_id % 5 <> 0 then timestamp '2024-01-17 03:00:00' + (event_id % 10) * interval '1' second else ts end as ts,
true as even from events""")
def extract_quantile_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Four fifths of the rows changed within ten seconds: 64 ranges, of which none has twice the mean, bring every row once."""
    bulk = F.lit("2024-01-17 03:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("event_id") % 10)
    source = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, bulk).otherwise(F.col("ts")).alias("ts"))
    cut = quantile_ranges(source, "ts", 64, tie="event_id")
    rows = stored(source.withColumn("range", cut.number(source)))
    sizes = rows.groupBy("range").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("ranges"), F.max("n").alias("most"), F.sum("n").alias("all"))
    even = sizes.select(((F.col("ranges") >= 64) & (F.col("most") < 2 * F.col("all") / F.col("ranges"))).alias("even"))
    return rows.drop("range").join(F.broadcast(even), F.lit(True))


@query("select * from events where cast(ts as date) = date '2024-01-17'", name="extract_day")
def extract_one_day(spark: SparkSession, sf: str) -> DataFrame:
    return extract_day(table(spark, sf, "events"), "ts", date(2024, 1, 17))


@query("""select event_id, ts, user_id, event_type, value, cast(props ->> '$.k' as bigint) as k from events""")
def json_unnest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    rows = json_to_rows(rows_to_json(events), "payload", events.schema)
    return rows.select("event_id", "ts", "user_id", "event_type", "value", json_value(F.col("props"), "k").cast("bigint").alias("k"))


@query(f"with {USERS_SQL} select * from users")
def json_missing_values(spark: SparkSession, sf: str) -> DataFrame:
    rows = users(spark, sf)
    return json_to_rows(rows_to_json(rows, array_rows=700), "payload", rows.schema)


@query("""
select cast(o_orderkey as varchar) id_transaksi,
       case when o_orderkey % 50 <> 0 then o_totalprice end jumlah, o_orderstatus status,
       case when o_orderkey % 50 <> 1 then cast(o_orderdate as date) end tanggal_transaksi,
       case when o_orderkey % 3 = 0 then o_orderdate - interval '7' hour else o_orderdate end created_at,
       case when o_orderkey % 50 <> 2 then o_orderdate end updated_at,
       case when false then o_orderdate end deleted_at
from orders""")
def conform_types(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("string")
    damaged = o.select(
        key.alias("id_transaksi"),
        F.when(key % 50 == 0, "x").otherwise(F.col("o_totalprice").cast("string")).alias("jumlah"),
        F.col("o_orderstatus").alias("status"),
        F.when(key % 50 == 1, "x").otherwise(day).alias("tanggal_transaksi"),
        F.when(key % 3 == 0, F.concat(day, F.lit("T00:00:00+07:00"))).otherwise(F.concat(day, F.lit(" 00:00:00"))).alias("created_at"),
        F.when(key % 50 == 2, "32 May").otherwise(day).alias("updated_at"),
        F.lit("NaT").alias("deleted_at"),
    )
    typed = conform(damaged, TRANSAKSI.schema)
    return typed.withColumns({c: timewin.naive_utc(F.col(c)) for c in ("created_at", "updated_at", "deleted_at")})


@query("""select event_id, cast(case when event_type <> 'click' then value end as varchar) is null as no_text,
case when event_type <> 'click' then value end as value from events""")
def coerce_text_markers(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "click", "nan").otherwise(F.col("value").cast("string"))
    return events.select("event_id", to_text(text).isNull().alias("no_text"), to_text(text).try_cast("double").alias("value"))


@query("select * from events")
def export_micros_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    path = folder(spark, "micros")
    export_micros(events, path)
    return scan_glob(spark, path, events.schema)


@query("""select event_id, ts + interval '7' hour as jakarta,
cast(cast(ts + interval '7' hour as date) as timestamp) - interval '1' day as window_start,
cast(cast(ts + interval '7' hour as date) as timestamp) - interval '1' second as window_end,
ts + interval '7' hour - interval '2' day as cutoff,
strftime(ts + interval '7' hour, '%Y%m%d') as batch, strftime(ts, '%Y%m%d') as utc_day,
cast(floor(epoch(ts)) as bigint) as seconds from events""")
def time_columns(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    start, end = timewin.previous_day_bounds(ts)
    return table(spark, sf, "events").select(
        "event_id", timewin.civil_now_col(ts).alias("jakarta"), start.alias("window_start"), end.alias("window_end"),
        timewin.lookback_cutoff_col(ts).alias("cutoff"), timewin.batch_date_col(ts).alias("batch"),
        compact_day(ts).alias("utc_day"), timewin.epoch_seconds_col(ts).alias("seconds"),
    )


@query("select * from orders where o_orderdate >= timestamp '1998-03-04 01:30:00'")
def lookback_filter(spark: SparkSession, sf: str) -> DataFrame:
    return extract_recent(table(spark, sf, "orders"), "o_orderdate", ORDER_NOW)


@query("""select 'first' as load, count(*) as n, min(ts) as low, max(ts) as high from events
union all select 'later', count(*), min(ts), max(ts) from events where cast(ts as date) = date '2024-01-09'""")
def load_mode_filter(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    day = date(2024, 1, 9)

    def summary(label: str, is_initial: bool) -> DataFrame:
        rows = extract_for_load(events, "ts", is_initial, day)
        return rows.agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high")).select(
            F.lit(label).alias("load"), "n", "low", "high")

    return summary("first", True).unionByName(summary("later", False))


@query("""select l_orderkey, l_linenumber,
cast(case when l_quantity is null then null when l_quantity < 1 then 0 when l_quantity >= 12 then 12
     else floor(l_quantity) end as integer) as bucket from lineitem""")
def range_bucket_values(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", range_bucket(F.col("l_quantity"), 1, 12).alias("bucket"))


@query("""select p_partkey, case when p_partkey % 4 <> 0 then 'gs://lake/' || p_brand || '/' || p_partkey end as uri from part""")
def uri_extract(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    folder_name = F.concat(F.lit("gs://lake/"), "p_brand", F.lit("/"), F.col("p_partkey").cast("string"))
    option = F.when(F.col("p_partkey") % 4 == 0, "format = 'PARQUET'").otherwise(
        F.concat(F.lit('storage_uri = "'), folder_name, F.lit('"')))
    ddl = F.concat(F.lit("CREATE TABLE `"), "p_name", F.lit("` OPTIONS ("), option, F.lit(")"))
    return p.select("p_partkey", storage_uri(ddl).alias("uri"))


@query("""select event_type, 'v' || max(event_id) || '.metadata.json' as file, max(event_id) as version
from events group by event_type""", name="latest_version")
def latest_metadata_version(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "events").select(
        "event_type", F.concat(F.lit("v"), F.col("event_id").cast("string"), F.lit(".metadata.json")).alias("file"))
    return latest_version(files, ["event_type"], "file")


@query("select * from events where ts >= timestamp '2024-01-20 00:00:00'")
def scan_dated_prefix(spark: SparkSession, sf: str) -> DataFrame:
    landing, schema = landed_by_run(spark, sf)
    return scan_dated(spark, landing, RUNS[-1].run_end, schema=schema)


@query("select * from events where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-20 00:00:00'")
def scan_dated_path_filter(spark: SparkSession, sf: str) -> DataFrame:
    landing, schema = landed_by_run(spark, sf)
    return scan_dated_by_filter(spark, landing, "20240120", schema)
