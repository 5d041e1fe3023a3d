"""Inputs of the checked queries, derived from the given tables.

Each frame has a SQL twin.  Instants stay zone-less, as the tables hold them.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ChangeTable
from tidemark.session import scratch_dir, scratch_root
from tidemark.sinks.files import export_dated
from tidemark.tables import Derived, LakeTable, by_month, create_table, with_batch

WORK_DB = "tidemark_work"

TX_SCHEMA = T.StructType([
    T.StructField("k", T.StringType()), T.StructField("amt", T.DoubleType()), T.StructField("st", T.StringType()),
    T.StructField("d", T.DateType()), T.StructField("c_at", T.TimestampNTZType()),
    T.StructField("u_at", T.TimestampNTZType()), T.StructField("del", T.TimestampNTZType()),
])
TX = ChangeTable(key=("k",), version="u_at", tombstone="del", schema=TX_SCHEMA, partition="d", fixed=("c_at",))
USER_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "name", "email")]
    + [T.StructField(n, T.TimestampNTZType()) for n in ("created_at", "updated_at", "deleted_at")]
)
USER = ChangeTable(key=("id",), version="updated_at", tombstone="deleted_at", schema=USER_SCHEMA, fixed=("created_at",))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def civil(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


# --- transactions, from orders --------------------------------------------------------


def tx_target(spark: SparkSession, sf: str) -> DataFrame:
    """Serving rows before the merge: every order that is not pending."""
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    return _tx(o, F.col("o_totalprice"), F.col("o_orderdate"), F.lit(None))


def tx_history(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of every order; urgent ones end deleted."""
    return _versions(table(spark, sf, "orders"))


def tx_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The history without orders of low priority, which merges leave as they are; pending ones are unknown to the target."""
    return _versions(table(spark, sf, "orders").where("o_orderpriority <> '5-LOW'"))


def _versions(o: DataFrame) -> DataFrame:
    o = o.withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
    changed = F.col("o_orderdate") + days(F.col("v"))
    deleted = (F.col("o_orderpriority") == "1-URGENT") & (F.col("v") == 2)
    return _tx(o, F.col("o_totalprice") + 700 * F.col("v"), changed, F.when(deleted, changed))


def tx_source(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as a relational source would hold them, with one version each."""
    o = table(spark, sf, "orders")
    changed = F.col("o_orderdate") + hours(F.col("o_orderkey") % 24)
    return _tx(o, F.col("o_totalprice"), changed, F.when(F.col("o_orderkey") % 11 == 0, changed))


def _tx(o: DataFrame, amount: Column, changed: Column, deleted: Column) -> DataFrame:
    return o.select(
        F.col("o_orderkey").cast("string").alias("k"), amount.alias("amt"), F.col("o_orderstatus").alias("st"),
        F.col("o_orderdate").cast("date").alias("d"), F.col("o_orderdate").alias("c_at"), changed.alias("u_at"),
        deleted.cast("timestamp_ntz").alias("del"),
    )


TGT_SQL = """
tgt as (select cast(o_orderkey as varchar) k, o_totalprice amt, o_orderstatus st, cast(o_orderdate as date) d,
               o_orderdate c_at, o_orderdate u_at, case when false then o_orderdate end del
        from orders where o_orderstatus <> 'P')"""
HIST_SQL = """
hist as (select cast(o_orderkey as varchar) k, o_totalprice + 700 * v amt, o_orderstatus st,
                cast(o_orderdate as date) d, o_orderdate c_at, o_orderdate + v * interval '1' day u_at,
                case when o_orderpriority = '1-URGENT' and v = 2 then o_orderdate + v * interval '1' day end del
         from orders cross join (values (1), (2)) x(v))"""
CHANGES_SQL = HIST_SQL.replace("x(v))", "x(v) where o_orderpriority <> '5-LOW')")
SRC_SQL = """
src as (select k, amt, st, d, c_at, u_at, del
        from (select *, row_number() over (partition by k order by u_at desc) rn from hist) q where rn = 1)"""
TXSRC_SQL = """
txsrc as (select cast(o_orderkey as varchar) k, o_totalprice amt, o_orderstatus st, cast(o_orderdate as date) d,
                 o_orderdate c_at, o_orderdate + (o_orderkey % 24) * interval '1' hour u_at,
                 case when o_orderkey % 11 = 0 then o_orderdate + (o_orderkey % 24) * interval '1' hour end del
          from orders)"""
MERGE_SQL = f"with {TGT_SQL}, {CHANGES_SQL}, {SRC_SQL}\n"


# --- users, from customer -------------------------------------------------------------


def users(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    made = civil("2026-08-01 00:00:00") + days(F.col("c_custkey") % 30)
    changed = made + hours(F.col("c_custkey") % 31)
    return c.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("email"),
        made.alias("created_at"), changed.alias("updated_at"),
        F.when(F.col("c_custkey") % 11 == 0, changed).alias("deleted_at"),
    )


USERS_SQL = """
users as (select id, name, email, created_at, updated_at, case when c_custkey % 11 = 0 then updated_at end deleted_at
          from (select c_custkey, cast(c_custkey as varchar) id, c_name name, c_mktsegment email,
                       timestamp '2026-08-01 00:00:00' + (c_custkey % 30) * interval '1' day created_at,
                       timestamp '2026-08-01 00:00:00' + (c_custkey % 30) * interval '1' day
                         + (c_custkey % 31) * interval '1' hour updated_at
                from customer) c)"""


# --- taxi trips, from lineitem --------------------------------------------------------

TAXI_SCHEMA = T.StructType([
    T.StructField("vendor_id", T.IntegerType()), T.StructField("pickup_datetime", T.TimestampNTZType()),
    T.StructField("dropoff_datetime", T.TimestampNTZType()), T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()), T.StructField("total_amount", T.DoubleType()),
])
TAXI_FOLDERS = {"data_file_year": T.LongType(), "data_file_month": T.LongType()}


def taxi(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    refund = (F.col("l_linenumber") == 3) & (F.col("l_quantity") < 5)
    return li.select(
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("vendor_id"), F.col("l_shipdate").alias("pickup_datetime"),
        (F.col("l_shipdate") + hours(F.col("l_linenumber"))).alias("dropoff_datetime"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("passenger_count"), F.col("l_quantity").alias("trip_distance"),
        F.when(refund, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("total_amount"),
        F.year("l_shipdate").cast("bigint").alias("data_file_year"),
        F.month("l_shipdate").cast("bigint").alias("data_file_month"),
    )


TAXI_SQL = """
taxi as (select cast(l_suppkey % 2 + 1 as integer) vendor_id, l_shipdate pickup_datetime,
                l_shipdate + l_linenumber * interval '1' hour dropoff_datetime,
                nullif(l_linenumber, 7) passenger_count, l_quantity trip_distance,
                case when l_linenumber = 3 and l_quantity < 5 then -l_extendedprice else l_extendedprice end total_amount,
                cast(extract(year from l_shipdate) as bigint) data_file_year,
                cast(extract(month from l_shipdate) as bigint) data_file_month
         from lineitem)"""


# --- runs, from events ----------------------------------------------------------------


class Run(NamedTuple):
    """One run of a dated flow: the change times it takes, and its end."""

    low: str
    high: str
    run_end: datetime


# Together the runs take every event; each lands in the folder of its end's date in Jakarta.
RUNS = (
    Run("2000-01-01", "2024-01-10", datetime(2024, 1, 9, 20, tzinfo=UTC)),
    Run("2024-01-10", "2024-01-20", datetime(2024, 1, 19, 20, tzinfo=UTC)),
    Run("2024-01-20", "2100-01-01", datetime(2024, 1, 30, 20, tzinfo=UTC)),
)


def landed_by_run(spark: SparkSession, sf: str) -> tuple[str, T.StructType]:
    """A landing prefix with one dated folder per run, holding all events."""
    events = table(spark, sf, "events")
    landing = scratch_dir(spark, "dated")
    for run in RUNS:
        rows = events.where((F.col("ts") >= civil(run.low)) & (F.col("ts") < civil(run.high)))
        export_dated(rows, landing, run.run_end, events.schema)
    return landing, events.schema


# --- places to write ------------------------------------------------------------------


def folder(spark: SparkSession, label: str) -> str:
    return scratch_dir(spark, label)


def hive_folders(df: DataFrame, path: str, columns: tuple[str, ...]) -> str:
    df.hint("rebalance", *columns).sortWithinPartitions(*columns).write.partitionBy(*columns).parquet(path)
    return path


def new_table(spark: SparkSession, label: str, schema: T.StructType, partition_by: tuple[str, ...] = (),
              cluster_by: tuple[str, ...] = (), derived: dict[str, Derived] | None = None) -> LakeTable:
    """An empty table of its own, in a database of its own."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {WORK_DB} LOCATION '{scratch_root(spark)}/{WORK_DB}'")
    name = f"{WORK_DB}.{label}_{uuid.uuid4().hex[:12]}"
    return create_table(spark, name, schema, scratch_dir(spark, label), partition_by=partition_by, cluster_by=cluster_by,
                        derived=derived)


def monthly_table(spark: SparkSession, label: str, cluster_by: tuple[str, ...] = ("k", "st")) -> LakeTable:
    """A serving table of transactions laid out by the month of their date."""
    return new_table(spark, label, TX_SCHEMA, ("m",), cluster_by, {"m": by_month("d")})


def history_table(spark: SparkSession, label: str, schema: T.StructType, version: str | None = None) -> LakeTable:
    """A history table: batches first, then the month of the change time where one is named."""
    if version is None:
        return new_table(spark, label, with_batch(schema), ("batch_id",))
    return new_table(spark, label, with_batch(schema), ("batch_id", "changed"), (), {"changed": by_month(version)})
