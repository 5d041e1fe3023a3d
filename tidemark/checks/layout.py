"""Merges and lookups that know their files, states at many moments: checked queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks.changes import HARD_SQL
from tidemark.checks.fixtures import (
    CHANGES_SQL, HIST_SQL, MERGE_SQL, SRC_SQL, TX, TX_SCHEMA, TXSRC_SQL, monthly_table, new_table, table, tx_changes, tx_history, tx_source,
    tx_target,
)
from tidemark.checks.registry import query
from tidemark.operators.bucketed import create_bucketed
from tidemark.operators.cluster import overwrite_clustered, recluster
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.fileindex import FileIndex
from tidemark.operators.history import as_of_many, states_at
from tidemark.operators.merge import hard_delete_guarded, merge_table, soft_delete
from tidemark.session import stored

# --- files ----------------------------------------------------------------------------


@query(f"""with {TXSRC_SQL}, {CHANGES_SQL}, {SRC_SQL},
moved as (select k, amt, st, d + 40 d, u_at, del from src where c_at >= timestamp '1996-01-01' and c_at < timestamp '1996-07-01')
select t.k, case when s.k is not null then s.amt else t.amt end amt, case when s.k is not null then s.st else t.st end st,
       case when s.k is not null then s.d else t.d end d, t.c_at, case when s.k is not null then s.u_at else t.u_at end u_at,
       case when s.k is not null then s.del else t.del end del from txsrc t left join moved s on t.k = s.k""")
def merge_bloom_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A merge on the key alone asks the files' Bloom filters where its keys are; run twice, the second time over rewritten files."""
    serving = monthly_table(spark, "bloom")
    serving.overwrite(tx_source(spark, sf))
    index = FileIndex(serving, ("k",))
    half = tx_changes(spark, sf).where("c_at >= timestamp_ntz'1996-01-01 00:00:00' and c_at < timestamp_ntz'1996-07-01 00:00:00'")
    batch = stored(latest_per_key(half, TX.key, TX.version).withColumn("d", F.date_add("d", 40)))
    for _ in range(2):
        merge_table(serving, batch, soft_delete(TX, on=("k",)), unique_source=True, index=index)
    return serving.read().drop("m")


@query(MERGE_SQL + HARD_SQL)
def merge_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Hard deletes into a table bucketed by the key, which no merge exchanges; the second merge reads what the first wrote."""
    home = new_table(spark, "bucketed", TX_SCHEMA)
    serving = create_bucketed(spark, f"{home.name}_by_key", TX_SCHEMA, f"{home.root}_by_key", TX.key, 8)
    serving.overwrite(tx_target(spark, sf))
    batch = latest_per_key(tx_changes(spark, sf), TX.key, TX.version)
    for _ in range(2):
        serving.merge(batch, hard_delete_guarded(TX), unique_source=True)
    return serving.read()


@query("""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders
where o_custkey between 200 and 320 and o_totalprice between 60000.0 and 180000.0""")
def clustered_point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A table clustered by two columns at once, written, gathered again, and read by ranges of both from the files that can hold them."""
    orders = table(spark, sf, "orders")
    layout = new_table(spark, "clustered", orders.schema, ("o_orderstatus",), ("o_custkey", "o_totalprice"))
    overwrite_clustered(layout, orders, pieces=16)
    recluster(layout, [("F",)], pieces=16)
    return FileIndex(layout, bounds=layout.cluster_by).lookup({"o_custkey": (200, 320), "o_totalprice": (60000.0, 180000.0)})


# --- moments --------------------------------------------------------------------------

MOMENTS = ["1995-12-31 23:59:59", "1996-12-31 23:59:59", "1997-06-30 00:00:00", "1997-06-30 18:00:00", "1997-12-31 23:59:59", "2002-01-01 00:00:00"]
MOMENTS_SQL = "moments as (select unnest([" + ", ".join(f"timestamp '{m}'" for m in MOMENTS) + "]) as moment)"


def _moments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m,) for m in MOMENTS], "moment string").select(F.col("moment").cast("timestamp_ntz"))


@query(f"""with {HIST_SQL}, {MOMENTS_SQL}, keys as (select distinct k from hist),
asked as (select moment, k from moments, keys)
select moment, a.k, amt, st, d, c_at, u_at, del from asked a asof join hist h on a.k = h.k and a.moment >= h.u_at where del is null""", name="as_of_many")
def as_of_many_moments(spark: SparkSession, sf: str) -> DataFrame:
    """The live rows at several moments, from one reading of the history."""
    return as_of_many(tx_history(spark, sf), TX, _moments(spark))


DELETED_SQL = "deleted as (select unnest([timestamp '1998-06-01 00:00:00', timestamp '1998-06-04 12:00:00', timestamp '1998-06-10 23:59:59']) as moment)"


@query(f"""with {TXSRC_SQL}, {DELETED_SQL},
kinds(kind, safe) as (values ('managed', 0), ('native', 168)), windows as (select unnest([48, 72, 96, 120, 144, 168])::int as hours)
select moment, k, kind, hours, case when del is null or moment < del then 'visible'
    when moment < del + hours * interval '1' hour then 'recoverable'
    when moment < del + (hours + safe) * interval '1' hour then 'fail_safe' else 'gone' end state
from txsrc, deleted, kinds, windows where del is not null""")
def recoverability(spark: SparkSession, sf: str) -> DataFrame:
    """What can still be seen, asked for or restored of every deleted row, for each window and kind of table, at three moments."""
    moments = spark.createDataFrame([("1998-06-01 00:00:00",), ("1998-06-04 12:00:00",), ("1998-06-10 23:59:59",)], "moment string")
    rows = tx_source(spark, sf).where("del is not null").select("k", "del")
    return states_at(rows, TX, moments.select(F.col("moment").cast("timestamp_ntz"))).drop("del")
