"""Bloom filters and bounds of files, clustering, states at many moments."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import fields, rows
from tidemark.model import ChangeTable
from tidemark.operators.bucketed import create_bucketed
from tidemark.operators.cluster import clustered, overwrite_clustered, recluster, z_value
from tidemark.operators.dml import insert_rows
from tidemark.operators.fileindex import FILE, FileIndex
from tidemark.operators.history import as_of, as_of_many, at_moments, lifetimes, states_at, validity
from tidemark.operators.merge import hard_delete_guarded, merge_table, soft_delete
from tidemark.tables import by_day

SCHEMA = fields("k bigint,v double,p string")


def files_opened(df) -> int:
    """Files that the scans of an executed frame read."""
    df.collect()

    def of(plan) -> int:
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return of(plan.executedPlan())
        if "QueryStage" in name:
            return of(plan.plan())
        own = plan.metrics().get("numFiles").get().value() if name.startswith("Scan") else 0
        return own + sum(of(plan.children().apply(i)) for i in range(plan.children().size()))

    return of(df._jdf.queryExecution().executedPlan())


@pytest.fixture
def spread_out(spark, make_table):
    """40 partitions of 200 rows whose keys lie anywhere."""
    table = make_table(SCHEMA, partition_by=("p",))
    table.overwrite(spark.range(8000).select(F.col("id").alias("k"), F.rand(3).alias("v"), (F.xxhash64("id") % 20).cast("string").alias("p")))
    return table


def test_filters_find_every_file_and_few_others(spark, spread_out):
    index = FileIndex(spread_out, ("k",))
    files = spread_out.read().select(FILE).distinct().count()
    there = [7, 1234, 7999]
    found = index.files_with(spark.createDataFrame([(k,) for k in there], "k int"))  # of another width than the table's
    holding = {r[0] for r in spread_out.read().where(F.col("k").isin(there)).select(FILE).distinct().collect()}
    assert holding <= {r["__file"] for r in found.collect()} and found.count() < files
    # Eight keys that are nowhere: each may meet a few per cent of the files by chance.
    absent = spark.range(100_000, 100_008).select(F.col("id").alias("k"))
    assert index.files_with(absent).count() <= 0.05 * 8 * files
    assert index.files_with(spark.createDataFrame([(None,)], "k long")).count() == 0


def test_files_are_indexed_once(spark, spread_out):
    index = FileIndex(spread_out, ("k", "upper(p)"), ("k", "v"))
    first = index.refresh()
    assert first == spread_out.read().select(FILE).distinct().count() and index.refresh() == 0
    spread_out.replace_partitions(spread_out.only([("3",)]), [("3",)])
    insert_rows(spread_out, spark.createDataFrame([(9001, 0.5, "new one / with = signs")], "k long, v double, p string"))
    insert_rows(spread_out, spark.createDataFrame([(9002, 0.5, None)], "k long, v double, p string"))
    assert 3 <= index.refresh() <= 6 and index.refresh() == 0
    asked = spark.createDataFrame([(9001, "NEW ONE / WITH = SIGNS")], "k long, u string")
    assert ("new one / with = signs",) in index.partitions_with(asked) and len(index.partitions_with(asked)) <= 4
    known = {r["__file"]: r for r in index.files().collect()}
    for r in spread_out.read().groupBy(F.col(FILE).alias("f")).agg(F.min("k"), F.max("k"), F.min("v"), F.max("v"), F.count("*")).collect():
        row = known[r["f"]]
        assert (row["low_0"], row["high_0"], row["low_1"], row["high_1"], row["__rows"]) == tuple(r)[1:]


def test_large_batches_ask_no_filter(spark, spread_out):
    """Beyond as many comparisons as the table has rows, the keys are read."""
    index = FileIndex(spread_out, ("k",))
    every = spark.range(8000).select(F.col("id").alias("k"))
    assert index.files_with(every).count() == spread_out.read().select(FILE).distinct().count()


def test_an_empty_table_has_no_files(spark, make_table):
    table = make_table(SCHEMA)
    index = FileIndex(table, ("k",), ("v",))
    assert index.refresh() == 0 and index.files_with(spark.range(3)).count() == 0 and index.lookup({"v": (0.0, None)}).count() == 0
    insert_rows(table, spark.createDataFrame([(1, 0.5, "a")], "k long, v double, p string"))
    assert index.lookup({"v": (None, 1.0)}).count() == 1 and index.lookup({"v": (0.6, None)}).count() == 0
    with pytest.raises(ValueError):
        index.lookup({"k": (1, 1)})


USER = ChangeTable(("id",), "at", "gone", fields("id string,name string,day date,at timestamp_ntz,gone timestamp_ntz"), partition="day")


def users(spark, *data):
    df = spark.createDataFrame(list(data), "id string, name string, day string, at string, gone string")
    return df.select("id", "name", F.col("day").cast("date"), F.col("at").cast("timestamp_ntz"), F.col("gone").cast("timestamp_ntz"))


def test_merge_with_an_index_is_the_same_merge(spark, make_table):
    base = users(spark, *[(str(i), "old", f"2024-01-{i % 25 + 1:02d}", "2024-01-01", None) for i in range(200)])
    changes = users(spark, ("3", "new", "2024-02-01", "2024-02-01", None), ("44", "x", "2024-01-20", "2024-02-01", "2024-02-01"),
                    ("999", "born", "2024-01-02", "2024-02-01", None), (None, "no key", "2024-01-02", "2024-02-01", None))
    results = []
    for indexed in (False, True):
        table = make_table(USER.schema, partition_by=("day",))
        table.overwrite(base)
        index = FileIndex(table, ("id",)) if indexed else None
        merge_table(table, changes, soft_delete(USER, on=("id",)), index=index)
        merge_table(table, changes.where("id is not null").withColumn("name", F.lit("again")), hard_delete_guarded(USER), index=index)
        results.append(rows(table.read()))
    assert results[0] == results[1] and len(results[0]) == 201
    with pytest.raises(ValueError, match="index"):
        merge_table(table, changes, soft_delete(USER, on=("id",)), index=FileIndex(table, ("name",)))


def test_only_files_that_may_hold_a_key_are_opened(spark, spread_out):
    index = FileIndex(spread_out, ("k",))
    found = index.files_with(spark.createDataFrame([(77,)], "k long"))
    assert files_opened(index.rows_in(found).where("k = 77")) == found.count() <= 3
    assert index.rows_in(found.limit(0)).count() == 0


# --- clustering -------------------------------------------------------------------------


@pytest.fixture
def plane(spark):
    """Points of a plane, a third of them in one place, some without a place."""
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("k"),
        F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 101 == 0, None).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000).alias("v"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("p"))


def test_files_of_a_clustered_table_are_skipped_by_either_column(spark, make_table, plane):
    table = make_table(SCHEMA, partition_by=("p",), cluster_by=("k", "v"))
    overwrite_clustered(table, plane, pieces=32)
    assert rows(table.read().select("k", "v", "p")) == rows(plane)
    index = FileIndex(table, bounds=("k", "v"))
    files = table.read().select(FILE).distinct().count()
    assert files >= 32
    for ranges, test in (({"k": (100, 110)}, "k between 100 and 110"), ({"v": (0.2, 0.21)}, "v between 0.2 and 0.21"),
                         ({"k": (100, 200), "v": (0.7, 0.8)}, "k between 100 and 200 and v between 0.7 and 0.8"), ({"k": (2000, None)}, "k >= 2000"),
                         ({"k": (None, 40)}, "k <= 40"), ({"k": (500, 500), "v": (0.5, 0.5)}, "k = 500 and v = 0.5")):
        found = index.lookup(ranges)
        assert files_opened(found) <= 0.5 * files and rows(found) == rows(table.read().where(test))
    both = index.lookup({"k": (100, 130), "v": (0.7, 0.74)})
    assert files_opened(both) <= 0.2 * files


def test_a_value_of_a_third_of_the_rows_is_split(spark, make_table, plane):
    table = make_table(SCHEMA, cluster_by=("k", "v"))
    sizes = [r["n"] for r in clustered(table, plane, pieces=12).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) > 1000  # its rows are equal in every column here
    numbered = plane.withColumn("p", F.monotonically_increasing_id().cast("string"))
    sizes = [r["n"] for r in clustered(table, numbered, pieces=12).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 1000


def test_reclustering_gathers_small_files(spark, make_table, plane):
    table = make_table(SCHEMA, partition_by=("p",), cluster_by=("k",))
    for part in plane.randomSplit([1.0] * 6, 5):
        insert_rows(table, part)
    before = table.read().select(FILE).distinct().count()
    untouched = {r[0] for r in table.only([("odd",)]).select(FILE).distinct().collect()}
    recluster(table, [("even",)], pieces=2)
    assert rows(table.read().select("k", "v", "p")) == rows(plane) and table.read().select(FILE).distinct().count() < before
    assert {r[0] for r in table.only([("odd",)]).select(FILE).distinct().collect()} == untouched
    recluster(make_table(SCHEMA, partition_by=("p",), cluster_by=("k",)))
    with pytest.raises(ValueError):
        clustered(make_table(SCHEMA), plane)


def test_z_values_keep_near_rows_near(spark):
    grid = spark.range(64 * 64).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).cast("string").alias("y0")).withColumn("y", F.lpad("y0", 2, "0"))
    values = grid.select("x", "y", z_value(grid, ("x", "y"), bits=3, sample=4096).alias("z"))
    squares = values.groupBy("z").agg(F.min("x"), F.max("x"), F.min(F.col("y").cast("int")), F.max(F.col("y").cast("int"))).collect()
    assert len(squares) == 64 and all(r[2] - r[1] <= 9 and r[4] - r[3] <= 9 for r in squares)
    empty = grid.limit(0)
    assert empty.select(z_value(empty, ("x", "y"))).count() == 0
    with pytest.raises(ValueError):
        z_value(grid, ("x",) * 20)


# --- moments ----------------------------------------------------------------------------

EVENT = ChangeTable(("a", "b"), "at", "gone", fields("a string,b int,at timestamp_ntz,gone timestamp_ntz,note string"))
START = datetime(2024, 1, 1)


def history_of(spark, seed, count=400):
    pick = random.Random(seed)
    data = []
    for _ in range(count):
        at = None if pick.random() < 0.03 else START + timedelta(hours=pick.randrange(24 * 12), microseconds=pick.choice([0, 1]))
        data.append((pick.choice(["x", "y", "z", None]), pick.choice([1, 2, 3, None]), at, at if pick.random() < 0.2 else None, pick.choice(["p", "q", None])))
    return spark.createDataFrame(data, "a string, b int, at timestamp, gone timestamp, note string").selectExpr(
        "a", "b", "cast(at as timestamp_ntz) at", "cast(gone as timestamp_ntz) gone", "note")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_many_moments_are_the_single_ones(spark, seed):
    history = history_of(spark, seed)
    moments = [START + timedelta(hours=h, microseconds=m) for h, m in ((-5, 0), (0, 0), (13, 1), (13, 0), (100, 0), (170, 0), (24 * 12, 0), (9999, 0))]
    frame = spark.createDataFrame([(str(m),) for m in [*moments, moments[2]]] + [(None,)], "moment string").select(F.col("moment").cast("timestamp_ntz"))
    got = as_of_many(history, EVENT, frame)
    for m in moments:
        want = as_of(history, EVENT, str(m))
        assert rows(got.where(F.col("moment") == F.lit(str(m)).cast("timestamp_ntz")).select(*want.columns)) == rows(want)
    assert got.select("moment").distinct().count() <= len(moments)
    assert as_of_many(history, EVENT, frame.limit(0)).count() == 0 and as_of_many(history.limit(0), EVENT, frame).count() == 0


def test_validity_tiles_the_time_of_a_key(spark):
    spans = validity(history_of(spark, 7), EVENT).orderBy("a", "b", "valid_from", F.col("valid_to").asc_nulls_last()).collect()
    by_key = {}
    for r in spans:
        by_key.setdefault((r.a, r.b), []).append(r)
    for versions in by_key.values():
        assert versions[-1].valid_to is None
        assert all(x.valid_to == y.valid_from for x, y in zip(versions, versions[1:], strict=False))
    with pytest.raises(ValueError):
        validity(history_of(spark, 7).withColumn("valid_to", F.lit(1)), EVENT)


def test_instants_and_dates_as_versions(spark):
    change = ChangeTable(("k",), "at", "gone", fields("k int,at timestamp,gone timestamp"))
    history = spark.sql("select 1 k, timestamp'2024-03-10T06:30:00Z' at, cast(null as timestamp) gone union all select 1, timestamp'2024-03-10T09:30:00Z', null")
    moments = spark.sql("select explode(array(timestamp'2024-03-10T06:29:59Z', timestamp'2024-03-10T07:00:00Z', timestamp'2024-03-11T07:00:00Z')) moment")
    assert as_of_many(history, change, moments).count() == 2
    days = spark.sql("select 1 k, date'2024-03-10' at, cast(null as date) gone union all select 1, date'2024-03-12', null")
    found = as_of_many(days, ChangeTable(("k",), "at", "gone", days.schema), spark.sql("select date'2024-03-11' moment"))
    assert [str(r["at"]) for r in found.collect()] == ["2024-03-10"]


def test_states_of_a_deleted_row(spark):
    df = spark.createDataFrame([("1", "2024-01-10 12:00:00"), ("2", None)], "id string, gone string").withColumn("gone", F.col("gone").cast("timestamp_ntz"))
    change = ChangeTable(("id",), "gone", "gone", df.schema)
    spans = lifetimes(df, change).collect()
    assert len([r for r in spans if r.id == "2"]) == 12 and {r.state for r in spans if r.id == "2"} == {"visible"}
    assert len([r for r in spans if r.id == "1" and r.kind == "native"]) == 24 and len([r for r in spans if r.id == "1" and r.kind == "managed"]) == 18
    asked = ["2024-01-10 11:59:59", "2024-01-10 12:00:00", "2024-01-12 11:59:59", "2024-01-12 12:00:00", "2024-01-19 12:00:00", "2030-01-01"]
    moments = spark.createDataFrame([(m,) for m in asked], "moment string").select(F.col("moment").cast("timestamp_ntz"))
    got = states_at(df, change, moments, hours=(48,))
    of = lambda kind: [r.state for r in got.where((F.col("kind") == kind) & (F.col("id") == "1")).orderBy("moment").collect()]
    assert of("managed") == ["visible", "recoverable", "recoverable", "gone", "gone", "gone"]
    assert of("native") == ["visible", "recoverable", "recoverable", "fail_safe", "gone", "gone"]
    assert got.groupBy("id", "kind", "moment").count().where("count <> 1").count() == 0
    for wrong in ((24,), (50,), (192,)):
        with pytest.raises(ValueError):
            lifetimes(df, change, hours=wrong)
    with pytest.raises(ValueError):
        at_moments(lifetimes(df, change).withColumn("moment", F.lit(1)), moments)


def test_each_span_is_moved_as_often_as_it_is_found(spark):
    """Days without moments cost nothing, however long a span is."""
    spans = spark.sql("select id, timestamp_ntz'2000-01-01 00:00:00' valid_from, cast(null as timestamp_ntz) valid_to from range(50)")
    moments = spark.sql("select explode(array(timestamp_ntz'2000-01-01 00:00:00', timestamp_ntz'2024-06-01 10:00:00', timestamp_ntz'2024-06-01 11:00:00')) moment")
    found = at_moments(spans, moments)
    assert found.count() == 150 and by_day("valid_from").rule == "day"


# --- buckets ----------------------------------------------------------------------------

ROW = ChangeTable(("id",), "at", "gone", fields("id string,name string,day date,at timestamp_ntz,gone timestamp_ntz"))


@pytest.fixture
def by_key(spark, folder):
    table = create_bucketed(spark, f"b_{uuid.uuid4().hex[:10]}", ROW.schema, folder(), ("id",), 6)
    table.overwrite(users(spark, *[(str(i), "old", "2024-01-01", "2024-01-01", None) for i in range(500)]))
    return table


def test_a_bucketed_merge_is_the_same_merge(spark, by_key, make_table):
    plain = make_table(ROW.schema)
    plain.overwrite(by_key.read())
    changes = users(spark, ("3", "new", "2024-02-01", "2024-02-01", None), ("44", "x", "2024-01-20", "2024-02-01", "2024-02-01"),
                    ("999", "born", "2024-01-02", "2024-02-01", None), (None, "no key", "2024-01-02", "2024-02-01", None))
    for spec in (hard_delete_guarded(ROW), soft_delete(ROW), hard_delete_guarded(ROW, guard_version=True)):
        for table in (plain, by_key):
            (table.merge(changes, spec) if table is by_key else merge_table(plain, changes, spec))
        assert rows(by_key.read()) == rows(plain.read())
    by_key.merge(changes.limit(0), soft_delete(ROW))
    assert rows(by_key.read()) == rows(plain.read())
    with pytest.raises(Exception, match="several rows"):
        by_key.merge(changes.unionByName(changes), soft_delete(ROW))
    with pytest.raises(ValueError, match="bucketed by"):
        by_key.merge(changes, soft_delete(ROW, on=("id", "day")))
    assert rows(by_key.read()) == rows(plain.read())


def test_a_bucketed_table_is_not_exchanged(spark, by_key):
    batch = users(spark, *[(str(i), "new", "2024-02-01", "2024-02-01", None) for i in range(400, 600)])
    by_key.merge(batch, hard_delete_guarded(ROW))
    merged = by_key.merged(batch, hard_delete_guarded(ROW), unique_source=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # The only exchange is the batch's, into as many tasks as there are buckets.
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 1 and "hashpartitioning(__s0" in plan and ", 6)" in plan
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 6 out of 6" in plan
    files = {r[0].rsplit("/", 1)[1] for r in by_key.read().select(FILE).distinct().collect()}
    assert len(files) == 6 and by_key.read().count() == 600


def test_an_empty_bucketed_table(spark, folder):
    table = create_bucketed(spark, f"b_{uuid.uuid4().hex[:10]}", ROW.schema, folder(), ("id",), 3)
    assert table.read().count() == 0
    table.merge(users(spark, ("1", "a", "2024-01-01", "2024-01-01", None), ("2", "b", "2024-01-01", "2024-01-01", "2024-01-01")), hard_delete_guarded(ROW))
    assert [r.id for r in table.read().collect()] == ["1"]
    for wrong in ({"keys": ("nope",), "buckets": 2}, {"keys": (), "buckets": 2}, {"keys": ("id",), "buckets": 0}):
        with pytest.raises(ValueError):
            create_bucketed(spark, "never", ROW.schema, folder(), **wrong)
