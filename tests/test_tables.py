import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import explained, fields, rows
from tidemark.operators.dml import delete_table, insert_rows, update, update_table
from tidemark.operators.storage import footprint, retained_files, storage_report
from tidemark.sources.files import active_files, file_inventory
from tidemark.tables import by_day, by_month, by_range, create_table, open_table, partition_filter

SCHEMA = fields("k int, v double, p string")


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k int, v double, p string")


def test_create_is_idempotent_and_open_knows_the_layout(spark, make_table):
    table = make_table(SCHEMA, partition_by=("p",), cluster_by=("k", "v"))
    again = create_table(spark, table.name, SCHEMA, table.root, partition_by=("p",), cluster_by=("k", "v"))
    assert again == table == open_table(spark, table.name)
    assert table.is_empty() and table.partitions() == []
    with pytest.raises(ValueError):
        make_table(SCHEMA, partition_by=("nope",))


@pytest.mark.parametrize("value", ["plain", "a b", "x/y", "50%", "q'uote", "k=v", None, "ü:ñ"])
def test_text_partitions_survive_a_replacement(spark, make_table, value):
    table = make_table(SCHEMA, partition_by=("p",))
    table.overwrite(frame(spark, (1, 1.0, value), (2, 2.0, "rest")))
    table.replace_partitions(frame(spark, (3, 3.0, value)), [(value,)])
    assert rows(table.read()) == rows(frame(spark, (3, 3.0, value), (2, 2.0, "rest")))
    assert set(table.partitions()) == {(value,), ("rest",)}


def test_two_partition_columns(spark, make_table):
    table = make_table(fields("k int, p string, d date"), partition_by=("p", "d"))
    data = spark.sql("select * from values (1,'a',date'2024-01-01'),(2,'a',null),(3,'b',date'2024-01-02') t(k,p,d)")
    table.overwrite(data)
    assert [r.k for r in table.only([("a", None), ("b", __import__("datetime").date(2024, 1, 2))]).orderBy("k").collect()] == [2, 3]
    table.replace_partitions(data.where("k = 2").withColumn("k", F.lit(9)), [("a", None), ("b", __import__("datetime").date(2024, 1, 2))])
    assert [r.k for r in table.read().orderBy("k").collect()] == [1, 9]


def test_replaced_files_stay_until_cleaned_up(spark, make_table):
    table = make_table(SCHEMA, partition_by=("p",))
    table.overwrite(frame(spark, *[(i, float(i), "ab"[i % 2]) for i in range(100)]))
    before = footprint(file_inventory(spark, table.root)).first()
    assert retained_files(table).count() == 0
    delete_table(table, "k = 0")
    report = storage_report(table).first()
    assert report.rows == 99 and report.retained_files == 1
    assert report.active_files == active_files(table).count() == 2
    assert report.active_bytes + report.retained_bytes > before.bytes
    delete_table(table, "p = 'a'")
    assert table.partitions() == [("b",)] and retained_files(table).count() == 2


@pytest.mark.parametrize("layout", [{}, {"partition_by": ("p",)}])
def test_create_or_replace_starts_empty(spark, make_table, layout):
    table = make_table(SCHEMA, **layout)
    insert_rows(table, frame(spark, (1, 1.0, "a")))
    table.overwrite(frame(spark, (2, 2.0, "b")))
    fresh = create_table(spark, table.name, SCHEMA, table.root, replace=True, **layout)
    assert fresh.is_empty()
    insert_rows(fresh, frame(spark, (3, 3.0, "a")))
    assert rows(fresh.read()) == [(3, 3.0, "a")]
    present = {r.path for r in file_inventory(spark, fresh.root).collect()}
    active = {r.path for r in active_files(fresh).collect()}
    retained = {r.path for r in retained_files(fresh).collect()}
    held = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(*retained)
    assert active | retained == present and not active & retained
    assert sorted(r.k for r in held.collect()) == [1, 2]


def test_failed_write_leaves_the_table_as_it_was(spark, make_table):
    table = make_table(SCHEMA, partition_by=("p",))
    table.overwrite(frame(spark, (1, 1.0, "a")))
    broken = frame(spark, (2, 2.0, "a")).withColumn("v", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        table.overwrite(broken)
    assert rows(table.read()) == [(1, 1.0, "a")]


def test_unpartitioned_overwrite_switches_the_location(spark, make_table):
    table = make_table(SCHEMA)
    table.overwrite(frame(spark, (1, 1.0, "a")))
    table.overwrite(table.read().union(frame(spark, (2, 2.0, "b"))))
    assert table.read().count() == 2 and open_table(spark, table.name).root == table.root


def test_append_batch_is_idempotent(spark, make_history):
    history = make_history(SCHEMA)
    for _ in range(2):
        history.append_batch(frame(spark, (1, 1.0, "a")), "one")
    history.append_batch(frame(spark, (2, 2.0, "b")), "two")
    assert sorted((r.k, r.batch_id) for r in history.read().collect()) == [(1, "one"), (2, "two")]
    # A rerun that finds nothing any more takes nothing away.
    assert not history.append_batch(frame(spark, (1, 1.0, "a")).where("k = 0"), "one")
    assert sorted(r.k for r in history.read().collect()) == [1, 2]


def test_a_rerun_adds_what_the_batch_lacks(spark, make_table):
    """Other versions of a key, and rows with nulls, stay beside each other; equal rows come once more never."""
    from tidemark.tables import with_batch

    schema = fields("k int, at timestamp_ntz, v double")
    history = make_table(with_batch(schema), partition_by=("batch_id", "day"), derived={"day": by_day("at")})
    run = lambda *data: spark.createDataFrame(list(data), "k int, at string, v double").withColumn("at", F.col("at").cast("timestamp_ntz"))
    first = run((1, "2024-01-01 10:00:00.000001", 1.0), (1, "2024-01-01 10:00:00.000002", 1.0), (2, None, None), (2, None, None), (None, "2024-01-02", float("nan")))
    assert history.append_batch(first, "d")
    kept = {f.path for f in active_files(history).collect()}
    assert history.append_batch(first, "d") and {f.path for f in active_files(history).collect()} == kept
    assert history.append_batch(run((1, "2024-01-01 10:00:00.000002", 2.0), (3, "2024-01-03", 3.0)), "d")
    assert history.append_batch(first.where("k = 1"), "d")
    got = sorted(repr((r.k, str(r.at), r.v)) for r in history.read().collect())
    assert got == sorted(map(repr, [(1, "2024-01-01 10:00:00.000001", 1.0), (1, "2024-01-01 10:00:00.000002", 1.0), (1, "2024-01-01 10:00:00.000002", 2.0), (2, "None", None),
                          (2, "None", None), (3, "2024-01-03 00:00:00", 3.0), (None, "2024-01-02 00:00:00", float("nan"))]))
    # Only the day that got a row was written again.
    assert len({f.path for f in active_files(history).collect()} & kept) == 2


def test_append_of_one_batch_is_not_shuffled(spark, make_history, folder):
    history = make_history(SCHEMA)
    laid = history.spread(history.shaped(frame(spark, (1, 1.0, "a"))), skip=("batch_id",))
    assert "Exchange" not in explained(laid)
    with pytest.raises(ValueError):
        create_table(spark, history.name + "_x", SCHEMA, folder()).append_batch(frame(spark), "b")


def test_skewed_partition_is_rebalanced_by_aqe(spark, make_table):
    plan = explained(make_table(SCHEMA, partition_by=("p",)).spread(frame(spark, (1, 1.0, "a"))))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_insert_fills_missing_columns_with_null(spark, make_table):
    table = make_table(SCHEMA, partition_by=("p",))
    table.overwrite(frame(spark, (1, 1.0, "a")))
    insert_rows(table, frame(spark, (2, 2.0, "a"), (3, 3.0, "c")).drop("v"))
    assert rows(table.read()) == rows(frame(spark, (1, 1.0, "a"), (2, None, "a"), (3, None, "c")))


def test_update_and_delete_follow_three_valued_logic(spark, make_table):
    table = make_table(SCHEMA, partition_by=("p",))
    data = frame(spark, (1, None, "a"), (2, 2.0, "a"), (3, -1.0, "b"))
    table.overwrite(data)
    delete_table(table, "v < 0")
    assert [r.k for r in table.read().orderBy("k").collect()] == [1, 2]
    update_table(table, {"v": "v + 5"}, "v > 0")
    update_table(table, {"v": "1"}, "v IS NULL")
    assert rows(table.read().select("k", "v")) == [(1, 1.0), (2, 7.0)]
    with pytest.raises(ValueError):
        update_table(table, {"p": "'z'"}, "k = 1")


def test_update_reads_old_values(spark):
    swapped = update(frame(spark, (1, 2.0, "a")), {"k": "v", "v": "k"}, "true")
    assert rows(swapped) == [(2, 1.0, "a")]
    with pytest.raises(ValueError, match="nope"):
        update(frame(spark, (1, 2.0, "a")), {"nope": "1"}, "true")


def test_update_rewrites_only_matching_partitions(spark, make_table):
    table = make_table(SCHEMA, partition_by=("p",))
    table.overwrite(frame(spark, (1, 1.0, "a"), (2, 2.0, "b")))
    kept = table.read().where("p = 'b'").select("_metadata.file_path").first()[0]
    update_table(table, {"v": "9"}, "k = 1")
    assert table.read().where("p = 'b'").select("_metadata.file_path").first()[0] == kept


def test_add_columns_twice_adds_once(spark, make_table):
    table = make_table(SCHEMA, partition_by=("p",))
    table.overwrite(frame(spark, (1, 1.0, "a")))
    fields = [T.StructField("z", T.LongType()), T.StructField("K", T.LongType())]
    assert [f.name for f in table.add_columns(fields)] == ["z"]
    assert table.add_columns(fields) == []
    assert table.read().first().z is None


def test_derived_partitions(spark, make_table):
    schema = fields("k int, at timestamp, civil timestamp_ntz, n int")
    table = make_table(schema, partition_by=("day", "month", "bucket"), derived={
        "day": by_day("at"), "month": by_month("civil"), "bucket": by_range("n", 1, 12)})
    data = spark.sql("""select 1 k, timestamp'2024-03-10T23:30:00-05:00' at, timestamp_ntz'2024-03-31 23:59:59' civil, 13 n
                        union all select 2, null, null, null""")
    table.overwrite(data)
    first, second = table.read().orderBy("k").collect()
    # Days of instants are UTC days, whatever the session zone is.
    assert (str(first.day), str(first.month), first.bucket) == ("2024-03-11", "2024-03-01", 12)
    assert (second.day, second.month, second.bucket) == (None, None, None)
    assert open_table(spark, table.name) == table


def test_filter_on_the_source_column_prunes_derived_partitions(spark, make_table):
    table = make_table(fields("k int, d date"), partition_by=("m",), derived={"m": by_month("d")})
    table.overwrite(spark.sql("select id k, date_add(date'2024-01-01', cast(id as int)) d from range(366)").selectExpr("cast(k as int) k", "d"))
    hit = table.range("d", "2024-02-10", "2024-03-05")
    assert hit.count() == 25
    plan = explained(hit)
    assert plan.count("/m=") <= 2 and "PartitionFilters" in plan


def test_instant_ranges_prune_their_utc_day(spark, make_table):
    table = make_table(fields("k bigint,at timestamp"), partition_by=("day",), derived={"day": by_day("at")})
    table.overwrite(spark.sql("select id k, timestamp'2024-01-01T00:00:00Z' + make_dt_interval(0, cast(id as int)) at from range(240)"))
    late = table.range("at", "2024-01-09 12:00:00")
    assert late.count() == 36
    plan = explained(late)
    assert ">= 2024-01-09)]" in plan and "... 1 entries]" in plan
    assert table.range("at", "2024-01-02", "2024-01-03", closed="left").count() == 24
    assert table.range("at", None, "2024-01-01 05:00:00").count() == 6
    assert table.range("k", 10, 12).count() == 3


def test_rewrites_in_place_need_no_exchange(spark, make_table, monkeypatch):
    """Updates, deletes and small merges leave rows in the task that read them."""
    from tidemark.model import ChangeTable
    from tidemark.operators.merge import merge_table, soft_delete

    table = make_table(fields("k string,v int,p string,at int,gone int"), partition_by=("p",))
    data = spark.createDataFrame([(str(i), i, 1, None, "ab"[i % 2]) for i in range(50)], table.schema)
    table.overwrite(data)
    plans = []
    publish = table.__class__.publish
    monkeypatch.setattr(table.__class__, "publish", lambda self, df, *a: plans.append(explained(df)) or publish(self, df, *a))
    update_table(table, {"v": "-1"}, "k = '1'")
    delete_table(table, "k = '2'")
    assert all("Exchange" not in p for p in plans)
    change = ChangeTable(("k",), "at", "gone", table.schema, partition="p")
    merge_table(table, table.read().where("k < '20'").withColumn("v", F.lit(1000)), soft_delete(change), unique_source=True)
    kept = plans[-1]
    assert "BroadcastHashJoin LeftOuter" in kept and kept.count("REBALANCE") == 1
    assert table.read().count() == 49 and table.read().where("v = 1000").count() == 12


def test_partition_filter_is_balanced(spark):
    many = [(i, f"p{i}") for i in range(3000)]
    df = spark.range(3).selectExpr("cast(id as int) a", "concat('p', id) b")
    assert df.where(partition_filter(("a", "b"), many)).count() == 3
    assert df.where(partition_filter(("a",), [])).count() == 0
