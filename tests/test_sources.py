from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import explained, fields, rows
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.history import as_of, expired, latest_state
from tidemark.functions.scalars import range_bucket
from tidemark.functions.timewin import instant_literal
from tidemark.functions.types import source_type
from tidemark.model import ChangeTable
from tidemark.sinks.files import batch_name, export_dated, export_micros
from tidemark.sources.extract import extract_between, extract_day, extract_previous_day, extract_recent
from tidemark.sources.files import export_folder, scan_dated, scan_dated_by_filter, scan_glob, scan_hive, scan_hive_repaired
from tidemark.sources.jdbc import FETCH_SIZE, jdbc_options, read_table, window_predicates
from tidemark.sources.footers import _Stores, store_of
from tidemark.sources.json_rows import json_to_rows, rows_to_json
from tidemark.sources.ranges import quantile_ranges

RUN_END = datetime(2024, 1, 10, 18, tzinfo=UTC)


def stamped(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("at"))


def test_missing_path_is_an_error(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_glob(spark, f"{folder()}/*.parquet")


def test_hive_folders_of_the_wrong_type_are_never_opened(spark, folder):
    path = folder()
    spark.createDataFrame([(1, "2024"), (2, "null"), (3, "2025")], "k int, y string").write.partitionBy("y").parquet(path)
    with pytest.raises(Exception, match="INVALID_PARTITION_VALUE"):
        scan_hive(spark, path, fields("k int"), {"y": T.LongType()}).collect()
    good = scan_hive_repaired(spark, path, fields("k int"), {"y": T.LongType()})
    assert rows(good) == [(1, 2024), (3, 2025)]
    assert "PartitionFilters: [isnotnull(try_cast" in explained(good) or "PartitionFilters: [isnotnull" in explained(good)


def test_partition_filter_and_columns_reach_the_scan(spark, folder):
    path = folder()
    spark.range(10).selectExpr("id", "id * 2 as x", "id % 3 as p").write.partitionBy("p").parquet(path)
    plan = explained(scan_hive(spark, path, fields("id bigint,x bigint"), {"p": T.LongType()}).where("p = 1 and x > 3").select("x"))
    assert "PartitionFilters: [isnotnull(p" in plan and "GreaterThan(x,3)" in plan and "ReadSchema: struct<x:bigint>" in plan


def test_closed_and_half_open_window(spark):
    df = stamped(spark, "2024-01-09 23:59:59.9", "2024-01-10 00:00:00", "2024-01-10 23:59:59", "2024-01-10 23:59:59.5", "2024-01-11 00:00:00")
    assert extract_previous_day(df, "at", RUN_END, closed="both").count() == 2
    assert extract_previous_day(df, "at", RUN_END).count() == 3
    assert extract_day(df, "at", date(2024, 1, 10)).count() == 3
    with pytest.raises(ValueError):
        extract_between(df, "at", RUN_END, RUN_END, closed="right")


def test_windows_over_instants_are_utc(spark):
    df = spark.sql("select explode(array(timestamp'2024-01-10T00:00:00Z', timestamp'2024-01-10T23:59:59Z', timestamp'2024-01-11T00:00:00Z')) at")
    assert extract_day(df, "at", date(2024, 1, 10)).count() == 2


def test_extract_predicates_are_pushed_down(spark, folder):
    path = folder()
    stamped(spark, "2024-01-10 01:00:00").write.parquet(path)
    source = spark.read.parquet(path)
    for df in (extract_previous_day(source, "at", RUN_END), extract_day(source, "at", date(2024, 1, 10)), extract_recent(source, "at", RUN_END)):
        assert "GreaterThanOrEqual(at,2024-01-" in explained(df)
        assert df.count() == 1


def test_lookback(spark):
    df = stamped(spark, "2024-01-09 00:59:59", "2024-01-09 01:00:00")
    assert extract_recent(df, "at", RUN_END).count() == 1


def test_jdbc_reads_are_split_without_gaps_or_overlaps():
    start, end = datetime(2024, 1, 10, 0, 0, 0, 500_000), datetime(2024, 1, 11)
    parts = window_predicates("updated_at", start, end, 4)
    assert parts == [
        "updated_at >= '2024-01-10 00:00:00.500000' AND updated_at < '2024-01-10 06:00:00'",
        "updated_at >= '2024-01-10 06:00:00' AND updated_at < '2024-01-10 12:00:00'",
        "updated_at >= '2024-01-10 12:00:00' AND updated_at < '2024-01-10 18:00:00'",
        "updated_at >= '2024-01-10 18:00:00' AND updated_at < '2024-01-11 00:00:00'",
    ]
    assert window_predicates("c", end, end, 8, closed="both") == ["c >= '2024-01-11 00:00:00' AND c <= '2024-01-11 00:00:00'"]
    with pytest.raises(ValueError):
        window_predicates("c", end, start, 1)
    options = jdbc_options("jdbc:mysql://h/db", "users", user="u")
    assert options["fetchsize"] == str(FETCH_SIZE) and options["preferTimestampNTZ"] == "true" and options["user"] == "u"


def test_batch_names():
    end = datetime(2026, 8, 31, 17, tzinfo=UTC)
    assert batch_name("users", end, True) == "batch_users_full_load" != batch_name("orders", end, True)
    assert batch_name("users", end, False) == "batch_users_20260831"
    assert batch_name("users", end, False, label="incremental_") == "batch_users_incremental_20260831"
    assert export_folder("s3://b/data/", "20260901") == "s3://b/data/export_20260901"


def test_export_is_microseconds_and_empty_batches_write_nothing(spark, folder):
    import pyarrow.parquet as pq

    path = folder()
    df = spark.sql("select timestamp'2024-01-01T00:00:00.123456Z' at, timestamp_ntz'2024-01-01 00:00:00.123456' civil")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    assert export_micros(df, path)
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    schema = pq.read_schema(df.sparkSession.read.parquet(path).inputFiles()[0].removeprefix("file:").replace("//", ""))
    assert str(schema.field("at").type) == "timestamp[us, tz=UTC]" and str(schema.field("civil").type) == "timestamp[us]"
    assert not export_micros(df.where("at is null"), folder())


def test_dated_export_replaces_its_folder(spark, folder):
    root, schema = folder(), fields("k string")
    for value in ("old", "new"):
        written = export_dated(spark.createDataFrame([(value,)], "k string"), root, RUN_END, schema)
    assert written.endswith("export_20240111")
    assert rows(scan_dated(spark, root, RUN_END, schema=schema)) == [("new",)]
    assert rows(scan_dated_by_filter(spark, root, "20240111", schema)) == [("new",)]
    assert scan_dated_by_filter(spark, root, "20240112", schema).count() == 0
    assert export_dated(spark.createDataFrame([], "k string"), root, RUN_END, schema) is None


def test_nanosecond_files_are_refused(spark, folder):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    path = folder().removeprefix("file:")
    os.makedirs(path)
    pq.write_table(pa.table({"t": pa.array([1], pa.timestamp("ns"))}), f"{path}/n.parquet", version="2.6")
    with pytest.raises(Exception, match="PARQUET_TYPE_ILLEGAL|Illegal Parquet type"):
        spark.read.parquet(path).collect()


def test_json_round_trip_keeps_every_value(spark):
    schema = fields("id bigint,name string,at timestamp_ntz,seen timestamp,x double,ok boolean")
    df = spark.sql("""select * from values
        (1L, 'q"uo\\te, [x]', timestamp_ntz'2024-01-01 10:00:00.123456', timestamp'2024-01-01T10:00:00Z', 0.1D, true),
        (2L, null, null, null, null, null), (3L, '{"a": [1]}', timestamp_ntz'1999-12-31 23:59:59', null, -1e300D, false)
        t(id, name, at, seen, x, ok)""")
    packed = rows_to_json(df, array_rows=2)
    assert packed.count() >= 2
    assert rows(json_to_rows(packed, "payload", schema)) == rows(df)


def test_json_arrays_stay_short_for_any_input(spark):
    df = spark.range(0, 10_000, 1, 2).selectExpr("id", "'x' as s")
    packed = rows_to_json(df, array_rows=500)
    assert packed.select(F.size(F.from_json("payload", "array<string>")).alias("n")).agg(F.max("n")).first()[0] == 500
    assert packed.count() == 20


def test_json_instants_may_carry_a_zone(spark):
    payload = spark.createDataFrame([('[{"at": "2024-01-01T10:00:00+07:00"}, {"at": "2024-01-01 03:00:00"}, {"at": null}, {"at": "2024-01-02"}]',)], "p string")
    out = json_to_rows(payload, "p", fields("at timestamp")).select(F.unix_seconds("at"))
    assert rows(out) == sorted([(1704078000,), (1704078000,), (None,), (1704153600,)], key=repr)


def test_json_text_that_is_no_instant_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        json_to_rows(spark.createDataFrame([('[{"at": "soon"}]',)], "p string"), "p", fields("at timestamp_ntz")).collect()


def test_latest_per_key_is_repeatable(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 1, "m"), (None, 5, "p"), (None, 6, "q")],
                               "k string, v int, s string")
    want = rows(spark.createDataFrame([("a", 2, "z"), ("b", 1, "m"), (None, 6, "q")], df.schema))
    for n in (1, 3, 7):
        assert rows(latest_per_key(df.repartition(n), ("k",), "v")) == want


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 6).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    latest = latest_per_key(df, ("k",), "v")
    tree = explained(latest).split("(1)")[0]
    # One limit below the exchange, one above it.
    assert tree.index("WindowGroupLimit") < tree.index("Exchange") < tree.rindex("WindowGroupLimit")
    assert latest.count() == 20_001
    assert latest.where("k = 0").first().v == 29_997


CHANGE = ChangeTable(("k",), "at", "gone", fields("k string,at timestamp_ntz,gone timestamp_ntz"))


def history(spark):
    data = [("a", "2024-01-01", None), ("a", "2024-01-03", "2024-01-03"), ("b", "2024-01-02", None), ("b", "2024-01-04", None)]
    df = spark.createDataFrame(data, "k string, at string, gone string")
    return df.select("k", F.col("at").cast("timestamp_ntz"), F.col("gone").cast("timestamp_ntz"))


def test_as_of(spark):
    at = lambda t: [(r.k, str(r["at"])[:10]) for r in as_of(history(spark), CHANGE, t).orderBy("k").collect()]
    assert at("2023-12-31 00:00:00") == []
    assert at("2024-01-02 00:00:00") == [("a", "2024-01-01"), ("b", "2024-01-02")]
    assert at(datetime(2024, 1, 3, 12)) == [("b", "2024-01-02")]
    assert rows(as_of(history(spark), CHANGE, "2999-01-01 00:00:00")) == rows(latest_state(history(spark), CHANGE))


def test_expired_rows_are_those_deleted_long_enough_ago(spark):
    df = spark.sql("""select explode(array(timestamp_ntz'2024-01-29 00:00:00', timestamp_ntz'2024-01-30 00:00:00', timestamp_ntz'2024-01-30 00:00:01',
        timestamp_ntz'2024-02-02 00:00:00', null)) gone""")
    assert [str(r[0]) for r in expired(df, CHANGE, "2024-02-01 00:00:00", 48).orderBy("gone").collect()] == ["2024-01-29 00:00:00", "2024-01-30 00:00:00"]


def test_stores_of_footers():
    assert store_of("s3a://lake/a%20b/x.parquet", {"region": "eu"}) == ("s3://lake/?region=eu", "/a b/x.parquet")
    assert store_of("hdfs://name:8020/a/x.parquet", {}) == ("hdfs://name:8020/", "/a/x.parquet")
    assert store_of("file:/tmp/x%3D1/f.parquet", {}) == store_of("file:///tmp/x%3D1/f.parquet", {}) == ("file:///", "/tmp/x=1/f.parquet")


def test_footer_stores_are_opened_once():
    stores = _Stores({})
    first, other = stores.find("file:/tmp/a%20b.parquet"), stores.find("file:///tmp/c.parquet")
    assert first[0] is other[0] and (first[1], other[1]) == ("/tmp/a b.parquet", "/tmp/c.parquet")


def test_times_with_a_zone_are_converted(spark):
    from datetime import timedelta, timezone

    jakarta = datetime(2024, 1, 10, 7, tzinfo=timezone(timedelta(hours=7)))
    df = spark.sql("select timestamp'2024-01-10T00:00:00Z' z, timestamp_ntz'2024-01-10 00:00:00' n")
    for c in ("z", "n"):
        assert df.where(F.col(c) == instant_literal(jakarta, df.schema[c].dataType)).count() == 1


def test_range_bucket_is_arithmetic(spark):
    df = spark.sql("select explode(array(-1, 0, 4, 5, 9, 10, 11, 99, null)) x")
    want = [0, 1, 1, 2, 2, 3, 3, 3, None]
    bucket = range_bucket(F.col("x"), 0, 11, 5)
    assert [r[0] for r in df.select(bucket).collect()] == want
    assert "lambda" not in explained(df.select(bucket))


def test_source_types_by_name():
    assert [source_type(t) for t in ("LONGTEXT", "BOOLEAN", "DATETIME2", "datetime2(7)")] == ["string", "boolean", "timestamp", "timestamp"]


def test_nested_maps_are_not_ordered(spark):
    df = spark.sql("select 1 k, 2 v, struct(map('a', 1) m) s, array(map('b', 2)) a union all select 1, 1, struct(map('a', 2)), array(map('c', 1))")
    assert [r.v for r in latest_per_key(df, ("k",), "v").collect()] == [2]


def test_one_connection_has_to_be_asked_for(spark):
    for options in ({}, {"split_on": "id", "splits": 4}, {"split_on": "id", "lower": 0, "upper": 9}, {"split_on": "id", "lower": 0, "upper": 9, "splits": 4, "one_task": True}):
        with pytest.raises(ValueError):
            read_table(spark, "jdbc:none", "t", ("id",), **options)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "int"])
def test_quantile_ranges_take_every_row_once(spark, kind):
    """Four fifths of the rows share ten values, some have none; ranges cut from a third of the rows hold for all of them."""
    made = {"timestamp_ntz": "timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(0, 0, 0, v)", "timestamp": "timestamp'2024-03-10T06:59:00Z' + make_dt_interval(0, 0, 0, v)",
            "date": "date_add(date'2024-01-01', v)", "int": "v"}[kind]
    rows_ = spark.range(6000).selectExpr("id", "case when id % 97 = 0 then null when id % 5 <> 0 then cast(id % 10 as int) else cast(100 + id % 977 as int) end v")
    rows_ = rows_.selectExpr("id", f"{made} at")
    cut = quantile_ranges(rows_.where("id % 3 = 0"), "at", 40, tie="id")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # as a database reads its own literals
    try:
        parts = cut.predicates(within="id >= 0")
        numbered = rows_.withColumn("n", cut.number(rows_))
        sizes = {r["n"]: r["count"] for r in numbered.groupBy("n").count().collect()}
        for first in range(0, len(parts), 10):
            some = dict(list(enumerate(parts))[first:first + 10])
            found = numbered.agg(*[F.count_if(F.expr(p)).alias(f"all{n}") for n, p in some.items()],
                                 *[F.count_if(F.expr(p) & (F.col("n") == n)).alias(f"own{n}") for n, p in some.items()]).collect()[0]
            assert all(found[f"all{n}"] == found[f"own{n}"] == sizes.get(n, 0) for n in some)
        assert sum(sizes.values()) == 6000 and max(sizes) < len(parts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(sizes) >= 40 and max(sizes.values()) < 2 * 6000 / len(sizes)


def test_ranges_of_little(spark):
    empty = spark.createDataFrame([], "id long, at timestamp_ntz")
    assert len(quantile_ranges(empty, "at", 8, tie="id").predicates()) == 1
    one = spark.sql("select 1L id, timestamp_ntz'2024-01-01 00:00:00' at")
    for splits, tie in ((1, None), (5, None), (5, "id")):
        parts = quantile_ranges(one, "at", splits, tie).predicates()
        assert sum(one.where(p).count() for p in parts) == 1
    assert quantile_ranges(one, "at", 2).predicates()[1] == "(at >= '2024-01-01 00:00:00')"
    with pytest.raises(ValueError):
        quantile_ranges(one, "at", 0)
    with pytest.raises(TypeError):
        quantile_ranges(one.selectExpr("cast(id as string) at"), "at", 2)
