from datetime import UTC, date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import fields, rows
from tidemark.functions import timewin
from tidemark.functions.scalars import json_value, range_bucket, storage_uri, version_number
from tidemark.functions.types import conform, map_type, source_type
from tidemark.operators.storage import latest_version

JAKARTA_MIDNIGHT = datetime(2026, 8, 31, 17, tzinfo=UTC)


def test_previous_day_window():
    assert timewin.previous_day_window(JAKARTA_MIDNIGHT) == (datetime(2026, 8, 31), datetime(2026, 8, 31, 23, 59, 59))
    just_before = JAKARTA_MIDNIGHT - timedelta(seconds=1)
    assert timewin.previous_day_window(just_before)[0] == datetime(2026, 8, 30)
    # The local day before a change to winter time is still one calendar day.
    berlin = datetime(2024, 10, 28, 0, tzinfo=timezone(timedelta(hours=1)))
    assert timewin.previous_day_window(berlin, "Europe/Berlin") == (datetime(2024, 10, 27), datetime(2024, 10, 27, 23, 59, 59))


def test_lookback_cutoff_is_local_wall_clock_read_as_utc():
    assert timewin.lookback_cutoff(JAKARTA_MIDNIGHT) == datetime(2026, 8, 30)
    assert timewin.lookback_cutoff(datetime(2026, 9, 1)) == datetime(2026, 8, 30, 7)


def test_batch_dates_and_epoch():
    assert timewin.batch_date(JAKARTA_MIDNIGHT) == "20260901"
    assert timewin.shifted_batch_date(JAKARTA_MIDNIGHT) == "20260901"
    assert timewin.shifted_batch_date(JAKARTA_MIDNIGHT, hours=0) == "20260831"
    assert timewin.epoch_seconds(datetime(1970, 1, 2)) == 86400


def test_naive_and_instant_round_trip_in_any_session_zone(spark):
    # 02:30 does not exist on that day in the session's zone.
    df = spark.sql("select explode(array(timestamp_ntz'2024-03-10 02:30:00.123456', timestamp_ntz'1905-01-01 00:00:00.000001', null)) t")
    back = df.select("t", timewin.naive_utc(timewin.utc_instant(F.col("t"))).alias("b"))
    assert all(r.t == r.b for r in back.collect())


@pytest.mark.parametrize("source, target", [
    (T.ByteType(), "bigint"), (T.IntegerType(), "bigint"), (T.LongType(), "bigint"), (T.FloatType(), "double"),
    (T.DoubleType(), "double"), (T.StringType(), "string"), (T.BooleanType(), "boolean"), (T.DateType(), "date"),
    (T.TimestampType(), "timestamp"), (T.TimestampNTZType(), "timestamp"), (T.DecimalType(18, 2), "decimal(18,2)"),
])
def test_map_type(source, target):
    assert map_type(source).simpleString() == target


@pytest.mark.parametrize("nested", [T.ArrayType(T.LongType()), fields("a int"), T.BinaryType()])
def test_map_type_refuses_what_no_column_takes(nested):
    with pytest.raises(ValueError):
        map_type(nested)


@pytest.mark.parametrize("name, target", [
    ("TINYINT", "bigint"), ("TINYINT(1)", "boolean"), ("VARCHAR(50)", "string"), ("DATETIME", "timestamp"),
    ("DECIMAL(15,2)", "decimal(15,2)"), ("double", "double"), ("JSON", "string"), ("BLOB", "binary"), ("BIT", "boolean"),
])
def test_source_type(name, target):
    assert source_type(name) == target


def test_source_type_refuses_too_many_digits_and_unknown_names():
    for name in ("DECIMAL(60,2)", "GEOMETRY"):
        with pytest.raises(ValueError):
            source_type(name)


def test_conform_coerces_bad_values_to_null(spark):
    raw = spark.createDataFrame(
        [("1", "1.5", "2024-01-02", "2024-01-02 03:04:05"), ("2", "x", "2024-13-02", "soon"), (None, " 7 ", None, None),
         ("4", "nan", "2024-01-02 10:00:00", "2024-01-02T03:04:05.1234567+07:00")],
        "id string, amount string, day string, at string")
    out = conform(raw, fields("id string,amount double,day date,at timestamp,extra bigint"))
    assert out.dtypes == [("id", "string"), ("amount", "double"), ("day", "date"), ("at", "timestamp"), ("extra", "bigint")]
    got = out.withColumn("at", timewin.naive_utc(F.col("at"))).collect()
    assert [r.id for r in got] == ["1", "2", None, "4"]
    assert [r.amount for r in got] == [1.5, None, 7.0, None]
    assert [r.day for r in got] == [date(2024, 1, 2), None, None, date(2024, 1, 2)]
    # Finer digits are cut off, not rounded; the zone is converted, its absence means UTC.
    assert [r.at for r in got] == [datetime(2024, 1, 2, 3, 4, 5), None, None, datetime(2024, 1, 1, 20, 4, 5, 123456)]


@pytest.mark.parametrize("text, utc", [
    ("2024-01-01", datetime(2024, 1, 1)), ("2024-01-01 10:00", datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00Z", datetime(2024, 1, 1, 10)), ("2024-01-01 10:00:00 Asia/Jakarta", datetime(2024, 1, 1, 3)),
    ("2024-01-01 10:00:00-05", datetime(2024, 1, 1, 15)), ("", None), ("NaT", None),
])
def test_text_instants(spark, text, utc):
    df = conform(spark.createDataFrame([(text,)], "at string"), fields("at timestamp"))
    assert df.select(timewin.naive_utc(F.col("at"))).first()[0] == utc


def test_range_bucket(spark):
    df = spark.range(0, 15).withColumn("b", range_bucket(F.col("id"), 1, 12))
    assert [r.b for r in df.orderBy("id").collect()] == [0, *range(1, 13), 12, 12]
    assert spark.range(1).select(range_bucket(F.lit(None).cast("int"), 1, 12)).first()[0] is None
    assert spark.range(1).select(range_bucket(F.lit(5), 0, 10, 5)).first()[0] == 2


def test_small_scalars(spark):
    df = spark.createDataFrame([('OPTIONS(storage_uri = "gs://b/t/", x="y")', "v10.metadata.json", '{"a": null, "b": 1}'),
                                ("OPTIONS()", "current", '{"b": "t"}')], "ddl string, name string, doc string")
    out = df.select(storage_uri(F.col("ddl")), version_number(F.col("name")), json_value(F.col("doc"), "a"), json_value(F.col("doc"), "b"))
    assert rows(out) == sorted([("gs://b/t/", 10, None, "1"), (None, None, None, "t")], key=repr)


def test_latest_version_is_numeric(spark):
    df = spark.createDataFrame([("t", f"v{n}.metadata.json") for n in (8, 9, 10)], "t string, name string")
    assert latest_version(df, ["t"], "name").first().name == "v10.metadata.json"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_coercion_does_not_depend_on_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = conform(spark.createDataFrame([("x", "y")], "n string, d string"), fields("n bigint,d date"))
        assert rows(df) == [(None, None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
