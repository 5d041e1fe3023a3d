from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import explained, fields
from tidemark import session
from tidemark.model import ChangeTable
from tidemark.operators.evolve import evolve_append, evolve_table, missing_fields, schema_diff
from tidemark.operators.merge import soft_delete
from tidemark.plans.sync import export_load, holds_no_rows, merge_recent, sync_dated, sync_direct, sync_landing
from tidemark.operators.merge import hard_delete_guarded
from tidemark.sources.footers import file_fields, schema_union
from tidemark.streaming import ingest
from tidemark.streaming.ingest import evolve_stream, ingest_batch, ingest_ephemeral, ingest_stream, merge_stream, newest_with_batch
from tidemark.tables import by_day, with_batch

BASE = fields("order_id bigint,customer_id bigint,status string")


def land(spark, path, sql):
    spark.sql(sql).coalesce(1).write.parquet(path)


# --- drift ------------------------------------------------------------------------------


def test_first_file_decides_a_type_and_conflicts_are_reported(spark, folder):
    root = folder()
    land(spark, f"{root}/a", "select 1 as id, 'x' as c")
    land(spark, f"{root}/b", "select 1L as id, 2.5D as c, date'2024-01-01' as d, array(1) as n, cast(1.5 as float) as f")
    union = {r.name: (r.table_type, r.conflict, r.files) for r in schema_union(file_fields(spark, root)).collect()}
    assert union == {"id": ("bigint", True, 2), "c": ("string", True, 2), "d": ("date", False, 1), "n": (None, False, 1),
                     "f": ("double", False, 1)}


def test_diff_statuses_and_order_of_new_columns(spark, folder):
    root = folder()
    land(spark, root, "select 1L as ORDER_ID, true as zz, timestamp'2024-01-01T00:00:00Z' as aa, cast(1 as decimal(18,2)) as money")
    union = schema_union(file_fields(spark, root))
    status = {r.name: r.status for r in schema_diff(union, BASE).collect()}
    assert status == {"order_id": "known", "customer_id": "absent", "status": "absent", "zz": "new", "aa": "new", "money": "new"}
    added = missing_fields(union, BASE)
    assert [(f.name, f.dataType.simpleString()) for f in added] == [("zz", "boolean"), ("aa", "timestamp"), ("money", "decimal(18,2)")]


def test_unsupported_new_column_fails_before_loading(spark, folder, make_history):
    table, root = make_history(BASE), folder()
    land(spark, root, "select 1L as order_id, array(1, 2) as tags")
    with pytest.raises(ValueError, match="tags"):
        evolve_append(table, root, "b")
    assert table.is_empty() and "tags" not in table.read().columns


def test_unsupported_type_of_a_known_column_is_no_drift(spark, folder, make_history):
    root = folder()
    land(spark, root, "select array(1) as status")
    assert evolve_table(make_history(BASE), root) == []


def test_evolving_twice_is_evolving_once(spark, folder, make_history):
    table, root = make_history(BASE), folder()
    land(spark, f"{root}/1", "select 1L as order_id, 2L as customer_id, 'new' as status")
    land(spark, f"{root}/2", "select 3L as order_id, 4L as customer_id, 'old' as status, 5 as item_count")
    assert [f.name for f in evolve_append(table, f"{root}/1", "1")] == []
    for expected in (["item_count"], []):
        assert [f.name for f in evolve_append(table, f"{root}/2", "2")] == expected
    got = table.read().select("order_id", "item_count", "batch_id").orderBy("order_id").collect()
    assert [tuple(r) for r in got] == [(1, None, "1"), (3, 5, "2")]
    assert table.schema["item_count"].dataType == T.LongType()


def test_stream_widens_the_table_as_files_do(spark, folder, make_history, monkeypatch):
    """Drift between runs and within one; a replayed micro-batch changes nothing; a type no column takes stops before loading."""
    table, root, checkpoint = make_history(BASE), folder(), folder()
    land(spark, f"{root}/export_1", "select 1L as order_id, 2L as customer_id, 'new' as status")
    evolve_stream(table, f"{root}/export_*", checkpoint)
    assert table.read().columns == ["order_id", "customer_id", "status", "batch_id"]
    land(spark, f"{root}/export_2", "select 2L as order_id, 'x' as status, 5 as item_count")
    land(spark, f"{root}/export_3", "select 3L as order_id, date'2024-01-01' as day, 1.5D as price")
    append, calls = table.__class__.append_batch, []

    def append_then_fail(self, df, batch_id):
        append(self, df, batch_id)
        raise RuntimeError("lost")

    monkeypatch.setattr(table.__class__, "append_batch", append_then_fail)
    with pytest.raises(Exception, match="lost"):
        evolve_stream(table, f"{root}/export_*", checkpoint)
    monkeypatch.setattr(table.__class__, "append_batch", append)
    for _ in range(2):
        evolve_stream(table, f"{root}/export_*", checkpoint, then=lambda t, batch: calls.append(batch))
    got = {r.order_id: (r.customer_id, r.status, r.item_count, str(r.day), r.price) for r in table.read().collect()}
    assert got == {1: (2, "new", None, "None", None), 2: (None, "x", 5, "None", None), 3: (None, None, None, "2024-01-01", 1.5)}
    assert table.read().count() == 3 and calls == ["stream-000000000001"]
    land(spark, f"{root}/export_4", "select 4L as order_id, array(1) as tags")
    with pytest.raises(Exception, match="tags"):
        evolve_stream(table, f"{root}/export_*", checkpoint)
    assert table.read().count() == 3


# --- batches ----------------------------------------------------------------------------

EVENT = fields("k bigint,s string")


def events(spark, *keys):
    return spark.createDataFrame([(k, f"s{k}") for k in keys], "k bigint, s string")


def keys(table):
    return sorted(r.k for r in table.read().collect())


def test_missing_folder_is_no_batch(spark, folder, make_history):
    assert not ingest_batch(make_history(EVENT), f"{folder()}/*.parquet", "b", EVENT)
    assert ingest_ephemeral(make_history(EVENT), f"{folder()}/*", EVENT) == []


def test_ephemeral_removes_only_what_it_appended(spark, folder, make_history, monkeypatch):
    table, root = make_history(EVENT), folder()
    events(spark, 1, 2).write.parquet(f"{root}/a")
    append = table.__class__.append_batch

    def append_then_land(self, df, batch_id):
        append(self, df, batch_id)
        events(spark, 3).write.parquet(f"{root}/late")

    monkeypatch.setattr(table.__class__, "append_batch", append_then_land)
    ingest_ephemeral(table, f"{root}/*", EVENT)
    monkeypatch.setattr(table.__class__, "append_batch", append)
    assert keys(table) == [1, 2]
    assert len(ingest_ephemeral(table, f"{root}/*", EVENT)) >= 1
    assert keys(table) == [1, 2, 3]
    assert not session.path_exists(spark, f"{root}/*/*.parquet")


@pytest.mark.parametrize("broken", ["append_batch", "touch", "delete_path"])
def test_ephemeral_run_that_failed_anywhere_is_finished_by_the_next(spark, folder, make_history, monkeypatch, broken):
    table, root = make_history(EVENT), folder()
    events(spark, 1, 2, 3).repartition(3).write.parquet(f"{root}/a")
    owner = table.__class__ if broken == "append_batch" else ingest
    real = getattr(owner, broken)

    def fail(*args, **kwargs):
        if broken == "delete_path":
            real(*args)  # stopped half way
        if broken == "append_batch":
            real(*args, **kwargs)  # stopped after publishing
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, broken, fail)
    with pytest.raises(RuntimeError):
        ingest_ephemeral(table, f"{root}/*", EVENT)
    monkeypatch.setattr(owner, broken, real)
    events(spark, 4).write.parquet(f"{root}/b")
    ingest_ephemeral(table, f"{root}/*", EVENT)
    assert keys(table) == [1, 2, 3, 4]
    assert not session.path_exists(spark, f"{root}/*/*.parquet")
    assert not session.path_exists(spark, f"{table.root}/_batches/*")


def test_stream_takes_each_file_once(spark, folder, make_history):
    table, root, checkpoint = make_history(EVENT), folder(), folder()
    events(spark, 1, 2).write.parquet(f"{root}/export_1")
    for _ in range(2):
        ingest_stream(table, f"{root}/export_*", EVENT, checkpoint, max_files=1)
    events(spark, 3).write.parquet(f"{root}/export_2")
    ingest_stream(table, f"{root}/export_*", EVENT, checkpoint)
    assert keys(table) == [1, 2, 3]


def test_stream_writes_microseconds_in_its_own_session(spark, folder, make_history):
    import pyarrow.parquet as pq

    schema = fields("k bigint,at timestamp")
    table, root = make_history(schema), folder()
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        spark.sql("select 1L k, timestamp'2024-01-01T00:00:00Z' at").write.parquet(f"{root}/export_1")
        ingest_stream(table, f"{root}/export_*", schema, folder())
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    file = table.read().select("_metadata.file_path").first()[0]
    assert str(pq.read_schema("/" + file.removeprefix("file:").lstrip("/")).field("at").type) == "timestamp[us, tz=UTC]"


def test_replayed_micro_batch_is_stored_once(spark, folder, make_history, monkeypatch):
    """The process dies after the append but before the checkpoint is committed."""
    table, root, checkpoint = make_history(EVENT), folder(), folder()
    events(spark, 1, 2).write.parquet(f"{root}/export_1")
    append = table.__class__.append_batch

    def append_then_fail(self, df, batch_id):
        append(self, df, batch_id)
        raise RuntimeError("lost")

    monkeypatch.setattr(table.__class__, "append_batch", append_then_fail)
    with pytest.raises(Exception, match="lost"):
        ingest_stream(table, f"{root}/export_*", EVENT, checkpoint)
    monkeypatch.setattr(table.__class__, "append_batch", append)
    ingest_stream(table, f"{root}/export_*", EVENT, checkpoint)
    assert keys(table) == [1, 2]


def exported(spark, root, *files):
    for n, data in enumerate(files):
        people(spark, *data).coalesce(1).write.parquet(f"{root}/export_{n}")


VERSIONS = [
    [("1", "first", "2024-01-01", "2024-01-05", None), ("2", "born", "2024-01-01", "2024-01-05", None), ("3", "only", "2024-01-01", "2024-01-02", None)],
    [("1", "older", "2024-01-01", "2024-01-04", None), ("2", "gone", "2024-01-01", "2024-01-09", "2024-01-09"), ("4", "same b", "2024-01-01", "2024-01-06", None)],
    [("1", "newest", "2024-01-01", "2024-01-07", None), ("2", "before", "2024-01-01", "2024-01-03", None), ("4", "same a", "2024-01-01", "2024-01-06", None)],
]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0), (1, 0, 2)])
@pytest.mark.parametrize("spec", [soft_delete, lambda change: hard_delete_guarded(change)])
def test_files_in_any_order_give_one_serving_table(spark, folder, make_table, order, spec):
    """An older file changes nothing, also if the newer row was a deletion; equal versions are decided alike."""
    root, checkpoint = folder(), folder()
    history = make_table(with_batch(USER.schema), partition_by=("batch_id", "changed"), derived={"changed": by_day("updated_at")})
    serving = make_table(USER.schema, cluster_by=("id",))
    for n in order:
        people(spark, *VERSIONS[n]).coalesce(1).write.parquet(f"{root}/export_{n}")
        merge_stream(history, serving, USER, spec(USER), f"{root}/export_*", USER.schema, checkpoint)
    want = {"1": "newest", "3": "only", "4": "same b"}
    assert names(serving) == want | ({"2": "gone"} if spec is soft_delete else {})
    assert history.read().count() == 9


def test_replayed_merge_gives_the_same_rows(spark, folder, make_table, monkeypatch):
    """The process dies after the merge of a late file, before the checkpoint is committed."""
    root, checkpoint = folder(), folder()
    history = make_table(with_batch(USER.schema), partition_by=("batch_id",))
    serving = make_table(USER.schema)
    exported(spark, root, VERSIONS[2])
    merge_stream(history, serving, USER, hard_delete_guarded(USER), f"{root}/export_*", USER.schema, checkpoint)
    people(spark, *VERSIONS[1]).coalesce(1).write.parquet(f"{root}/export_late")
    real = ingest.merge_table

    def merge_then_fail(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "merge_table", merge_then_fail)
    with pytest.raises(Exception, match="lost"):
        merge_stream(history, serving, USER, hard_delete_guarded(USER), f"{root}/export_*", USER.schema, checkpoint)
    monkeypatch.setattr(ingest, "merge_table", real)
    for _ in range(2):
        merge_stream(history, serving, USER, hard_delete_guarded(USER), f"{root}/export_*", USER.schema, checkpoint)
    assert names(serving) == {"1": "newest", "4": "same b"} and history.read().count() == 6


def test_only_history_from_the_batch_on_is_read(spark, make_table):
    history = make_table(with_batch(USER.schema), partition_by=("batch_id", "changed"), derived={"changed": by_day("updated_at")})
    for n, data in enumerate(VERSIONS):
        history.append_batch(people(spark, *data), f"b{n}")
    plan = explained(newest_with_batch(history, USER, "b0"))
    assert "changed" in plan and "2024-01-02" in plan
    late = newest_with_batch(history, USER, "b1").collect()
    assert {r.id: r.name for r in late} == {"1": "newest", "2": "gone", "4": "same b"}
    history.append_batch(people(spark, ("1", "no version", "2024-01-01", None, None), ("9", "alone", "2024-01-01", None, None)), "b3")
    assert {r.id: r.name for r in newest_with_batch(history, USER, "b3").collect()} == {"1": "newest", "9": "alone"}
    assert newest_with_batch(history, USER, "none") is None


# --- flows ------------------------------------------------------------------------------

USER = ChangeTable(("id",), "updated_at", "deleted_at",
                   fields("id string,name string,created_at timestamp_ntz,updated_at timestamp_ntz,deleted_at timestamp_ntz"),
                   fixed=("created_at",))
RUN = datetime(2026, 8, 15, 17, tzinfo=UTC)


def people(spark, *data):
    df = spark.createDataFrame(list(data), "id string, name string, created_at string, updated_at string, deleted_at string")
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at", "deleted_at")})


def serving_of(make_table):
    return make_table(USER.schema, partition_by=("day",), cluster_by=("id",), derived={"day": by_day("created_at")})


def names(table):
    return {r.id: r.name for r in table.read().collect()}


def test_missing_table_counts_as_empty_and_other_errors_do_not(spark, make_table):
    assert holds_no_rows(spark, "no_such_table")
    assert holds_no_rows(spark, make_table(EVENT).name)
    with pytest.raises(Exception):
        holds_no_rows(spark, "not a name")


def test_direct_flow(spark, make_table, make_history):
    history, serving = make_history(USER.schema), serving_of(make_table)
    serving.overwrite(people(spark, ("1", "old", "2026-01-01", "2026-01-01", None), ("2", "old", "2026-01-02", "2026-01-02", None)))
    source = people(
        spark, ("1", "new", "2026-01-01", "2026-08-15 10:00:00", None), ("2", "x", "2026-01-02", "2026-08-15 11:00:00", "2026-08-15 11:00:00"),
        ("3", "new", "2026-08-15", "2026-08-15 23:59:59", None), ("4", "later", "2026-08-16", "2026-08-16 00:00:00", None))
    for via_json in (True, False):
        load = sync_direct(source, history, serving, USER, RUN, via_json=via_json)
        assert load.wrote and load.batch == "20260815"
        assert names(serving) == {"1": "new", "3": "new"} and history.read().count() == 3
    quiet = sync_direct(source, history, serving, USER, datetime(2027, 1, 1, tzinfo=UTC))
    assert not quiet.wrote and names(serving) == {"1": "new", "3": "new"}


def test_landing_flow_first_full_then_incremental(spark, folder, make_table, make_history):
    history, serving, landing = make_history(USER.schema), serving_of(make_table), folder()
    first = people(spark, ("1", "a", "2026-01-01", "2026-01-01", None), ("2", "b", "2026-08-14", "2026-08-14 12:00:00", None))
    load = sync_landing(first, landing, history, serving, USER, RUN, batch_of="users")
    assert load.is_initial and load.batch == "batch_users_full_load" and history.read().count() == 2
    # A first load is served whole, whatever the look-back.
    assert names(serving) == {"1": "a", "2": "b"}
    second = people(spark, ("1", "a2", "2026-01-01", "2026-08-16 09:00:00", None))
    load = sync_landing(second, landing, history, serving, USER, datetime(2026, 8, 16, 17, tzinfo=UTC), batch_of="users")
    assert not load.is_initial and load.batch == "batch_users_20260816"
    assert names(serving) == {"1": "a2", "2": "b"} and history.read().count() == 3


@pytest.mark.parametrize("broken", ["ingest_ephemeral", "batches_to_merge", "merge_recent", "merged"])
def test_landing_run_that_failed_anywhere_is_served_later(spark, folder, make_table, make_history, monkeypatch, broken):
    """The run stops after its export, its append, before its merge or before its end; then quiet days pass."""
    from tidemark.plans import sync

    history, serving, landing = make_history(USER.schema), serving_of(make_table), folder()
    sync_landing(people(spark, ("1", "a", "2026-01-01", "2026-01-01", None)), landing, history, serving, USER, datetime(2026, 8, 1, 17, tzinfo=UTC))
    source = people(spark, ("1", "a2", "2026-01-01", "2026-08-02 09:00:00", None))
    real = getattr(sync, broken)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(sync, broken, fail)
    with pytest.raises(RuntimeError):
        sync_landing(source, landing, history, serving, USER, datetime(2026, 8, 2, 17, tzinfo=UTC))
    monkeypatch.setattr(sync, broken, real)
    sync_landing(source, landing, history, serving, USER, datetime(2026, 8, 9, 17, tzinfo=UTC))
    assert names(serving) == {"1": "a2"} and history.read().count() == 2
    assert ingest.batches_to_merge(history) == []


def test_lookback_filter_comes_before_deduplication(spark, make_table, make_history):
    history, serving = make_history(USER.schema), serving_of(make_table)
    history.append_batch(people(spark, ("1", "inside", "2026-01-01", "2026-08-15", None), ("1", "too old", "2026-01-01", "2026-08-01", None)), "b")
    merge_recent(history, serving, USER, hard_delete_guarded(USER), RUN)
    assert names(serving) == {"1": "inside"}
    merge_recent(history, serving, USER, hard_delete_guarded(USER), datetime(2027, 1, 1, tzinfo=UTC))
    assert names(serving) == {"1": "inside"}


def test_export_load_names_and_empty_batch(spark, folder, make_history):
    history, landing = make_history(USER.schema), folder()
    assert export_load(people(spark), landing, history.name, USER, RUN).wrote is False
    history.append_batch(people(spark, ("1", "a", "2026-01-01", "2026-01-01", None)), "b")
    load = export_load(people(spark, ("1", "a", "2026-01-01", "2026-08-15", None)), landing, history.name, USER, RUN, batch_of="users")
    assert (load.batch, load.wrote) == ("batch_users_incremental_20260815", True)


TX = ChangeTable(("id",), "updated_at", "deleted_at",
                 fields("id string,amount double,day date,created_at timestamp,updated_at timestamp,deleted_at timestamp"),
                 partition="day", fixed=("created_at",))


def test_dated_flow(spark, folder, make_table, make_history):
    history, serving, landing = make_history(TX.schema), make_table(TX.schema, partition_by=("day",)), folder()

    def tx(*data):
        return spark.createDataFrame([(i, a, d, d, u, g) for i, a, d, u, g in data],
                                     "id string, amount string, day string, created_at string, updated_at string, deleted_at string")

    run = lambda source, day, hour: sync_dated(
        source, landing, history, serving, TX, change_day=date(2026, 9, day), run_end=datetime(2026, 9, day, hour, tzinfo=UTC))
    first = tx(("1", "10", "2026-09-01", "2026-09-01 09:00:00", None), ("2", "x", "2026-09-01", "2026-09-01 09:00:00", None),
               ("n", "1", "soon", "2026-09-01 09:00:00", None))
    load = run(first, 1, 20)
    # 20:00 UTC is the next day in Jakarta: the folder's date and the rows' date differ.
    assert load.is_initial and load.batch == "20260902"
    source = tx(("1", "710", "2026-09-01", "2026-09-02 11:30:00", None), ("2", "7", "2026-09-01", "2026-09-02 14:00:00", "2026-09-02 14:00:00"),
                ("3", "5", "2026-09-02", "2026-09-02 09:00:00", None), ("4", "5", "2026-09-03", "2026-09-03 09:00:00", None))
    for _ in range(2):
        assert not run(source, 2, 20).is_initial
        got = {r.id: (r.amount, r.gone) for r in serving.read().selectExpr("id", "amount", "deleted_at is not null gone").collect()}
        assert got == {"1": (710.0, False), "2": (7.0, True), "3": (5.0, False), "n": (1.0, False)}
    assert history.read().count() == 6
    # A rerun without rows leaves no folder, and ingests none of the earlier one's.
    assert not run(tx(), 2, 20).wrote and not session.path_exists(spark, f"{landing}/export_20260903")


def test_stream_merge_follows_each_append(spark, folder, make_table, make_history):
    history, serving = make_history(USER.schema), serving_of(make_table)
    root, checkpoint = folder(), folder()
    for n, name in enumerate(("first", "second")):
        people(spark, ("1", name, "2026-01-01", f"2026-01-0{n + 1}", None)).write.parquet(f"{root}/export_{n}")
        merge_stream(history, serving, USER, soft_delete(USER), f"{root}/export_*", USER.schema, checkpoint)
        assert names(serving) == {"1": name}
    assert history.read().count() == 2


def test_migration_of_aligned_folders_is_not_exchanged(spark, folder, monkeypatch):
    from tests.conftest import explained
    from tidemark.plans.sync import migrate_hive
    from tidemark.tables import LakeTable

    raw = folder()
    spark.range(48).selectExpr("id", "2024 as y", "id % 12 + 1 as m").write.partitionBy("y", "m").parquet(raw)
    plans, publish = [], LakeTable.publish
    monkeypatch.setattr(LakeTable, "publish", lambda self, df, *a: plans.append(explained(df)) or publish(self, df, *a))
    table = migrate_hive(spark, raw, fields("id bigint"), {"y": T.LongType(), "m": T.LongType()}, "migrated_aligned",
                         folder(), "m", 1, 12)
    assert "Exchange" not in plans[0] and table.read().count() == 48
    assert sorted(table.partitions()) == [(n,) for n in range(1, 13)]
    other = migrate_hive(spark, raw, fields("id bigint"), {"y": T.LongType(), "m": T.LongType()}, "migrated_other",
                         folder(), "id", 0, 40, 10)
    assert "REBALANCE" in plans[1] and sorted(other.partitions()) == [(n,) for n in range(1, 6)]


def test_rerun_of_a_day_whose_source_moved_on_forgets_nothing(spark, make_table):
    """The day is run again after row 1 was changed on the next one, and once more after row 2 was, too."""
    from tidemark.operators.history import as_of

    history = make_table(with_batch(USER.schema), partition_by=("batch_id",))
    serving = serving_of(make_table)
    day = datetime(2026, 8, 15, 17, tzinfo=UTC)  # the previous day in Jakarta is the 15th
    rows = [("1", "a", "2026-01-01", "2026-08-15 09:00:00", None), ("2", "b", "2026-01-01", "2026-08-15 10:00:00", None)]
    sync_direct(people(spark, *rows), history, serving, USER, day)
    evening = lambda: sorted((r.id, r.name) for r in as_of(history.read().drop("batch_id"), USER, "2026-08-15 23:00:00").collect())
    before = evening()
    moved = [("1", "later", "2026-01-01", "2026-08-16 09:00:00", None), rows[1]]
    assert sync_direct(people(spark, *moved), history, serving, USER, day).wrote and history.read().count() == 2
    moved[1] = ("2", "later", "2026-01-01", "2026-08-16 10:00:00", "2026-08-16 10:00:00")
    assert not sync_direct(people(spark, *moved), history, serving, USER, day).wrote
    assert evening() == before == [("1", "a"), ("2", "b")] and history.read().count() == 2
    sync_direct(people(spark, *moved), history, serving, USER, datetime(2026, 8, 16, 17, tzinfo=UTC))
    assert evening() == before and names(serving) == {"1": "later"} and history.read().count() == 4
