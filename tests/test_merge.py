"""Every cell of the three merges, and the rules they share."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import explained, fields, rows
from tidemark.model import ChangeTable
from tidemark.operators.merge import (
    Delete, Insert, MergeSpec, Update, from_source, hard_delete_guarded, hard_delete_unguarded, merge, merge_into_catalog,
    merge_into_nothing, merge_statement, merge_table, soft_delete,
)
from tidemark.session import stored
from tidemark.tables import by_month

SCHEMA = fields("id string, name string, day date, created int, updated int, gone int")
CHANGE = ChangeTable(("id",), "updated", "gone", SCHEMA, partition="day", fixed=("created",))
DDL = "id string, name string, day string, created int, updated int, gone int"


def frame(spark, data):
    return spark.createDataFrame(data, DDL).withColumn("day", F.col("day").cast("date"))


def result(spark, target, source, spec, **options):
    out = merge(frame(spark, target), frame(spark, source), spec, **options)
    return sorted(((r.id, r.name, str(r.day), r.created, r.updated, r.gone) for r in out.collect()), key=repr)


D1, D2 = "2024-01-01", "2024-02-01"
OLD = ("a", "old", D1, 1, 1, None)
LIVE = ("a", "new", D1, 9, 5, None)
DEAD = ("a", "new", D1, 9, 5, 5)


@pytest.mark.parametrize("spec, matched_dead, unmatched_dead, matched_live", [
    # The guarded hard delete does not touch the tombstone column on an update.
    (hard_delete_guarded(CHANGE), [], [], [("a", "new", D1, 1, 5, None)]),
    (hard_delete_unguarded(CHANGE, ("id", "day")), [], [DEAD], [("a", "new", D1, 1, 5, None)]),
    (soft_delete(CHANGE), [("a", "new", D1, 1, 5, 5)], [DEAD], [("a", "new", D1, 1, 5, None)]),
])
def test_clause_table(spark, spec, matched_dead, unmatched_dead, matched_live):
    assert result(spark, [OLD], [DEAD], spec) == matched_dead
    assert result(spark, [], [DEAD], spec) == unmatched_dead
    assert result(spark, [OLD], [LIVE], spec) == matched_live
    assert result(spark, [], [LIVE], spec) == [LIVE]
    assert result(spark, [OLD], [], spec) == [OLD]


def test_update_columns_of_each_merge(spark):
    target = [("a", "old", D1, 1, 1, 1)]
    # A live source row clears the tombstone where the merge copies it, and leaves it where it does not.
    assert result(spark, target, [LIVE], hard_delete_guarded(CHANGE)) == [("a", "new", D1, 1, 5, 1)]
    assert result(spark, target, [LIVE], hard_delete_unguarded(CHANGE, ("id", "day"))) == [("a", "new", D1, 1, 5, None)]
    assert result(spark, target, [LIVE], soft_delete(CHANGE)) == [("a", "new", D1, 1, 5, None)]


def test_moved_partition_inserts_a_second_row_unless_matched_on_key(spark):
    moved = ("a", "new", D2, 9, 5, None)
    assert result(spark, [OLD], [moved], soft_delete(CHANGE)) == sorted([OLD, moved], key=repr)
    assert result(spark, [OLD], [moved], soft_delete(CHANGE, on=("id",))) == [("a", "new", D2, 1, 5, None)]


def test_version_guard_is_opt_in(spark):
    newer = [("a", "kept", D1, 1, 9, None)]
    assert result(spark, newer, [LIVE], soft_delete(CHANGE))[0][1] == "new"
    assert result(spark, newer, [LIVE], soft_delete(CHANGE, guard_version=True)) == newer
    assert result(spark, newer, [DEAD], hard_delete_guarded(CHANGE, guard_version=True)) == newer
    assert result(spark, [("a", "kept", D1, 1, None, None)], [LIVE], soft_delete(CHANGE, guard_version=True))[0][1] == "new"


@pytest.mark.parametrize("spec", [hard_delete_guarded(CHANGE), soft_delete(CHANGE)])
def test_merging_twice_is_merging_once(spark, spec):
    target = [OLD, ("b", "b", D1, 1, 1, None)]
    source = [DEAD, ("c", "c", D2, 1, 1, None), ("d", "d", D2, 1, 1, 1)]
    once = merge(frame(spark, target), frame(spark, source), spec)
    assert rows(merge(once, frame(spark, source), spec)) == rows(once)


def test_unguarded_insert_alternates_for_an_unknown_tombstone(spark):
    spec = hard_delete_unguarded(CHANGE, ("id", "day"))
    seen = []
    state = frame(spark, [])
    for _ in range(4):
        state = merge(state, frame(spark, [DEAD]), spec)
        seen.append(state.count())
    assert seen == [1, 0, 1, 0]


def test_null_keys_never_match(spark):
    target = [(None, "t", D1, 1, 1, None)]
    source = [(None, "s", D1, 2, 2, None), (None, "u", D1, 3, 3, None)]
    assert len(result(spark, target, source, soft_delete(CHANGE))) == 3
    assert len(result(spark, target, source, soft_delete(CHANGE), unique_source=True)) == 3
    null_day = ("a", "n", None, 1, 1, None)
    assert len(result(spark, [null_day], [null_day], soft_delete(CHANGE))) == 2


def test_duplicate_source_keys_are_an_error(spark):
    with pytest.raises(Exception, match="several rows for key"):
        result(spark, [OLD], [LIVE, DEAD], soft_delete(CHANGE))
    with pytest.raises(Exception, match="several rows for key"):
        result(spark, [], [LIVE, DEAD], soft_delete(CHANGE))


def test_duplicate_target_rows_are_all_changed(spark):
    target = [OLD, ("a", "other", D1, 2, 2, None)]
    assert {r[1] for r in result(spark, target, [LIVE], soft_delete(CHANGE))} == {"new"}
    assert result(spark, target, [DEAD], hard_delete_guarded(CHANGE)) == []


def test_first_true_clause_wins_and_null_conditions_are_false(spark):
    spec = MergeSpec(
        ("id",),
        (Update((("name", "'first'"),), "s.updated > 3"), Delete("s.updated > 1"), Update(from_source("name"))),
        (Insert("s.updated > 3", ("id", "name")), Insert("s.updated > 1")),
    )
    source = [(k, "s", D1, 7, u, None) for k, u in (("a", 5), ("b", 2), ("c", 1), ("d", None))]
    target = [(k, "t", D1, 1, 1, None) for k in "abcd"]
    assert [(r[0], r[1]) for r in result(spark, target, source, spec)] == [("a", "first"), ("c", "s"), ("d", "s")]
    fresh = result(spark, [], source, spec)
    assert fresh == [("a", "s", "None", None, None, None), ("b", "s", D1, 7, 2, None)]
    assert rows(merge_into_nothing(frame(spark, source), spec, SCHEMA)) == rows(merge(frame(spark, []), frame(spark, source), spec))


def test_unknown_columns_are_refused(spark):
    for spec in (MergeSpec(("id",), (Update(from_source("nope")),)), MergeSpec(("id",), (), (Insert(columns=("id", "nope")),))):
        with pytest.raises(ValueError, match="nope"):
            merge(frame(spark, [OLD]), frame(spark, [LIVE]), spec)
        with pytest.raises(ValueError, match="nope"):
            merge_into_nothing(frame(spark, [LIVE]), spec, SCHEMA)


def test_expression_keys(spark):
    spec = MergeSpec(("lower(id)",), (Update(from_source("name")),), (Insert(),))
    assert [r[:2] for r in result(spark, [OLD], [("A", "new", D1, 1, 1, None)], spec)] == [("a", "new")]


def brute_force(target, source, kind):
    """Row by row, as the clauses read."""
    out, used = [], set()
    for t in target:
        hit = next((s for s in source if None not in (t[0], t[2]) and s[0] == t[0] and (kind == "guarded" or s[2] == t[2])), None)
        if hit is None:
            out.append(t)
            continue
        used.add(id(hit))
        if kind == "soft":
            out.append((t[0], hit[1], hit[2], t[3], hit[4], hit[5]))
        elif hit[5] is None:
            gone = t[5] if kind == "guarded" else None
            out.append((t[0], hit[1], hit[2], t[3], hit[4], gone))
    out += [s for s in source if id(s) not in used and not (kind == "guarded" and s[5] is not None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("kind", ["guarded", "unguarded", "soft"])
def test_against_brute_force(spark, make_table, seed, kind):
    rng = random.Random(seed)
    pick = lambda: (f"k{rng.randrange(30)}", f"n{rng.randrange(99)}", f"2024-0{rng.randrange(1, 4)}-01",
                    rng.randrange(9), rng.randrange(9), rng.choice([None, None, 1]))
    target = [pick() for _ in range(40)]
    source = list({r[0]: r for r in (pick() for _ in range(25))}.values())
    spec = {"guarded": hard_delete_guarded(CHANGE), "unguarded": hard_delete_unguarded(CHANGE, ("id", "day")),
            "soft": soft_delete(CHANGE)}[kind]
    want = brute_force(target, source, kind)
    assert result(spark, target, source, spec) == want

    table = make_table(SCHEMA, partition_by=("m",), cluster_by=("id",), derived={"m": by_month("day")})
    table.overwrite(frame(spark, target))
    merge_table(table, frame(spark, source), spec)
    out = [(r.id, r.name, str(r.day), r.created, r.updated, r.gone) for r in table.read().collect()]
    assert sorted(out, key=repr) == want


def test_merge_table_touches_only_the_batch_partitions(spark, make_table):
    table = make_table(SCHEMA, partition_by=("day",))
    table.overwrite(frame(spark, [OLD, ("b", "b", D2, 1, 1, None), ("c", "c", "2024-03-01", 1, 1, None)]))
    files = {r[0] for r in table.read().where("day <> date'2024-01-01'").select("_metadata.file_path").collect()}
    merge_table(table, frame(spark, [LIVE]), soft_delete(CHANGE))
    assert {r[0] for r in table.read().where("day <> date'2024-01-01'").select("_metadata.file_path").collect()} == files
    assert table.read().where("id = 'a'").first().name == "new"


def test_merge_table_with_null_partition_and_emptied_partition(spark, make_table):
    table = make_table(SCHEMA, partition_by=("day",))
    table.overwrite(frame(spark, [OLD, ("n", "n", None, 1, 1, None)]))
    merge_table(table, frame(spark, [DEAD, ("m", "m", None, 1, 1, None)]), hard_delete_guarded(CHANGE))
    assert [r.id for r in table.read().orderBy("id").collect()] == ["m", "n"]
    assert table.partitions() == [(None,)]


def test_merge_table_of_an_empty_batch_changes_nothing(spark, make_table):
    table = make_table(SCHEMA, partition_by=("day",))
    table.overwrite(frame(spark, [OLD]))
    merge_table(table, frame(spark, []), soft_delete(CHANGE))
    assert rows(table.read()) == rows(frame(spark, [OLD]).select(*table.read().columns))


def test_small_batch_is_broadcast_and_target_is_not_shuffled(spark, folder):
    path = folder()
    frame(spark, [OLD]).write.parquet(path)
    small = spark.read.parquet(path)
    plan = explained(merge(small, small, soft_delete(CHANGE), unique_source=True, broadcast_source=True))
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan and "SortMergeJoin" not in plan
    # The one exchange is that of the distinct matched keys.
    assert plan.count("ENSURE_REQUIREMENTS") == 1


def test_size_is_that_of_rows_in_memory(spark):
    """Long texts that compress to nothing still count by their length."""
    from tidemark.operators.merge import _row_bytes

    df = spark.sql("select id, repeat('a', 10000) text, array(repeat('b', 1000)) many, cast(null as string) none from range(10)")
    assert df.agg(F.sum(_row_bytes(df.schema))).first()[0] >= 10 * (10_000 + 8_000 + 4 * 8)


def test_one_exchange_per_side_for_unique_targets(spark, folder):
    path = folder()
    frame(spark, [OLD]).write.parquet(path)
    side = spark.read.parquet(path).hint("merge")
    plan = explained(merge(side, side, hard_delete_guarded(CHANGE), unique_source=True, repeated_keys=False))
    assert plan.count("ENSURE_REQUIREMENTS") == 2 and "FullOuter" in plan and "Union" not in plan


@pytest.mark.parametrize("spec", [hard_delete_guarded(CHANGE), soft_delete(CHANGE), hard_delete_unguarded(CHANGE, ("id",))])
def test_full_join_gives_the_rows_of_the_branches(spark, spec):
    target = frame(spark, [OLD, ("b", "b", D2, 1, 1, None), (None, "n", D2, 1, 1, None), ("k", "k", D1, 1, 1, None)])
    source = frame(spark, [("a", "new", D1, 9, 5, None), ("b", "gone", D2, 1, 2, 2), ("c", "c", D2, 1, 1, None), ("d", "d", D2, 1, 1, 1), (None, "s", D1, 1, 1, None)])
    assert rows(merge(target, source, spec, repeated_keys=False)) == rows(merge(target, source, spec))


def test_search_for_partitions_keeps_its_rows_where_they_are(spark, make_table):
    from tidemark.operators import merge as module

    table = make_table(SCHEMA, partition_by=("day",))
    table.overwrite(frame(spark, [OLD, ("b", "b", D2, 1, 1, None)]))
    assert module._matched_partitions(table, frame(spark, [("b", "x", D1, 1, 1, None)]), soft_delete(CHANGE, on=("id",)), False) == {table.partition_values(frame(spark, [("b", "b", D2, 1, 1, None)]))[0]}


@pytest.mark.parametrize("spec", [hard_delete_guarded(CHANGE), soft_delete(CHANGE)])
def test_batches_beyond_the_bound_are_joined_without_broadcast(spark, make_table, monkeypatch, spec):
    from tidemark.operators import merge as module

    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    hints = []
    monkeypatch.setattr(module.F, "broadcast", lambda df: hints.append(1) or df)
    table = make_table(SCHEMA, partition_by=("day",))
    target = [OLD, ("b", "b", D2, 1, 1, None)]
    source = [("a", "new", D1, 9, 5, None), ("b", "gone", D2, 1, 2, 2), ("c", "c", D2, 1, 1, None)]
    table.overwrite(frame(spark, target))
    merge_table(table, frame(spark, source), spec)
    assert not hints
    out = [(r.id, r.name, str(r.day), r.created, r.updated, r.gone) for r in table.read().collect()]
    assert sorted(out, key=repr) == result(spark, target, source, spec)


def test_hot_target_key_is_split_or_combined(spark, folder):
    """A third of the target rows share a key: the join on rows is split, the search on keys combines them."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        path = folder()
        spark.range(0, 60_000, 1, 6).selectExpr(
            "if(id % 3 = 0, 'hot', cast(id as string)) id", "uuid() name", "date'2024-01-01' day", "1 created", "1 updated",
            "cast(null as int) gone").write.parquet(path)
        target = spark.read.schema(SCHEMA).parquet(path)
        newest = target.where("id <> '1'").groupBy("id").agg(*[F.max(c).alias(c) for c in SCHEMA.fieldNames()[1:]])
        source = stored(newest.withColumn("name", F.lit("s")))
        merged = merge(target, source, soft_delete(CHANGE, on=("id",)), unique_source=True)
        counts = merged.groupBy("name").agg(F.count("*").alias("n"), *[F.max(c) for c in SCHEMA.fieldNames() if c != "name"])
        got = {r.name if r.name == "s" else "t": r.n for r in counts.collect()}
        assert got == {"s": 59_999, "t": 1}
        plan = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "SortMergeJoin(skew=true)" in plan and "LeftSemi" not in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_catalog_statement(spark, make_table):
    text = merge_statement("lake.main", hard_delete_guarded(CHANGE))
    assert text.splitlines() == [
        "MERGE INTO lake.main t USING {source} s ON t.`id` = s.`id`",
        "WHEN MATCHED AND s.`gone` IS NOT NULL THEN DELETE",
        "WHEN MATCHED AND s.`gone` IS NULL THEN UPDATE SET t.`name` = s.`name`, t.`day` = s.`day`, t.`updated` = s.`updated`",
        "WHEN NOT MATCHED AND s.`gone` IS NULL THEN INSERT *",
    ]
    with pytest.raises(ValueError):
        merge_statement("x", hard_delete_unguarded(CHANGE, ("id", "to_date(created)")))
    # Plain Parquet tables cannot run it; the statement reaches the analyser and is refused there.
    with pytest.raises(Exception, match="MERGE|UNSUPPORTED"):
        merge_into_catalog(frame(spark, [LIVE]), make_table(SCHEMA).name, soft_delete(CHANGE))
