"""MERGE: bring a target in step with a batch of changes."""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import nullcontext
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ChangeTable
from tidemark.operators.fileindex import FileIndex
from tidemark.session import staged
from tidemark.tables import LakeTable


# A batch is broadcast up to this size of its rows in memory.
BROADCAST_BYTES = 8 << 20


@dataclass(frozen=True)
class Update:
    """WHEN MATCHED [AND when] THEN UPDATE SET column = expression, over aliases ``t`` and ``s``."""

    set: tuple[tuple[str, str], ...]
    when: str | None = None


@dataclass(frozen=True)
class Delete:
    """WHEN MATCHED [AND when] THEN DELETE."""

    when: str | None = None


@dataclass(frozen=True)
class Insert:
    """WHEN NOT MATCHED [AND when] THEN INSERT; columns left out are NULL (None: all)."""

    when: str | None = None
    columns: tuple[str, ...] | None = None


@dataclass(frozen=True)
class MergeSpec:
    """What a merge does; the first clause whose condition is true decides a row.

    ``on`` holds SQL expressions evaluated on each side, equal for a match, such as
    ``("id", "to_date(created_at)")``.
    """

    on: tuple[str, ...]
    matched: tuple[Update | Delete, ...] = ()
    not_matched: tuple[Insert, ...] = ()


def from_source(*columns: str) -> tuple[tuple[str, str], ...]:
    return tuple((c, f"s.`{c}`") for c in columns)


def _only_newer(change: ChangeTable, guard: bool, when: str | None) -> str | None:
    if not guard:
        return when
    newer = f"(t.`{change.version}` IS NULL OR s.`{change.version}` > t.`{change.version}`)"
    return newer if when is None else f"{when} AND {newer}"


def hard_delete_guarded(change: ChangeTable, on: tuple[str, ...] | None = None, guard_version: bool = False) -> MergeSpec:
    """A tombstone deletes the row; a tombstone for an unknown key is ignored."""
    gone = f"s.`{change.tombstone}` IS NOT NULL"
    alive = f"s.`{change.tombstone}` IS NULL"
    columns = [c for c in change.mutable if c != change.tombstone]
    return MergeSpec(
        on or change.key,
        (Delete(_only_newer(change, guard_version, gone)),
         Update(from_source(*columns), _only_newer(change, guard_version, alive))),
        (Insert(alive),),
    )


def hard_delete_unguarded(change: ChangeTable, on: tuple[str, ...], guard_version: bool = False) -> MergeSpec:
    """A tombstone deletes the row; one for an unknown key is inserted as a row.

    Not idempotent for such keys: the next run deletes the row, the one after
    inserts it again, while the tombstone stays inside the look-back.
    """
    gone = f"s.`{change.tombstone}` IS NOT NULL"
    updates = [c for c in change.mutable if c not in on]
    return MergeSpec(
        on,
        (Delete(_only_newer(change, guard_version, gone)),
         Update(from_source(*updates), _only_newer(change, guard_version, None))),
        (Insert(),),
    )


def soft_delete(change: ChangeTable, on: tuple[str, ...] | None = None, guard_version: bool = False) -> MergeSpec:
    """Rows are never removed; the tombstone is copied into the row.

    Matching on key and partition keeps the read to the touched partitions, but a key
    whose partition value changed gets a second row.  Pass ``on=change.key`` to move
    the row instead.
    """
    if on is None:
        on = change.key + ((change.partition,) if change.partition else ())
    return MergeSpec(on, (Update(from_source(*change.mutable), _only_newer(change, guard_version, None)),), (Insert(),))


def _first_true(clauses: Iterable[Update | Delete | Insert]) -> Column:
    """Index of the first clause that applies, -1 if none does."""
    chosen = None
    for i, clause in enumerate(clauses):
        test = F.expr(clause.when) if clause.when else F.lit(True)
        chosen = F.when(test, i) if chosen is None else chosen.when(test, i)
    return F.lit(-1) if chosen is None else chosen.otherwise(-1)


def _with_keys(df: DataFrame, on: tuple[str, ...], side: str) -> DataFrame:
    return df.select("*", *[F.expr(e).alias(f"__{side}{i}") for i, e in enumerate(on)])


def _key_names(on: tuple[str, ...], side: str) -> list[str]:
    return [f"__{side}{i}" for i in range(len(on))]


def _equal(on: tuple[str, ...], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in
                                       zip(_key_names(on, left), _key_names(on, right), strict=True)])


def require_unique(source: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """``source``, failing at run time if two rows share a key that can match.

    Counts are combined before the shuffle.  Rows with a NULL in the key match
    nothing, so they pass as they are.
    """
    columns = source.columns
    keyed = _with_keys(source, on, "u")
    names = _key_names(on, "u")
    complete = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    counted = keyed.where(complete).groupBy(*names).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*columns)).alias("__row")
    )
    message = F.concat(F.lit("merge source has several rows for key "), F.to_json(F.struct(*names)))
    checked = counted.select(
        F.when(F.col("__n") > 1, F.raise_error(message)).otherwise(F.col("__row")).alias("__row")
    ).select("__row.*")
    return checked.unionByName(keyed.where(~complete).select(*columns))


def _check_columns(spec: MergeSpec, columns: list[str]) -> None:
    named = {c for u in spec.matched if isinstance(u, Update) for c, _ in u.set}
    named |= {c for i in spec.not_matched for c in i.columns or ()}
    if named - set(columns):
        raise ValueError(f"the target has no column {sorted(named - set(columns))}")


def _insert_values(spec: MergeSpec, source_columns: list[str], schema: T.StructType) -> dict[str, Column]:
    """What the first insert clause that applies writes into each column, from alias ``s``."""
    choice = _first_true(spec.not_matched)
    have = {c.lower() for c in source_columns}

    def value(field: T.StructField) -> Column:
        takers = [i for i, c in enumerate(spec.not_matched) if c.columns is None or field.name in c.columns]
        if field.name.lower() not in have or not takers:
            return F.lit(None).cast(field.dataType).alias(field.name)
        taken = F.col(f"s.`{field.name}`").cast(field.dataType)
        if len(takers) < len(spec.not_matched):
            taken = F.when(choice.isin(takers), taken)
        return taken.alias(field.name)

    return {f.name: value(f) for f in schema.fields}


def _inserts(fresh: DataFrame, spec: MergeSpec, source_columns: list[str], schema: T.StructType) -> DataFrame:
    """Rows without a match (under alias ``s``) as the first insert clause that applies writes them."""
    values = _insert_values(spec, source_columns, schema)
    return fresh.where(_first_true(spec.not_matched) >= 0).select(*values.values())


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec, *, unique_source: bool = False,
          broadcast_source: bool = False, repeated_keys: bool = True) -> DataFrame:
    """The target after the merge.

    Two branches: target rows with their match, if any, and source rows without one.
    The first is a left join, which AQE can split on a hot target key.  The second
    needs the target's key columns only, reduced to distinct keys before they are
    moved, so a key with very many rows costs one row per task.

    ``repeated_keys=False`` states that no key has very many rows in the target, as in a
    table kept by merges: then one full outer join gives all three kinds of rows, with
    one exchange per side.

    ``unique_source`` states that the source holds one row per ``on`` key already,
    as :func:`latest_per_key` guarantees; otherwise that is checked.
    ``broadcast_source`` states that the source was found small (see
    :func:`merge_table`): then the target is not shuffled at all.  The source is read
    once per branch; store a costly one first.
    """
    kept, added = merge_branches(target, source, spec, unique_source=unique_source, broadcast_source=broadcast_source,
                                 repeated_keys=repeated_keys)
    return kept if added is None else kept.unionByName(added)


def merge_branches(target: DataFrame, source: DataFrame, spec: MergeSpec, *, unique_source: bool = False,
                   broadcast_source: bool = False, repeated_keys: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """The two branches of :func:`merge`: rows that were there, and rows that are new (None: the first has both)."""
    columns = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    _check_columns(spec, columns)
    if not unique_source:
        source = require_unique(source, spec.on)
    t = _with_keys(target, spec.on, "t").alias("t")
    s = _with_keys(source, spec.on, "s").alias("s")
    side = F.broadcast if broadcast_source else (lambda df: df)

    whole = bool(spec.not_matched) and not broadcast_source and not repeated_keys
    if whole:
        t = t.withColumn("__there", F.lit(True)).alias("t")
    joined = t.join(side(s), _equal(spec.on, "t", "s"), "full_outer" if whole else "left_outer")
    # An equality match needs a non-NULL key, so this tells matched rows apart.
    matched = F.col(_key_names(spec.on, "s")[0]).isNotNull()
    action = F.when(matched, _first_true(spec.matched)).otherwise(-1)
    deletes = [i for i, c in enumerate(spec.matched) if isinstance(c, Delete)]
    updates = [(i, dict(c.set)) for i, c in enumerate(spec.matched) if isinstance(c, Update)]

    def result(name: str) -> Column:
        value = None
        for i, assignments in updates:
            if name in assignments:
                new = F.expr(assignments[name]).cast(types[name])
                value = F.when(action == i, new) if value is None else value.when(action == i, new)
        old = F.col(f"t.`{name}`")
        return (old if value is None else value.otherwise(old)).alias(name)

    if whole:
        there, choice = F.coalesce("__there", F.lit(False)), _first_true(spec.not_matched)
        rows = joined.where(F.when(there, ~action.isin(deletes) if deletes else F.lit(True)).otherwise(choice >= 0))
        fields = _insert_values(spec, source.columns, target.schema)
        return rows.select(*[F.when(there, result(c)).otherwise(fields[c]).alias(c) for c in columns]), None
    kept = joined.where(~action.isin(deletes)) if deletes else joined
    kept = kept.select(*[result(c) for c in columns])
    if not spec.not_matched:
        return kept, None

    known = t.select(*_key_names(spec.on, "t"))
    if broadcast_source:
        known = known.join(side(s.select(*_key_names(spec.on, "s"))), _equal(spec.on, "t", "s"), "left_semi")
    known = known.distinct()
    fresh = s.join(side(known), _equal(spec.on, "s", "t"), "left_anti")
    return kept, _inserts(fresh, spec, source.columns, target.schema)


def merge_into_nothing(source: DataFrame, spec: MergeSpec, schema: T.StructType, *, unique_source: bool = False) -> DataFrame:
    """The merge of a batch into a table without rows: inserts only, no join."""
    _check_columns(spec, schema.fieldNames())
    if not unique_source:
        source = require_unique(source, spec.on)
    return _inserts(source.alias("s"), spec, source.columns, schema)


def _with_partitions(table: LakeTable, spec: MergeSpec) -> MergeSpec:
    """The same spec, matching also on partition columns its keys imply; this prunes folders."""
    implied = tuple(n for n, d in table.derived if n in table.partition_by and n not in spec.on and d.fixed_by(spec.on))
    return replace(spec, on=spec.on + implied)


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row in memory, at least: a word for every column, and what variable ones hold."""
    def held(c: Column, dtype: T.DataType) -> Column | None:
        if isinstance(dtype, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
            return F.octet_length(c)
        if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return 8 * F.octet_length(F.to_json(F.struct(c.alias("v"))))
        return None

    parts = [held(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields]
    words = F.lit(16 * (len(parts) + 1)).cast("long")
    return reduce(lambda a, b: a + F.coalesce(b, F.lit(0)), [p for p in parts if p is not None], words)


def _matched_partitions(table: LakeTable, source: DataFrame, spec: MergeSpec, small: bool,
                        index: FileIndex | None = None) -> set[tuple]:
    """Partitions of the target rows the batch matches, where the keys do not tell.

    Without an index the key columns of the whole target are read, with one those of the files that may hold a key.
    """
    keys = _with_keys(source, spec.on, "s").select(*_key_names(spec.on, "s"))
    rows = table.read() if index is None else index.rows_in(index.files_with(keys))
    target = _with_keys(rows, spec.on, "t").select(*table.partition_by, *_key_names(spec.on, "t"))
    if small:
        keys = F.broadcast(keys)
    return set(table.partition_values(target.join(keys, _equal(spec.on, "t", "s"), "left_semi")))


def _moved(table: LakeTable, spec: MergeSpec) -> bool:
    """Can an update put a row into another partition?"""
    sources = set(table.partition_by) | {d.source for _, d in table.derived}
    assigned = {c for clause in spec.matched if isinstance(clause, Update) for c, _ in clause.set}
    return bool((sources & assigned) - set(spec.on))


def _publish(table: LakeTable, kept: DataFrame, added: DataFrame | None, touched: set[tuple], exchange: bool) -> None:
    """Kept rows are written where they were read unless the join or an update moved them."""
    kept = table.shaped(kept)
    if exchange:
        kept = table.spread(kept)
    table.publish(kept if added is None else kept.unionByName(table.spread(table.shaped(added))), touched)


def merge_table(table: LakeTable, source: DataFrame, spec: MergeSpec, *, unique_source: bool = False,
                repeated_keys: bool = False, stage: bool = True, index: FileIndex | None = None) -> None:
    """Merge a batch into a catalog table, rewriting only the partitions it touches.

    The batch is stored first (``stage=False``: it is stored already) and its size in
    memory is measured; only one within ``BROADCAST_BYTES`` is broadcast.  If the ``on``
    keys settle the partition, the touched partitions are the batch's own; otherwise
    the target's key columns are searched for matches as well, with an ``index`` of the
    ``on`` keys only in files that may hold one.  Say ``repeated_keys`` for a table in which a key
    may have very many rows.
    """
    if index is not None and (index.table != table or index.keys != spec.on):
        raise ValueError("the index is of another table or of other keys")
    source = table.with_derived(source)
    if table.is_empty():
        table.overwrite(merge_into_nothing(source, spec, table.schema, unique_source=unique_source))
        return
    spec = _with_partitions(table, spec)
    with staged(source) if stage else nullcontext((source, None)) as (batch, _):
        held = batch.groupBy(*table.partition_by).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(batch.schema)).alias("size")).collect()
        if not sum(r["n"] for r in held):
            return
        small = sum(r["size"] for r in held) <= BROADCAST_BYTES
        target, touched = table.read(), set()
        if table.partition_by:
            touched = {tuple(r)[:-2] for r in held}
            if not set(table.partition_by) <= set(spec.on):
                touched |= _matched_partitions(table, batch, spec, small, index)
            target = table.only(touched)
        kept, added = merge_branches(target, batch, spec, unique_source=unique_source, broadcast_source=small,
                                     repeated_keys=repeated_keys)
        _publish(table, kept, added, touched, _moved(table, spec) or not small)


def merge_statement(name: str, spec: MergeSpec) -> str:
    """The merge as SQL with ``{source}`` for the batch, for catalogs with row-level changes."""
    if not all(e.isidentifier() for e in spec.on):
        raise ValueError("a catalog merge matches on plain columns")
    lines = [f"MERGE INTO {name} t USING {{source}} s ON " + " AND ".join(f"t.`{c}` = s.`{c}`" for c in spec.on)]
    for clause in spec.matched:
        head = f"WHEN MATCHED{f' AND {clause.when}' if clause.when else ''} THEN "
        if isinstance(clause, Delete):
            lines.append(head + "DELETE")
        else:
            lines.append(head + "UPDATE SET " + ", ".join(f"t.`{c}` = {e}" for c, e in clause.set))
    for clause in spec.not_matched:
        head = f"WHEN NOT MATCHED{f' AND {clause.when}' if clause.when else ''} THEN INSERT "
        names = clause.columns
        lines.append(head + ("*" if names is None else
                             f"({', '.join(f'`{c}`' for c in names)}) VALUES ({', '.join(f's.`{c}`' for c in names)})"))
    return "\n".join(lines)


def merge_into_catalog(source: DataFrame, name: str, spec: MergeSpec) -> None:
    """Hand the merge to a catalog table that supports MERGE itself."""
    source.sparkSession.sql(merge_statement(name, spec), source=source)
