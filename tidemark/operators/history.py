"""Past states from the append-only history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timewin import column_type, instant_literal
from tidemark.model import ChangeTable
from tidemark.operators.dedup import latest_per_key, orderable

VALID_FROM, VALID_TO = "valid_from", "valid_to"

# Hours a deleted row can be asked for by time travel, and for how many more by support, by kind of table.
TRAVEL_HOURS = (48, 72, 96, 120, 144, 168)
SAFE_HOURS = {"managed": 0, "native": 168}


def as_of(history: DataFrame, change: ChangeTable, moment: datetime | str) -> DataFrame:
    """The live rows as they stood at ``moment``: newest version by then, without deleted ones."""
    version = change.version
    seen = history.where(F.col(version) <= instant_literal(moment, column_type(history, version)))
    return latest_per_key(seen, change.key, version).where(F.col(change.tombstone).isNull())


def expired(df: DataFrame, change: ChangeTable, now: datetime | str, hours: int) -> DataFrame:
    """Rows deleted at least ``hours`` before ``now``; a tombstone that lies ahead deletes nothing yet."""
    moment = instant_literal(now, column_type(df, change.tombstone))
    return df.where(F.col(change.tombstone) <= moment - F.make_dt_interval(hours=F.lit(hours)))


def latest_state(history: DataFrame, change: ChangeTable) -> DataFrame:
    """The live rows now."""
    return latest_per_key(history, change.key, change.version).where(F.col(change.tombstone).isNull())


# --- many moments -----------------------------------------------------------------------


def validity(history: DataFrame, change: ChangeTable) -> DataFrame:
    """Every version with the time it was the newest of its key: ``valid_from`` up to, not including, ``valid_to``.

    NULL in ``valid_to``: it still is.  Of equal versions the one :func:`latest_per_key` takes counts, the others have
    an empty time; rows without a version never were the newest by any moment and are left out.  Successors
    are looked for within a key and day first, and then among the days of the key, so a key that has very many
    versions is as many tasks' work as it has days.
    """
    taken = {VALID_FROM, VALID_TO} & set(history.columns)
    if taken:
        raise ValueError(f"the history has columns {sorted(taken)} already")
    key, version = F.struct(*[F.col(f"`{k}`") for k in change.key]), F.col(f"`{change.version}`")
    rows = history.where(version.isNotNull()).withColumns({"__key": key, "__day": F.to_date(version)})
    ties = [f.name for f in history.schema.fields if f.name not in change.key and f.name != change.version and orderable(f.dataType)]
    order = [F.col(f"`{c}`").asc_nulls_first() for c in (change.version, *ties)]
    follows = F.lead(version).over(Window.partitionBy("__key", "__day").orderBy(*order))
    days = rows.groupBy("__key", "__day").agg(F.min(version).alias("__first"))
    days = days.withColumn("__next", F.lead("__first").over(Window.partitionBy("__key").orderBy("__day"))).drop("__first")
    found = rows.withColumn("__follows", follows).join(days, ["__key", "__day"])
    return found.withColumns({VALID_FROM: version, VALID_TO: F.coalesce("__follows", "__next")}).drop("__key", "__day", "__follows", "__next")


def at_moments(spans: DataFrame, moments: DataFrame, moment: str = "moment") -> DataFrame:
    """Each row of ``spans`` once for every moment in ``valid_from <= moment < valid_to`` (NULL: open), with that moment.

    Spans are joined with moments on the day, for the days that have moments: a row is moved as often as it is in the
    result, and once more at most at either end.  The driver holds one date per such day.
    """
    if moment in spans.columns:
        raise ValueError(f"the spans have a column {moment} already")
    asked = moments.select(F.col(moment).cast(column_type(spans, VALID_FROM)).alias(moment)).where(F.col(moment).isNotNull()).distinct()
    asked = asked.withColumn("__day", F.to_date(moment))
    days = [r["__day"] for r in asked.select("__day").distinct().orderBy("__day").collect()]
    listed = F.array(*[F.lit(d) for d in days]).cast("array<date>")
    first, last = F.to_date(VALID_FROM), F.to_date(VALID_TO)

    def covered(day: Column) -> Column:
        return (F.col(VALID_FROM).isNull() | (day >= first)) & (F.col(VALID_TO).isNull() | (day <= last))

    dealt = spans.withColumn("__day", F.explode(F.filter(listed, covered)))
    inside = (F.col(VALID_FROM).isNull() | (F.col(VALID_FROM) <= F.col(moment))) & (F.col(VALID_TO).isNull() | (F.col(moment) < F.col(VALID_TO)))
    return dealt.join(asked, "__day").where(inside).drop("__day")


def as_of_many(history: DataFrame, change: ChangeTable, moments: DataFrame, moment: str = "moment") -> DataFrame:
    """:func:`as_of` for every moment of a frame at once: the live rows of each, with the ``moment``; the history is read once."""
    spans = validity(history, change).where(F.col(change.tombstone).isNull())
    return at_moments(spans, moments, moment).drop(VALID_FROM, VALID_TO)


# --- the life of a deleted row ----------------------------------------------------------


def lifetimes(df: DataFrame, change: ChangeTable, hours: tuple[int, ...] = TRAVEL_HOURS, kinds: dict[str, int] | None = None) -> DataFrame:
    """Every row with the states it passes through, for each window and kind of table.

    ``kind, hours, state, valid_from, valid_to``: ``visible`` until it is deleted, ``recoverable`` by time travel for
    ``hours`` after that, ``fail_safe`` for as long as the kind of table keeps it for support, then ``gone``.  A row that
    was not deleted is visible without end.  States that last no time are left out.
    """
    if any(h % 24 or not 48 <= h <= 168 for h in hours):
        raise ValueError("a window has 48 to 168 hours, in steps of 24")
    kinds = SAFE_HOURS if kinds is None else kinds
    dtype, gone = column_type(df, change.tombstone), F.col(f"`{change.tombstone}`")
    never = F.lit(None).cast(dtype)
    spans = []
    for kind, safe in kinds.items():
        for window in hours:
            lost = gone + F.make_dt_interval(hours=F.lit(window))
            wiped = gone + F.make_dt_interval(hours=F.lit(window + safe))
            steps = [("visible", never, gone), ("recoverable", gone, lost), ("fail_safe", lost, wiped), ("gone", wiped, never)]
            spans += [F.struct(F.lit(kind).alias("kind"), F.lit(window).alias("hours"), F.lit(state).alias("state"),
                               start.cast(dtype).alias(VALID_FROM), end.cast(dtype).alias(VALID_TO))
                      for state, start, end in steps if state != "fail_safe" or safe]
    every = F.filter(F.array(*spans), lambda s: gone.isNotNull() | (s["state"] == "visible"))
    return df.withColumn("__span", F.explode(every)).select(*[F.col(f"`{c}`") for c in df.columns], "__span.*")


def states_at(df: DataFrame, change: ChangeTable, moments: DataFrame, moment: str = "moment", **windows) -> DataFrame:
    """The state of every row at every moment, for each window and kind of table (see :func:`lifetimes`)."""
    return at_moments(lifetimes(df, change, **windows), moments, moment).drop(VALID_FROM, VALID_TO)
