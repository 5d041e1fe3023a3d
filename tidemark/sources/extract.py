"""Which rows of a source a run takes.

The predicates compare the bare change column with literals, so they reach the
database or the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timewin import (
    DEFAULT_ZONE, column_type, instant_literal, lookback_cutoff, previous_day_window,
)


def extract_full(source: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return source.select(*columns)


def extract_between(source: DataFrame, column: str, start: datetime, end: datetime, closed: str = "left") -> DataFrame:
    """Rows whose change time lies in a window without its end; ``closed="both"`` includes it."""
    if closed not in ("both", "left"):
        raise ValueError('closed is "both" or "left"')
    dtype = column_type(source, column)
    low, high = instant_literal(start, dtype), instant_literal(end, dtype)
    below = F.col(column) <= high if closed == "both" else F.col(column) < high
    return source.where((F.col(column) >= low) & below)


def extract_previous_day(source: DataFrame, column: str, run_end: datetime, zone: str = DEFAULT_ZONE,
                         closed: str = "left") -> DataFrame:
    """Rows changed on the local day before the run's end.

    The window ends before the next midnight and misses nothing.  ``closed="both"`` ends at
    23:59:59 instead, and so misses fractions of the last second.
    """
    start, end = previous_day_window(run_end, zone)
    return extract_between(source, column, start, end if closed == "both" else start + timedelta(days=1), closed)


def extract_day(source: DataFrame, column: str, day: date) -> DataFrame:
    """``DATE(column) = day`` written as a range."""
    start = datetime(day.year, day.month, day.day)
    return extract_between(source, column, start, start + timedelta(days=1), closed="left")


def extract_recent(source: DataFrame, column: str, now: datetime, zone: str = DEFAULT_ZONE, days: int = 2) -> DataFrame:
    """Look-back: rows changed since the cut-off."""
    cutoff = lookback_cutoff(now, zone, days)
    return source.where(F.col(column) >= instant_literal(cutoff, column_type(source, column)))


def extract_for_load(source: DataFrame, column: str, is_initial: bool, day: date) -> DataFrame:
    """Everything on the first load, one day of changes afterwards."""
    return source if is_initial else extract_day(source, column, day)
