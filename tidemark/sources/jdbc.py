"""Relational sources read in parallel through JDBC."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.timewin import DEFAULT_ZONE, previous_day_window

# Rows per round trip; the size advised for chunked extraction.
FETCH_SIZE = 50_000


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    """Reader options; civil DATETIME values stay zone-less."""
    return {"url": url, "dbtable": table, "fetchsize": str(FETCH_SIZE), "preferTimestampNTZ": "true", **extra}


def read_table(spark: SparkSession, url: str, table: str, columns: tuple[str, ...], *,
               split_on: str | None = None, lower: object = None, upper: object = None, splits: int = 0,
               one_task: bool = False, **extra: str) -> DataFrame:
    """Explicit columns of a table, read in ``splits`` parallel ranges of ``split_on``.

    Later filters are pushed into each range's query by Spark.  The bounds only set
    the stride; rows outside them are read by the first and last range.  A table that
    one connection may read whole, in one task, has to be named as such (``one_task``).
    """
    options = jdbc_options(url, table, **extra)
    if one_task == (split_on is not None):
        raise ValueError("name a column to split on with its bounds, or ask for one task")
    if split_on is not None and (splits < 2 or lower is None or upper is None):
        raise ValueError("a split read needs both bounds and two or more splits")
    if split_on is not None:
        options |= {"partitionColumn": split_on, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(splits)}
    return spark.read.format("jdbc").options(**options).load().select(*columns)


def window_predicates(column: str, start: datetime, end: datetime, splits: int, closed: str = "left") -> list[str]:
    """Predicates that cut a window into ranges without overlap; ``closed="both"`` includes its end."""
    if closed not in ("both", "left"):
        raise ValueError('closed is "both" or "left"')
    if splits < 1 or end < start:
        raise ValueError("need at least one split and a window that does not end before it starts")
    step = (end - start) / splits
    inner = [start + step * i for i in range(1, splits)]
    inner = [c - timedelta(microseconds=c.microsecond) for c in inner]
    cuts = sorted({start, *(c for c in inner if c > start)})
    ranges = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [*ranges, f"{column} >= '{cuts[-1]}' AND {column} {'<=' if closed == 'both' else '<'} '{end}'"]


def read_window(spark: SparkSession, url: str, table: str, columns: tuple[str, ...], column: str,
                start: datetime, end: datetime, splits: int, closed: str = "left", **extra: str) -> DataFrame:
    """Rows changed in a window, one database query per range."""
    options = jdbc_options(url, table, **extra)
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    reader = spark.read.jdbc(url, table, predicates=window_predicates(column, start, end, splits, closed), properties=properties)
    return reader.select(*columns)


def read_previous_day(spark: SparkSession, url: str, table: str, columns: tuple[str, ...], column: str, run_end: datetime, splits: int,
                      zone: str = DEFAULT_ZONE, **extra: str) -> DataFrame:
    """The day a flow extracts, read in parallel: what :func:`~tidemark.plans.sync.sync_direct` and the exports filter for."""
    start, _ = previous_day_window(run_end, zone)
    return read_window(spark, url, table, columns, column, start, start + timedelta(days=1), splits, **extra)
