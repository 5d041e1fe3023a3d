"""Ranges of equal work for a parallel extract, from the quantiles of a column instead of its bounds.

Even steps in time put a nightly bulk update into one range.  Quantiles of the change column, from one aggregate over what is
known of the source (yesterday's batch, the history, or the column itself), cut where the rows are.  A value that
fills ranges by itself is cut further by a second, numeric column.  The ranges cover every value, NULL and values beyond those
seen included, without gap or overlap, so a source that has changed meanwhile only makes them uneven.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timewin import naive_utc
from tidemark.sources.jdbc import jdbc_options

ACCURACY = 200  # of the sketch, for each range


@dataclass(frozen=True)
class Cut:
    """A range starts here: at a value, as SQL and as a number, and from a value of the second column on, if one is named."""

    value: str
    ordinal: int | float
    tie: int | None = None


@dataclass(frozen=True)
class Ranges:
    column: str
    cuts: tuple[Cut, ...]
    tie: str | None = None

    def _from(self, cut: Cut) -> str:
        if cut.tie is None:
            return f"{self.column} >= {cut.value}"
        return f"({self.column} > {cut.value} OR ({self.column} = {cut.value} AND {self.tie} >= {cut.tie}))"

    def _before(self, cut: Cut) -> str:
        if cut.tie is None:
            return f"{self.column} < {cut.value}"
        # What has no second value lies before every cut within its own value.
        return f"({self.column} < {cut.value} OR ({self.column} = {cut.value} AND ({self.tie} < {cut.tie} OR {self.tie} IS NULL)))"

    def predicates(self, within: str | None = None) -> list[str]:
        """One SQL predicate per range; ``within`` is one that holds for all, such as the window of a run."""
        if not self.cuts:
            ranges = [f"({self.column} IS NULL OR {self.column} IS NOT NULL)"]
        else:
            ranges = [f"({self._before(self.cuts[0])} OR {self.column} IS NULL)"]
            ranges += [f"({self._from(a)} AND {self._before(b)})" for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
            ranges.append(f"({self._from(self.cuts[-1])})")
        return [f"{r} AND ({within})" if within else r for r in ranges]

    def number(self, rows: DataFrame) -> Column:
        """The range of each row, from 0, as a column."""
        at = _ordinal(F.col(f"`{self.column}`"), rows.schema[self.column].dataType)
        if not self.cuts:
            return F.lit(0)
        second = F.col(f"`{self.tie}`") if self.tie else F.lit(None)
        cuts = F.array(*[F.struct(F.lit(c.ordinal).alias("v"), F.lit(c.tie).cast("long").alias("t")) for c in self.cuts])
        behind = F.filter(cuts, lambda c: (c["v"] < at) | ((c["v"] == at) & (c["t"].isNull() | F.coalesce(c["t"] <= second, F.lit(False)))))
        return F.when(at.isNull(), 0).otherwise(F.size(behind))


def _ordinal(column: Column, dtype: T.DataType) -> Column:
    """A number in the order of the column."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(dtype, T.NumericType):
        return column
    raise TypeError(f"ranges are cut on instants, dates and numbers, not {dtype.simpleString()}")


def quantile_ranges(known: DataFrame, column: str, splits: int, tie: str | None = None) -> Ranges:
    """Up to ``splits`` ranges of about as many rows of ``known`` each; ``tie`` is a numeric column to cut equal values by.

    Instants are written as UTC wall clock, as the sources hold them.  The driver gets one cut per range.
    """
    if splits < 1:
        raise ValueError("at least one range")
    dtype = known.schema[column].dataType
    value, ordinal = F.col(f"`{column}`"), _ordinal(F.col(f"`{column}`"), dtype)
    shares = [k / splits for k in range(1, splits)]
    if not shares:
        return Ranges(column, (), tie)
    found = known.where(value.isNotNull()).agg(F.percentile_approx(ordinal, shares, ACCURACY * splits).alias("q")).collect()[0]["q"] or []
    times = {q: found.count(q) for q in found}
    heavy = {q: n for q, n in times.items() if n > 1 and tie is not None}
    inner: dict = {}
    ordered = sorted(times)
    following = dict(zip(ordered, ordered[1:], strict=False))
    if heavy:
        # Equal values that are n cuts at once fill n - 1 ranges and parts of two more.
        asked = reduce(lambda rest, q: F.when(ordinal == q, F.lit(q)).otherwise(rest), heavy, F.lit(None))
        most = max(heavy.values())
        steps = [k / (most + 1) for k in range(1, most + 1)]
        groups = known.withColumn("__q", asked).where("__q is not null").groupBy("__q")
        second = F.col(f"`{tie}`").cast("double")
        for r in groups.agg(F.percentile_approx(second, steps, ACCURACY * most).alias("t"), F.max(second).alias("last")).collect():
            wanted = heavy[r["__q"]]
            every = r["t"] or []
            chosen = [every[round((k + 1) * (most + 1) / (wanted + 1)) - 1] for k in range(wanted)] if every else []
            # What follows the value, up to the next cut, is a range of its own, unless that is cut in pieces as well.
            behind = [] if r["last"] is None or following.get(r["__q"]) in heavy else [r["last"] + 1]
            inner[r["__q"]] = sorted({int(t // 1) for t in chosen + behind})
    texts = _texts(known.sparkSession, sorted(times), dtype)
    cuts = []
    for q in sorted(times):
        cuts.append(Cut(texts[q], q))
        cuts += [Cut(texts[q], q, t) for t in inner.get(q, [])]
    return Ranges(column, tuple(cuts), tie)


def _texts(spark: SparkSession, ordinals: list, dtype: T.DataType) -> dict:
    """The values as SQL literals."""
    if isinstance(dtype, T.NumericType) or not ordinals:
        return {q: str(q) for q in ordinals}
    if isinstance(dtype, T.DateType):
        shown = F.date_from_unix_date(F.col("q").cast("int")).cast("string")
    else:
        shown = naive_utc(F.timestamp_micros("q")).cast("string")
    rows = spark.createDataFrame([(q,) for q in ordinals], "q long").select("q", shown.alias("text")).collect()
    return {r["q"]: f"'{r['text']}'" for r in rows}


def read_ranges(spark: SparkSession, url: str, table: str, columns: tuple[str, ...], ranges: Ranges, within: str | None = None, **extra: str) -> DataFrame:
    """A table, or the part of it that a predicate names, with one database query per range."""
    options = jdbc_options(url, table, **extra)
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=ranges.predicates(within), properties=properties).select(*columns)
