"""Totals and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped_totals(df: DataFrame, group: str, value: str, count_name: str, sum_name: str) -> DataFrame:
    """Rows and sum per group, largest group first; NULL is a group of its own.

    Money held as a double is summed as a decimal, so the total does not depend on
    the order in which tasks finish.
    """
    total = F.sum(F.col(value).cast("decimal(18,2)")).cast("double")
    return df.groupBy(group).agg(F.count(F.lit(1)).alias(count_name), total.alias(sum_name)).orderBy(F.desc(count_name))


def top_rows(df: DataFrame, by: str, n: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """Preview of the ``n`` rows with the greatest ``by``; each task keeps at most ``n``."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]).limit(n)
