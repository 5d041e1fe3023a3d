"""Scalar functions used by the table scripts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where a table's DDL text names its storage folder.
STORAGE_URI = r'storage_uri\s*=\s*"([^"]+)"'
VERSION_NUMBER = r"(\d+)"


def range_bucket(value: Column, start: int, stop: int, step: int = 1) -> Column:
    """How many bounds of ``start, start+step … stop`` are at or below the value.

    0 is "below the first bound", the last number is "at or above the last one".  Even
    steps are arithmetic: no bound is looked at.
    """
    if step < 1 or stop < start:
        raise ValueError("need a positive step and bounds that do not fall")
    last = (stop - start) // step + 1
    below = F.floor((value - F.lit(start)) / F.lit(step)) + 1
    return F.when(value.isNotNull(), F.when(value >= F.lit(start + (last - 1) * step), last).when(value < F.lit(start), 0).otherwise(below)).cast("int")


def json_value(document: Column, field: str) -> Column:
    """A scalar field of a flat JSON object as text; JSON null and absence are NULL."""
    return F.get_json_object(document, f"$.{field}")


def json_elements(document: Column) -> Column:
    """Elements of a JSON array, each kept as its JSON text."""
    return F.from_json(document, "array<string>")


def storage_uri(ddl: Column) -> Column:
    """Storage folder named in a table's DDL text, NULL if it names none."""
    return F.nullif(F.regexp_extract(ddl, STORAGE_URI, 1), F.lit(""))


def version_number(file_name: Column) -> Column:
    """Number in a metadata file name, so that version 10 sorts after version 9."""
    return F.nullif(F.regexp_extract(file_name, VERSION_NUMBER, 1), F.lit("")).try_cast("bigint")


def compact_day(day: Column) -> Column:
    return F.date_format(day.cast("date"), "yyyyMMdd")
