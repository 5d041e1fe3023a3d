"""Rows carried as JSON arrays."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timewin import naive_utc, utc_instant
from tidemark.functions.types import ZONED_TEXT, to_text

# Rows per array; the direct load path is meant for less than this many.
ARRAY_ROWS = 5_000


def rows_to_json(df: DataFrame, array_rows: int = ARRAY_ROWS) -> DataFrame:
    """Pack rows into JSON arrays of bounded length, one array per output row (``payload``).

    Instants become text first and missing ones JSON null.  Rows are packed where
    they are, inside their own task: nothing is shuffled, no group grows with the
    data, and a repeated task packs the same rows again.
    """
    def field(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = naive_utc(c)
        instant = isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        return (to_text(c) if instant else c).alias(f.name)

    row = F.to_json(F.struct(*[field(f) for f in df.schema.fields]), {"ignoreNullFields": "false"})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["row"].tolist()
            chunks = [texts[i:i + array_rows] for i in range(0, len(texts), array_rows)]
            yield pd.DataFrame({"payload": ["[" + ",".join(c) + "]" for c in chunks]})

    return df.select(row.alias("row")).mapInPandas(pack, "payload string")


def json_to_rows(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """One row per array element, parsed once, its fields read as text and cast to ``schema``.

    Unlike the coercing exports, a value that does not fit its type is an error here.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    elements = df.select(F.explode(F.from_json(F.col(column), T.ArrayType(texts))).alias("element"))

    def value(f: T.StructField):
        text = F.col("element")[f.name]
        if isinstance(f.dataType, T.TimestampType):
            # Text without a zone is UTC whatever the session zone is.
            zoned = text.rlike(ZONED_TEXT)
            civil = F.when(~zoned, text).cast("timestamp_ntz")
            return F.coalesce(F.when(zoned, text).cast(f.dataType), utc_instant(civil))
        return text.cast(f.dataType)

    return elements.select(*[value(f).alias(f.name) for f in schema.fields])
