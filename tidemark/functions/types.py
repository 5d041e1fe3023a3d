"""Type mapping and coercion to a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timewin import naive_utc, utc_instant

# A time of day followed by a zone: "…12:30Z", "…12:30:00+07:00", "…12:30 Asia/Jakarta".
ZONED_TEXT = r":\d{2}(:\d{2}(\.\d+)?)?\s*([+-]\d{1,2}(:?\d{2})?|[A-Za-z][A-Za-z/_]*)\s*$"


def map_type(source: T.DataType) -> T.DataType:
    """Table type for an incoming type; integers and floats widen, nested types are refused."""
    if isinstance(source, (T.StringType, T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(source, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(source, T.BooleanType):
        return T.BooleanType()
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampType()
    if isinstance(source, T.DateType):
        return T.DateType()
    if isinstance(source, T.DecimalType):
        return source
    raise ValueError(f"no table type for incoming type {source.simpleString()}")


def sql_type_name(source: T.DataType) -> str:
    """Spark DDL name of :func:`map_type`'s result."""
    return map_type(source).simpleString()


# The table type of each source column type, by name.
SOURCE_TYPES = {
    "tinyint": "bigint",
    "smallint": "bigint",
    "mediumint": "bigint",
    "int": "bigint",
    "bigint": "bigint",
    "varchar": "string",
    "char": "string",
    "text": "string",
    "tinytext": "string",
    "mediumtext": "string",
    "longtext": "string",
    "datetime": "timestamp",
    "datetime2": "timestamp",
    "timestamp": "timestamp",
    "date": "date",
    "float": "double",
    "double": "double",
    "decimal": "decimal(38,9)",
    "numeric": "decimal(38,9)",
    "bit": "boolean",
    "tinyint(1)": "boolean",
    "bool": "boolean",
    "boolean": "boolean",
    "json": "string",
    "blob": "binary",
    "binary": "binary",
}


def source_type(name: str) -> str:
    """Table type for a relational column type such as ``VARCHAR(50)`` or ``TINYINT(1)``."""
    text = name.strip().lower()
    base = text.split("(")[0].strip()
    if base in ("decimal", "numeric") and "(" in text:
        digits = [int(p) for p in text[text.index("(") + 1:text.index(")")].split(",")]
        precision, scale = digits[0], digits[1] if len(digits) > 1 else 0
        if precision > 38:
            raise ValueError(f"{name}: more than 38 digits")
        return f"decimal({precision},{scale})"
    found = SOURCE_TYPES.get(text) or SOURCE_TYPES.get(base)
    if found is None:
        raise ValueError(f"no table type for source type {name}")
    return found


# --- coercion: bad values become NULL, never an error --------------------------------


def to_text(column: Column) -> Column:
    """Text form; NULL stays NULL, as do the markers a text hop leaves behind."""
    text = column.cast("string")
    return F.when(~text.isin("NaT", "nan"), text)


def to_number(column: Column) -> Column:
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_day(column: Column, source: T.DataType) -> Column:
    if isinstance(source, T.TimestampType):
        return naive_utc(column).cast("date")
    if isinstance(source, (T.DateType, T.TimestampNTZType)):
        return column.cast("date")
    return column.cast("string").try_cast("date")


def to_instant(column: Column, source: T.DataType) -> Column:
    """Instant in UTC: aware values are converted, naive ones are labelled UTC."""
    if isinstance(source, T.TimestampType):
        return column
    if isinstance(source, (T.TimestampNTZType, T.DateType)):
        return utc_instant(column.cast("timestamp_ntz"))
    text = column.cast("string")
    zoned = text.rlike(ZONED_TEXT)
    # The branch not taken sees NULL, so neither parse can be misled by the other form.
    return F.coalesce(
        F.when(zoned, text).try_cast("timestamp"),
        utc_instant(F.when(~zoned, text).try_cast("timestamp_ntz")),
    )


def to_civil(column: Column, source: T.DataType) -> Column:
    """Zone-less wall clock, for tables that keep DATETIME rather than TIMESTAMP."""
    if isinstance(source, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp_ntz")
    if isinstance(source, T.TimestampType):
        return naive_utc(column)
    return column.cast("string").try_cast("timestamp_ntz")


def coerce(column: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.StringType):
        return column.cast("string")
    if isinstance(target, T.DoubleType):
        return to_number(column)
    if isinstance(target, T.DateType):
        return to_day(column, source)
    if isinstance(target, T.TimestampType):
        return to_instant(column, source)
    if isinstance(target, T.TimestampNTZType):
        return to_civil(column, source)
    return column.try_cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types; a missing one is NULL."""
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for want in schema.fields:
        got = have.get(want.name.lower())
        value = F.lit(None).cast(want.dataType) if got is None else coerce(F.col(f"`{got.name}`"), got.dataType, want.dataType)
        out.append(value.alias(want.name))
    return df.select(*out)
