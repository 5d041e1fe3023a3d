"""Time windows, cut-offs and batch dates.

Everything that depends on "now" takes it as an argument, so a run can be
repeated.  Civil (zone-less) instants are naive ``datetime`` / TIMESTAMP_NTZ.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ZONE = "Asia/Jakarta"
UTC = ZoneInfo("UTC")


def _aware(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


def civil_now(now: datetime, zone: str = DEFAULT_ZONE) -> datetime:
    """Wall clock in ``zone`` at the instant ``now`` (naive input counts as UTC)."""
    return _aware(now).astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def previous_day_window(run_end: datetime, zone: str = DEFAULT_ZONE) -> tuple[datetime, datetime]:
    """Closed window of the local day before ``run_end``, at one-second resolution."""
    day = civil_now(run_end, zone).date() - timedelta(days=1)
    start = datetime(day.year, day.month, day.day)
    return start, start + timedelta(hours=23, minutes=59, seconds=59)


def lookback_cutoff(now: datetime, zone: str = DEFAULT_ZONE, days: int = 2) -> datetime:
    """Wall clock in ``zone`` minus ``days``, read again as if it were UTC."""
    return civil_now(now, zone) - timedelta(days=days)


def batch_date(run_end: datetime, zone: str = DEFAULT_ZONE) -> str:
    """``YYYYMMDD`` of the run's end in ``zone``."""
    return f"{civil_now(run_end, zone):%Y%m%d}"


def shifted_batch_date(run_time: datetime, hours: int = 7) -> str:
    """``YYYYMMDD`` of the run time moved by a fixed number of hours."""
    return f"{_aware(run_time).astimezone(UTC) + timedelta(hours=hours):%Y%m%d}"


def epoch_seconds(moment: datetime) -> int:
    return int(_aware(moment).timestamp())


# --- the same as column expressions --------------------------------------------


def _civil(instant: Column, zone: str, source_zone: str = "UTC") -> Column:
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), instant)


def civil_now_col(naive_utc: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Wall clock in ``zone`` for a zone-less column that holds UTC."""
    return _civil(naive_utc, zone)


def previous_day_bounds(naive_utc: Column, zone: str = DEFAULT_ZONE) -> tuple[Column, Column]:
    midnight = _civil(naive_utc, zone).cast("date").cast("timestamp_ntz")
    return midnight - F.expr("INTERVAL '1' DAY"), midnight - F.expr("INTERVAL '1' SECOND")


def lookback_cutoff_col(naive_utc: Column, zone: str = DEFAULT_ZONE, days: int = 2) -> Column:
    return _civil(naive_utc, zone) - F.make_dt_interval(F.lit(days))


def batch_date_col(naive_utc: Column, zone: str = DEFAULT_ZONE) -> Column:
    # A date cast keeps the result independent of the session zone.
    return F.date_format(_civil(naive_utc, zone).cast("date"), "yyyyMMdd")


def epoch_seconds_col(naive_utc: Column) -> Column:
    return F.unix_seconds(utc_instant(naive_utc))


def current_civil(zone: str = "UTC") -> Column:
    """The current wall clock in ``zone``, the same for every row of a statement."""
    return _civil(naive_utc(F.current_timestamp()), zone)


def utc_instant(naive: Column) -> Column:
    """Label a zone-less column as UTC, whatever the session zone is."""
    return F.make_timestamp_ltz(
        F.year(naive), F.month(naive), F.dayofmonth(naive), F.hour(naive), F.minute(naive),
        F.extract(F.lit("SECOND"), naive), F.lit("UTC"),
    )


def naive_utc(instant: Column) -> Column:
    """UTC wall clock of an instant as a zone-less column, whatever the session zone is."""
    seconds = F.unix_micros(instant).cast(T.DecimalType(24, 6)) / F.lit(1000000)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def instant_literal(value: datetime | date | str, dtype: T.DataType) -> Column:
    """A literal comparable with a column of ``dtype`` that still folds and pushes down."""
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(UTC).replace(tzinfo=None)
    text = value if isinstance(value, str) else f"{value}"
    if isinstance(dtype, T.DateType):
        return F.lit(text[:10]).cast("date")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    stamp = text if len(text) > 10 else f"{text} 00:00:00"
    return F.lit(f"{stamp}Z").cast("timestamp")


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType
