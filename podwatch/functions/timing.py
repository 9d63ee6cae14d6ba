"""Time expressions. Run times are given by the caller, so a plan never depends on the wall clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utc_now() -> datetime:
    """The run time of a job; taken once at the start of it."""
    return datetime.now(timezone.utc)


def parse_instant(as_of: datetime | str) -> datetime:
    """A run time as a datetime without zone, in UTC. Text may end in 'Z' or an offset."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of.strip())
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return as_of


def instant(as_of: datetime | str, dtype: T.DataType) -> Column:
    """A literal of the run time in the kind of timestamp a column has, whatever the session zone."""
    text = parse_instant(as_of).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + "Z").cast("timestamp")
    raise TypeError(f"expected a timestamp column, got {dtype.simpleString()}")


def on_grid(as_of: datetime | str, step_minutes: int, up: bool = False) -> datetime:
    """The last poll of the regular grid up to a run time, or with ``up`` the first at or after it."""
    moment, step = parse_instant(as_of), timedelta(minutes=step_minutes)
    past = (moment - datetime(1970, 1, 1)) % step
    return moment + (step - past) if up and past else moment - past


def day_of(as_of: datetime | str, zone: str = "UTC", minutes_ago: int = 0) -> date:
    """Calendar day of a run time, or of a moment some minutes before it, in a zone that is not the session's."""
    moment = parse_instant(as_of) - timedelta(minutes=minutes_ago)
    return moment.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone)).date()


def kind_of(df: DataFrame, column: str) -> T.DataType:
    """Type of a column, its name in any case."""
    return df.select(column).schema[0].dataType


def instant_like(as_of: datetime | str, df: DataFrame, column: str = "timestamp", minutes_ago: int = 0) -> Column:
    """The run time, or a moment some minutes before it, comparable with ``df[column]``."""
    moment = parse_instant(as_of) - timedelta(minutes=minutes_ago)
    return instant(moment, kind_of(df, column))


def collected_instants(row: DataFrame) -> list[datetime | None]:
    """The timestamps of a one-row frame as datetimes without zone, in UTC, whatever the zones of session and driver."""
    plain = [F.col(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.unix_micros(f.name).alias(f.name) for f in row.schema.fields]
    return [datetime(1970, 1, 1) + timedelta(microseconds=v) if isinstance(v, int) else v for v in row.select(*plain).first()]


def after_minutes_ago(df: DataFrame, as_of: datetime | str, minutes: int, column: str = "timestamp") -> Column:
    """Trailing window test: strictly later than ``minutes`` before the run time, with no upper bound."""
    return F.col(column) > instant_like(as_of, df, column, minutes)


def minutes(n: Column | int) -> Column:
    """A duration of ``n`` minutes."""
    if isinstance(n, int):
        return F.lit(timedelta(minutes=n))
    return F.lit(timedelta(minutes=1)) * n


def minute_number(df: DataFrame, column: str) -> Column:
    """Minutes from 1970 to a timestamp of whole minutes, in UTC or without zone, as a bigint; the session's zone plays no part."""
    if isinstance(kind_of(df, column), T.TimestampType):
        return F.expr(f"unix_micros(`{column}`) DIV 60000000")
    since = F.col(column) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days, hours, left = (F.extract(F.lit(unit), since).cast("bigint") for unit in ("DAY", "HOUR", "MINUTE"))
    return days * 1440 + hours * 60 + left


def poll_tick(ts: Column, poll_minutes: int) -> Column:
    """First poll at or after ``ts`` on a regular grid: 12:00:00 stays, 12:00:00.000001 moves on."""
    just_before = ts - F.expr("INTERVAL '0.000001' SECOND")
    return F.window(just_before, f"{poll_minutes} minutes")["end"]


def second_text(ts: Column) -> Column:
    """``2024-01-31 12:34:56``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def stamp_text(ts: Column) -> Column:
    """``20240131123456``."""
    return F.date_format(ts, "yyyyMMddHHmmss")


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; six digits of fraction, or none for a whole second."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")


def parse_iso_utc(text: Column) -> Column:
    """Instant of an ISO-8601 text; text without a zone means UTC."""
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.to_timestamp(zoned)


def elapsed_minutes_text(later: Column, earlier: Column) -> Column:
    """Minutes between two timestamps, to one decimal."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.format_string("%.1f", micros / F.lit(60_000_000.0))
