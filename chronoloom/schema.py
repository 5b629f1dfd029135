"""The long-form point table, series keys, durations and instants."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME = "_time"
FIELD = "_field"
VALUE = "_value"
VALUE_TEXT = "_value_text"
MEASUREMENT = "_measurement"
BUCKET = "bucket"

# The key columns and temperature fields the synchroniser assumes by default.
SYNC_KEYS = ("system_id", "floor", "equipment_number")
TEMPERATURE_FIELDS = ("room_temperature", "setpoint_temperature")

# Duration units of window and range arguments, in seconds.
UNIT_SECONDS = {
    "s": 1, "second": 1, "seconds": 1,
    "m": 60, "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
    "w": 604800, "week": 604800, "weeks": 604800,
}

_PART = re.compile(r"(\d+)\s*([a-z]+)")
_INSTANT = re.compile(
    r"(\d{4})-(\d{1,2})-(\d{1,2})"
    r"(?:[T ](\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.(\d{1,9}))?)?)?"
    r"\s*(Z|[+-]\d{2}:?\d{2})?$"
)


def point_schema(tags: Iterable[str] = ()) -> T.StructType:
    """Schema of a long-form point table with the given tag columns."""
    fields = [
        T.StructField(BUCKET, T.StringType()),
        T.StructField(MEASUREMENT, T.StringType()),
        T.StructField(TIME, T.TimestampType()),
        T.StructField(FIELD, T.StringType()),
        T.StructField(VALUE, T.DoubleType()),
    ]
    return T.StructType(fields + [T.StructField(tag, T.StringType()) for tag in tags])


def duration_seconds(text: str | int) -> int:
    """``"30m"``, ``"1h30m"`` or ``"5 minutes"`` as seconds; integers are seconds already."""
    if isinstance(text, int):
        return text
    compact = text.strip().lower()
    parts = _PART.findall(compact)
    if not parts or _PART.sub("", compact).strip():
        raise ValueError(f"not a duration: {text!r}")
    unknown = [unit for _, unit in parts if unit not in UNIT_SECONDS]
    if unknown:
        raise ValueError(f"unknown duration unit {unknown[0]!r} in {text!r}")
    return sum(int(number) * UNIT_SECONDS[unit] for number, unit in parts)


def parse_instant(value: str | int | float | datetime, as_of: datetime | None = None) -> datetime:
    """A range bound as a naive UTC datetime.

    Accepts a datetime, epoch seconds, ISO text (days without a leading zero included) and, given
    ``as_of``, a relative bound such as ``"-100d"``.
    """
    if isinstance(value, datetime):
        return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
    if isinstance(value, (int, float)) or re.fullmatch(r"\d+", value.strip()):
        return datetime(1970, 1, 1) + timedelta(seconds=float(value))
    text = value.strip()
    if text.startswith("-"):
        if as_of is None:
            raise ValueError(f"relative bound {value!r} needs as_of")
        return as_of - timedelta(seconds=duration_seconds(text[1:]))
    match = _INSTANT.match(text)
    if not match:
        raise ValueError(f"not an instant: {value!r}")
    year, month, day, hour, minute, second, fraction, zone = match.groups()
    moment = datetime(
        int(year), int(month), int(day), int(hour or 0), int(minute or 0), int(second or 0),
        int((fraction or "0").ljust(6, "0")[:6]),
    )
    if zone and zone != "Z":
        sign = 1 if zone[0] == "+" else -1
        moment -= sign * timedelta(hours=int(zone[1:3]), minutes=int(zone[-2:]))
    return moment


def epoch_of(moment: datetime) -> float:
    return (moment - datetime(1970, 1, 1)).total_seconds()


def instant_literal(moment: datetime, like: T.DataType) -> Column:
    """A literal of the time column's own type, so that comparisons reach the file scan."""
    return F.lit(moment.isoformat(sep=" ")).cast(like)


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def series_keys(df: DataFrame, drop: Sequence[str] = ()) -> list[str]:
    """Default series keys: every string column of a point table but the values, as number or as text."""
    skip = {TIME, VALUE, VALUE_TEXT, *drop}
    return [f.name for f in df.schema if f.name not in skip and isinstance(f.dataType, T.StringType)]
