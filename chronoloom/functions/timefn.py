"""Time arithmetic on columns. All functions assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.schema import duration_seconds

# Fixed value: text form of instants in files and query ranges.
RFC3339_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

_MICROS = 1_000_000


def epoch_micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def epoch_seconds(time: Column) -> Column:
    """Whole epoch seconds, fractions floored."""
    return F.unix_seconds(time.cast("timestamp"))


def from_epoch_seconds(seconds: Column, like: T.DataType) -> Column:
    return F.timestamp_seconds(seconds).cast(like)


def ceil_to(time: Column, every: str = "1m") -> Column:
    """Epoch seconds of the next multiple of ``every`` at or after ``time``, exact in integers."""
    step = duration_seconds(every) * _MICROS
    micros = epoch_micros(time)
    return ((micros + F.pmod(-micros, F.lit(step))) / F.lit(_MICROS)).cast("long")


def floor_seconds(seconds: Column, every: str) -> Column:
    """Epoch seconds rounded down to a multiple of ``every``."""
    return seconds - F.pmod(seconds, F.lit(duration_seconds(every)))


def round_seconds(seconds: Column, every: str) -> Column:
    """Epoch seconds rounded to the nearest multiple of ``every``, ties to the even multiple."""
    step = duration_seconds(every)
    return F.bround(seconds / F.lit(step)).cast("long") * step


def snap(time: Column, every: str = "5m", ceil: str = "1m") -> Column:
    """Ceil to ``ceil``, then round to ``every``; the synchronisation grid, as epoch seconds."""
    return round_seconds(ceil_to(time, ceil), every)


def parse_rfc3339(text: Column, like: T.DataType | str = "timestamp") -> Column:
    """ISO text with ``Z`` or an offset to an instant; unreadable text becomes null."""
    return text.try_cast("timestamp").cast(like)


def format_rfc3339(time: Column) -> Column:
    return F.date_format(time.cast("timestamp"), RFC3339_MILLIS)


def plus(time: Column, every: str, times: Column | int = 1) -> Column:
    """``time`` moved by ``times`` intervals."""
    seconds = F.lit(duration_seconds(every)) * times
    return time + F.make_dt_interval(secs=seconds)


def combine(date: Column, hour: int, minute: int = 0) -> Column:
    """A date with a time of day, as an instant without zone."""
    at = F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute))
    return date.cast("date").cast("timestamp_ntz") + at


def local_time(time: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC instant, daylight saving included."""
    return F.from_utc_timestamp(time.cast("timestamp"), zone).cast("timestamp_ntz")
