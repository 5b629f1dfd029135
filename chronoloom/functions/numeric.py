"""Value narrowing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(value: Column, is_float: bool = True) -> Column:
    """The value with NaN read as missing."""
    return F.when(~F.isnan(value), value) if is_float else value


def int8_wrap(value: Column) -> Column:
    """Truncate toward zero, then wrap into -128..127."""
    return F.pmod(value.cast("long") + 128, F.lit(256)) - 128


def int8_try(value: Column) -> Column:
    """Truncate toward zero; null when outside -128..127."""
    return value.try_cast("tinyint").cast("long")


# Fixed values of half precision: bits of the fraction, the least normal exponent, the largest number.
HALF_BITS = 11
HALF_LEAST = -14
HALF_MOST = 65504.0


def half_precision(value: Column) -> Column:
    """The nearest half-precision number, ties to even; infinite beyond the largest one."""
    v = value.cast("double")
    exponent = F.greatest(F.floor(F.log2(F.abs(v))), F.lit(HALF_LEAST))
    unit = F.pow(F.lit(2.0), exponent - (HALF_BITS - 1))
    rounded = F.rint(v / unit) * unit
    beyond = F.abs(rounded) > HALF_MOST
    return F.when(v == 0, v).when(beyond, F.signum(v) * F.lit(float("inf"))).otherwise(rounded)


def narrow(value: Column, mode: str | None, temperature: bool) -> Column:
    """Narrow one field: ``"wrap"`` or ``"try"`` through 8-bit integers, temperatures to half precision."""
    if mode is None:
        return value
    if temperature:
        return half_precision(value)
    if mode == "wrap":
        return int8_wrap(value)
    if mode == "try":
        return int8_try(value)
    raise ValueError(f"unknown narrowing {mode!r}")
