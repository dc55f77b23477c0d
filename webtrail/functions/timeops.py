"""Time operators that do not depend on the session time zone.

Raw event times are UTC instants given as TIMESTAMP, TIMESTAMP_NTZ (UTC wall
clock) or epoch microseconds (BIGINT).  Local wall-clock time is TIMESTAMP_NTZ.
All boundary arithmetic runs on epoch microseconds of NTZ values, which is exact
and independent of ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MICROS_PER_MS = 1_000
MICROS_PER_MINUTE = 60_000_000
DEFAULT_ZONE = "America/New_York"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz_micros(ts) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ value (wall clock read as UTC)."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(ts))


def micros_to_ntz(micros) -> Column:
    return F.timestamp_add("MICROSECOND", _c(micros), F.expr(EPOCH_NTZ))


def utc_ntz(ts, dtype: T.DataType) -> Column:
    """Normalise a raw UTC instant of any accepted type to a UTC TIMESTAMP_NTZ."""
    c = _c(ts)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return micros_to_ntz(c.cast("long"))
    if isinstance(dtype, T.TimestampType):
        return micros_to_ntz(F.unix_micros(c))
    if isinstance(dtype, T.TimestampNTZType):
        return c
    raise TypeError(f"unsupported event time type {dtype}")


def utc_micros(ts, dtype: T.DataType) -> Column:
    """Epoch microseconds of a raw UTC instant of any accepted type (a sortable key)."""
    c = _c(ts)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return c.cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(c)
    raise TypeError(f"unsupported event time type {dtype}")


def to_local(ts, dtype: T.DataType, zone: str = DEFAULT_ZONE) -> Column:
    """UTC instant -> wall clock in ``zone`` (TIMESTAMP_NTZ).  In autumn the wall
    clock repeats an hour; that is kept."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ntz(ts, dtype))


def minute_boundaries(start, end) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end`` (NTZ values):
    10:00:59 -> 10:31:00 gives 31."""
    return (F.floor(ntz_micros(end) / MICROS_PER_MINUTE)
            - F.floor(ntz_micros(start) / MICROS_PER_MINUTE)).cast("long")


def millisecond_boundaries(start, end) -> Column:
    """Number of millisecond boundaries crossed from ``start`` to ``end`` (NTZ values)."""
    return (F.floor(ntz_micros(end) / MICROS_PER_MS) - F.floor(ntz_micros(start) / MICROS_PER_MS)).cast("long")


def add_millis(ts, ms) -> Column:
    return F.timestamp_add("MILLISECOND", _c(ms).cast("long"), _c(ts))
