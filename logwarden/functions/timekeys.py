"""Wall-clock times as exact microsecond counts, without going through a time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
_EPOCH = "1970-01-01 00:00:00"


def epoch_micros(time: Column) -> Column:
    """Microseconds since 1970 on the same clock as ``time``; NULL stays NULL."""
    elapsed = time.cast("timestamp_ntz") - F.lit(_EPOCH).cast("timestamp_ntz")
    seconds = elapsed.cast("interval second").cast("decimal(20,6)")
    return (seconds * MICROS).cast("bigint")


def wall_clock(micros: Column) -> Column:
    """The TIMESTAMP_NTZ that lies ``micros`` after 1970."""
    return F.timestamp_add("MICROSECOND", micros, F.lit(_EPOCH).cast("timestamp_ntz"))


def interval_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two microsecond counts."""
    return (later - earlier) / MICROS
