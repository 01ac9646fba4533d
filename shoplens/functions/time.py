"""Epoch-millisecond time helpers that do not depend on the session time zone
unless asked to (``tz=None`` means "the session time zone", the Spark analogue
of the JVM default zone used by the original jobs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shoplens.defaults import DAY_FORMAT, TREND_LABEL


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_of_ntz(ts) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` read as UTC wall-clock time."""
    ts = _col(ts)
    inst = F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                            F.minute(ts), F.date_part(F.lit("SECOND"), ts), F.lit("UTC"))
    return F.unix_millis(inst)


def instant_of(ms) -> Column:
    """Epoch ms -> ``timestamp`` (an instant; what watermarks and windows need)."""
    return F.timestamp_millis(_col(ms))


def local_time_of(ms, tz: str | None = None) -> Column:
    """Epoch ms -> ``timestamp_ntz`` wall-clock time in ``tz``."""
    utc = F.timestamp_add("MILLISECOND", _col(ms), _epoch_ntz())
    if tz == "UTC":
        return utc
    target = F.current_timezone() if tz is None else F.lit(tz)
    return F.convert_timezone(F.lit("UTC"), target, utc)


def day_of(ms, tz: str | None = None) -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` in ``tz``."""
    return F.date_format(local_date_of(ms, tz), DAY_FORMAT)


def local_date_of(ms, tz: str | None = None) -> Column:
    """Epoch ms -> ``date`` in ``tz``. For UTC this is integer arithmetic on the
    epoch ms (no per-row calendar conversion); group on this and format the
    day string once per group."""
    if tz == "UTC":
        return F.date_from_unix_date(
            ((_col(ms) - F.pmod(_col(ms), F.lit(86_400_000))) / F.lit(86_400_000)).cast("int"))
    return F.to_date(local_time_of(ms, tz))


def time_label(ms, fmt: str = TREND_LABEL, tz: str | None = None) -> Column:
    return F.date_format(local_time_of(ms, tz), fmt)


def bucket_start(ms, bucket_ms: int) -> Column:
    """Start of the ``bucket_ms``-wide bucket holding ``ms`` (epoch-aligned floor,
    in exact integer arithmetic; ``pmod`` keeps times before 1970 aligned too)."""
    m = _col(ms)
    return m - F.pmod(m, F.lit(int(bucket_ms)))


def bucket_index(ms, bucket_ms: int) -> Column:
    """Index of the ``bucket_ms``-wide bucket holding ``ms`` (epoch-aligned)."""
    # an exact multiple divided by its factor: exact for any epoch-ms value (< 2^53)
    return (bucket_start(ms, bucket_ms) / F.lit(int(bucket_ms))).cast("bigint")
