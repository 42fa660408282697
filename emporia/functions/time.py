"""Epoch and local-time helpers."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour: local dates are
# taken in Asia/Shanghai, and an epoch below 10^12 is in seconds (at or
# above it, milliseconds).
DEFAULT_TZ = "Asia/Shanghai"
SECONDS_LIMIT = 10**12


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _session_tz() -> str:
    spark = SparkSession.getActiveSession()
    return spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"


def epoch_ms(ts) -> Column:
    """Seconds or milliseconds epoch -> milliseconds (null stays null)."""
    ts = _col(ts)
    return F.when(ts < F.lit(SECONDS_LIMIT), ts * 1000).otherwise(ts)


def local_time(ms, tz: str = DEFAULT_TZ) -> Column:
    """Epoch milliseconds -> wall-clock TIMESTAMP_NTZ in ``tz``."""
    instant = F.timestamp_millis(_col(ms).cast("long"))
    return F.convert_timezone(F.lit(_session_tz()), F.lit(tz), instant.cast("timestamp_ntz"))


def local_date(ms, tz: str = DEFAULT_TZ) -> Column:
    """Calendar date of an epoch in ``tz``."""
    return F.to_date(local_time(ms, tz))


def local_time_str(ms, tz: str = DEFAULT_TZ) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` wall clock in ``tz``."""
    return F.date_format(local_time(ms, tz), "yyyy-MM-dd HH:mm:ss")


def ntz_epoch_ms(ts_ntz, tz: str = "UTC") -> Column:
    """Milliseconds since epoch of a wall-clock TIMESTAMP_NTZ read in ``tz``."""
    as_session = F.convert_timezone(F.lit(tz), F.lit(_session_tz()), _col(ts_ntz))
    return F.unix_millis(as_session.cast("timestamp"))


def seconds_of_day(ts) -> Column:
    """Whole seconds since the wall-clock midnight of ``ts``."""
    ts = _col(ts)
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def event_time(ts, insert_time) -> Column:
    """String epoch -> event time (TIMESTAMP).

    Non-empty ``ts``: drop a fractional part to judge its length; up to 10
    characters means seconds (scaled by 1000 after a DOUBLE cast and then
    truncated), longer means milliseconds.  Null or empty ``ts`` falls back to
    ``insert_time`` (milliseconds).  Unparsable text gives null, as a
    lenient JSON reader would.
    """
    ts = _col(ts)
    as_double = ts.try_cast("double")
    short = F.char_length(F.regexp_replace(ts, r"\.\d+", "")) <= 10
    from_ts = F.when(short, (as_double * 1000).try_cast("long")).otherwise(as_double.try_cast("long"))
    ms = F.when(ts.isNotNull() & (ts != ""), from_ts).otherwise(_col(insert_time))
    return F.timestamp_millis(ms)


def wall_clock(ts, tz: str = "UTC") -> Column:
    """An instant (TIMESTAMP) as TIMESTAMP_NTZ wall clock in ``tz``."""
    return F.convert_timezone(F.lit(_session_tz()), F.lit(tz), _col(ts).cast("timestamp_ntz"))


def day_window_offset(tz: str = DEFAULT_TZ, on: str = "2024-01-01") -> str:
    """``startTime`` that aligns ``window(ts, '1 day')`` to local midnight in
    ``tz`` (fixed-offset zones; e.g. '16 hours' for UTC+8)."""
    import datetime as dt
    from zoneinfo import ZoneInfo

    off = dt.datetime.fromisoformat(on).replace(tzinfo=ZoneInfo(tz)).utcoffset() or dt.timedelta(0)
    minutes = int((-off.total_seconds() // 60) % (24 * 60))
    return f"{minutes} minutes"


def daily_window(ts, tz: str = DEFAULT_TZ) -> Column:
    """Tumbling one-day event-time window aligned to local midnight."""
    return F.window(_col(ts), "1 day", startTime=day_window_offset(tz))
