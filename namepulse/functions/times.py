"""Time functions. The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column

# Formats of record times, segment names and sensor times.
RECORD_TIME = "yyyyMMddHHmmss"
SEGMENT_TIME = "yyyyMMddHHmm'00'"
SENSOR_TIME = "MM/dd/yy:hh:mm"
SENSOR_TIME_24H = "MM/dd/yy:HH:mm"
DAY = "yyyy-MM-dd"
DAY_FIRST = "dd-MM-yyyy"

# One segment covers 15 minutes, a mention counts for an hour.
SEGMENT_MINUTES = 15
WINDOW_SECONDS = 3600


def day_text(ts: Column | str, fmt: str = DAY) -> Column:
    return F.date_format(as_column(ts), fmt)


def day_of_digits(c: Column | str, fmt: str = DAY_FIRST) -> Column:
    """The day of a `yyyyMMdd...` text, without parsing; NULL when it is too short."""
    c = as_column(c)
    year, month, day = F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)
    if fmt == DAY_FIRST:
        text = F.concat_ws("-", day, month, year)
    elif fmt == DAY:
        text = F.concat_ws("-", year, month, day)
    else:
        raise ValueError(f"day format must be {DAY_FIRST!r} or {DAY!r}")
    return F.when(F.length(c) >= 8, text)


def parse_record_time(c: Column | str) -> Column:
    return F.try_to_timestamp(as_column(c), F.lit(RECORD_TIME))


def parse_sensor_time(c: Column | str, hours_24: bool = False) -> Column:
    return F.try_to_timestamp(
        as_column(c), F.lit(SENSOR_TIME_24H if hours_24 else SENSOR_TIME)
    )


def parse_day(c: Column | str, fmt: str = DAY) -> Column:
    return F.to_date(as_column(c), fmt)


def whole_seconds(ts: Column | str) -> Column:
    return F.unix_seconds(as_column(ts))


def plus_minutes(ts: Column | str, minutes: int) -> Column:
    return as_column(ts) + F.make_dt_interval(mins=F.lit(minutes))


def _interval_seconds(minutes: int) -> int:
    if minutes <= 0 or 60 % minutes:
        raise ValueError("the interval must divide an hour")
    return minutes * 60


def floor_to(ts: Column | str, minutes: int = SEGMENT_MINUTES) -> Column:
    """Start of the interval that holds `ts`."""
    step, secs = _interval_seconds(minutes), whole_seconds(ts)
    return F.timestamp_seconds(secs - F.pmod(secs, F.lit(step)))


def next_boundary(ts: Column | str, minutes: int = SEGMENT_MINUTES) -> Column:
    """The first interval boundary strictly after the minute of `ts`."""
    step, secs = _interval_seconds(minutes), whole_seconds(ts)
    return F.timestamp_seconds(secs - F.pmod(secs, F.lit(step)) + step)


def segment_name(ts: Column | str, extension: str = "") -> Column:
    return F.concat(F.date_format(as_column(ts), SEGMENT_TIME), F.lit(extension))


def segment_start_of_key(key: Column | str) -> Column:
    """Start of a segment, from the key of its first record; seconds are dropped."""
    return F.try_to_timestamp(F.substring(as_column(key), 1, 12), F.lit("yyyyMMddHHmm"))


def segment_names(
    now: Column | str,
    window_minutes: int = 60,
    minutes: int = SEGMENT_MINUTES,
    extension: str = "",
) -> Column:
    """Names of the segments in a window that ends one interval before the last boundary."""
    last = plus_minutes(floor_to(now, minutes), -minutes)
    first = plus_minutes(last, minutes - window_minutes)
    if window_minutes < minutes:
        return F.array().cast("array<string>")
    step = F.make_dt_interval(mins=F.lit(minutes))
    return F.transform(
        F.sequence(first, last, step), lambda t: segment_name(t, extension)
    )


def spread_millis(
    start: Column | str,
    position: Column | str,
    total: Column | str,
    minutes: int = SEGMENT_MINUTES,
) -> Column:
    """Epoch milliseconds of line `position` (from 0) of `total` lines spread over an interval.

    Line p of n is p / n of the interval after its start, cut to whole milliseconds, however
    many lines there are: times never fall and all of the interval is used.
    """
    passed = as_column(position).cast("bigint") * F.lit(minutes * 60_000).cast("bigint")
    return F.unix_millis(as_column(start)) + F.call_function("div", passed, as_column(total))
