"""Dates and times in mixed spellings, to ISO strings; "" where there is none. Expressions only, ANSI-safe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, strip, text_of

_DAY = r"^\d{4}-\d{2}-\d{2}"
_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?"
_ZONE = r"([+-])(\d{2}):?(\d{2})(:?\d{2})?$"


def _valid_day(c: Column) -> Column:
    """The first ten characters if they are a date of the calendar, else null."""
    return bound(F.substring(c, 1, 10), lambda day: F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.when(day.try_cast("date").isNotNull(), day)))


def _slashed(c: Column) -> Column:
    """d/m/yyyy as a date; "" for impossible ones, null for other spellings."""
    iso = lambda p: F.concat_ws("-", F.get(p, F.lit(2)), F.lpad(F.get(p, F.lit(1)), 2, "0"), F.lpad(F.get(p, F.lit(0)), 2, "0"))
    valid = lambda: bound(bound(F.split(c, "/"), iso), lambda day: F.coalesce(_valid_day(day), F.lit("")))
    return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), valid())


def _raw(c: Column) -> Column:
    return F.regexp_replace(strip(text_of(c)), "Z", "+00:00")


def _is_timed(raw: Column) -> Column:
    return F.contains(raw, F.lit("T")) | F.contains(raw, F.lit("+"))


def _timed_ok(raw: Column) -> Column:
    return raw.rlike(_TIME + rf"({_ZONE[:-1]})?$") | raw.rlike(_DAY + "$")


def date_iso(c: Column) -> Column:
    """The date as written, in its own offset; d/m/yyyy; else the first date-like part, even if no such day exists."""

    def read(raw: Column) -> Column:
        first = F.when(_is_timed(raw), F.when(_timed_ok(raw), _valid_day(raw))).otherwise(_valid_day(raw))
        return F.when(raw == "", "").otherwise(F.coalesce(first, _slashed(raw), F.regexp_extract(raw, r"(\d{4}-\d{2}-\d{2})", 1)))

    return bound(_raw(c), read)


def datetime_iso(c: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss, in UTC if the text has an offset, else as written; dates are midnights."""
    return bound(_raw(c), lambda raw: F.when(raw == "", "").otherwise(_datetime_read(raw)))


def _datetime_read(raw: Column) -> Column:
    seconds = F.regexp_extract(raw, r"^\d{4}-\d{2}-\d{2}[T ](\d{2})", 1), F.regexp_extract(raw, r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:(\d{2})", 1), F.regexp_extract(raw, r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:(\d{2})", 1)
    clock = F.concat_ws(":", *(F.when(x == "", "00").otherwise(x) for x in seconds))
    local = F.try_to_timestamp(F.concat(_valid_day(raw), F.lit(" "), clock, F.lit(" +00:00")), F.lit("yyyy-MM-dd HH:mm:ss xxx"))
    sign = F.when(F.regexp_extract(raw, _ZONE, 1) == "-", -1).otherwise(1)
    number = lambda i: F.coalesce(F.regexp_extract(raw, _ZONE, i).try_cast("int"), F.lit(0))
    offset = F.when(raw.rlike(r"[T ]\d{2}.*" + _ZONE), sign * (number(2) * 3600 + number(3) * 60)).otherwise(0)
    utc = F.timestamp_seconds(F.unix_timestamp(local) - offset)
    written = F.date_format(F.to_utc_timestamp(utc, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    timed = F.when(_timed_ok(raw), written)
    midnight = lambda day: F.when(day == "", "").otherwise(F.concat(day, F.lit("T00:00:00")))
    first = F.when(_is_timed(raw), timed).otherwise(midnight(_valid_day(raw)))
    return F.coalesce(first, midnight(_slashed(raw)), midnight(F.regexp_extract(raw, r"(\d{4}-\d{2}-\d{2})", 1)))


def date_only(c: Column) -> Column:
    """The leading date if it exists, else ""."""
    return F.coalesce(_valid_day(_raw(c)), F.lit(""))


def cutoff(latest: Column, overlap_days: int = 1, now: Column | None = None) -> Column:
    """Where an incremental run starts: midnight `overlap_days` before the day of `latest`, not in the future."""
    start = F.date_trunc("day", latest) - F.make_dt_interval(F.lit(overlap_days))
    return F.least(start, now if now is not None else F.current_timestamp())


def index_timestamp(c: Column) -> Column:
    """The timestamp of a date or time for an index; null where there is none. Texts with an offset are taken to UTC,
    whatever the machine's own zone; others are as written; d/m/yyyy isn't read."""
    raw = _raw(c)
    known = F.when(_is_timed(raw), _timed_ok(raw)).otherwise(_valid_day(raw).isNotNull())
    return F.when(known, F.try_to_timestamp(F.nullif(datetime_iso(c), F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ss")))
