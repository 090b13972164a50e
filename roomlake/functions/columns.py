"""Column expressions shared by the jobs (all Catalyst built-ins).

PRJ-3/4  flexible ISO-8601 instants
PRJ-9    date / hour extraction
PRJ-11   surrogate keys
PRJ-12   hour truncation
FLT-2    incremental look-back cutoff
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# An ISO-8601 instant with an explicit offset: '...Z' or '...+hh:mm'.  Strings
# without an offset are rejected (the source parser throws on them).
ISO_INSTANT_RE = (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
                  r"(Z|[+-]\d{2}:\d{2}(:\d{2})?)$")

# Null stand-in inside surrogate keys; any fixed string works as long as both
# the writer and the readers of a table use the same one.
KEY_NULL = "_roomlake_null_"
KEY_SEP = "-"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` names it.

    A plain expression repeats its argument wherever it names it, and again in every filter it is pushed into.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _canonical_utc(s: Column) -> Column:
    """Cheap test (no regex) for the common 'YYYY-MM-DDTHH:MM:SS[.f]Z' form;
    Spark's cast then validates the digits (NULL when they are not)."""
    return ((F.length(s) >= 20) & (F.substring(s, 11, 1) == F.lit("T"))
            & (F.substring(s, 17, 1) == F.lit(":")) & s.endswith("Z"))


def iso_instant(c) -> Column:
    """Parse an ISO-8601 instant with offset; NULL when absent or malformed.

    As ISO parsers do, letters are case-insensitive and seconds optional
    ('...T17:51Z'); Spark's cast needs upper case and seconds, so both are
    normalised first.
    """
    def parse(raw: Column) -> Column:
        s = F.regexp_replace(F.upper(raw), r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})(Z|[+-])", "$1:00$2")
        return (F.when(_canonical_utc(raw), F.try_to_timestamp(raw))
                 .otherwise(bound(s, lambda x: F.when(x.rlike(ISO_INSTANT_RE), F.try_to_timestamp(x)))))

    return bound(F.trim(_c(c)), parse)


def naive_as_utc(c) -> Column:
    """Timestamp string -> TIMESTAMP, reading strings without an offset as UTC
    (not the session zone); strings with an offset or 'Z' keep theirs."""
    s = F.trim(_c(c))
    has_zone = s.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.try_to_timestamp(F.when(has_zone, s).otherwise(F.concat(s, F.lit("Z"))))


ISO_LENIENT_RE = (r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?"
                  r"(Z|[+-]\d{2}:\d{2}(:\d{2})?)?$")


def iso_timestamp(c) -> Column:
    """Lenient ISO-8601 for batch tables (PRJ-4): an offset is optional (none
    means UTC, not the session zone) and the time may be omitted; NULL when
    the string is not ISO-8601."""
    def zoned(x: Column) -> Column:
        whole = F.when(x.rlike(r"(Z|[+-]\d{2}:\d{2}(:\d{2})?)$"), x).otherwise(F.concat(x, F.lit("Z")))
        return F.when(x.rlike(ISO_LENIENT_RE), F.try_to_timestamp(whole))

    def parse(raw: Column) -> Column:
        s = F.regexp_replace(F.upper(raw), r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})(Z|[+-]|$)", "$1:00$2")
        s = F.regexp_replace(s, r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00:00")
        return F.when(_canonical_utc(raw), F.try_to_timestamp(raw)).otherwise(bound(s, zoned))

    return bound(F.trim(_c(c)), parse)


def epoch_millis(ts) -> Column:
    return F.unix_millis(_c(ts))


def millis_to_ts(ms) -> Column:
    return F.timestamp_millis(_c(ms))


def utc_date(ts) -> Column:
    """The UTC date of a TIMESTAMP, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_c(ts)) / F.lit(86400)).cast("int"))


def utc_hour(ts) -> Column:
    """The UTC hour of day (int), whatever the session zone."""
    return F.floor(F.pmod(F.unix_seconds(_c(ts)), F.lit(86400)) / F.lit(3600)).cast("int")


def utc_string(ts, sep: str = " ", digits: int = 0) -> Column:
    """'yyyy-MM-dd<sep>HH:mm:ss[.f..]' in UTC, whatever the session zone."""
    micros = F.unix_micros(_c(ts))
    # a zone-less timestamp prints as it is
    clock = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.expr("INTERVAL '0.000001' SECOND") * micros
    text = F.substring(clock.cast("string"), 1, 19)
    if sep != " ":
        text = F.translate(text, " ", sep)
    if digits:
        of_second = F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0")
        text = F.concat(text, F.lit("."), F.substring(of_second, 1, digits))
    return text


def iso_utc_string(ts, fractional: bool = False) -> Column:
    """Timestamp -> 'yyyy-MM-ddTHH:mm:ss[.SSS]Z' in UTC."""
    return F.concat(utc_string(ts, "T", 3 if fractional else 0), F.lit("Z"))


def hour_ts(ts) -> Column:
    """The start of the UTC hour."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(_c(ts)) / F.lit(3600)) * F.lit(3600))


def key_part(c, dtype: str | None = None) -> Column:
    col = _c(c)
    if dtype in ("timestamp", "timestamp_ntz"):
        s = utc_string(col, " ", 6)
    else:
        s = col.cast("string")
    return F.coalesce(s, F.lit(KEY_NULL))


def surrogate_key(df, cols: list[str]) -> Column:
    """md5 over '-'-joined, null-safe string forms of ``cols``.

    Timestamps are formatted in UTC (microseconds) so a key does not
    depend on session settings.
    """
    types = dict(df.dtypes)
    parts = [key_part(c, types.get(c)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEP, *parts))


def naive_utc(value: _dt.datetime) -> _dt.datetime:
    """An aware datetime as naive UTC; a naive one is taken as UTC."""
    return value.astimezone(_dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def lookback_cutoff(now: _dt.datetime, hours: int = 2) -> _dt.datetime:
    """date_trunc('hour', now - hours), naive UTC: the incremental re-processing horizon."""
    t = naive_utc(now) - _dt.timedelta(hours=hours)
    return t.replace(minute=0, second=0, microsecond=0)


def to_epoch_micros(value: _dt.datetime) -> int:
    """Naive datetimes are taken as UTC."""
    if value.tzinfo is None:
        value = value.replace(tzinfo=_dt.timezone.utc)
    delta = value - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def ts_literal(value: _dt.datetime) -> Column:
    """A TIMESTAMP literal, independent of the session time zone."""
    return F.timestamp_micros(F.lit(to_epoch_micros(value)))
