"""Scalar expressions of the workflow vocabulary, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(seconds: str | Column) -> Column:
    """Seconds (double) as whole microseconds."""
    return F.round(col(seconds).cast("double") * 1e6).cast("long")


def epoch_micros(timestamp: str | Column) -> Column:
    """Microseconds since the epoch of a timestamp without zone (or its text), read as UTC whatever the session's time zone is."""
    t = col(timestamp).cast("timestamp_ntz")
    of_day = F.hour(t) * 3600 + F.minute(t) * 60
    return (F.unix_date(t.cast("date")).cast("long") * 86_400 + of_day) * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")


def elapsed_dhms(seconds: str | Column) -> Column:
    """Whole seconds as days:hours:minutes:seconds, without padding."""
    s = col(seconds).cast("long")
    return F.concat_ws(":", F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60), s % 60)


def stem_suffix(path: str | Column, suffix: str) -> Column:
    """A file name with a suffix before its extension (from the first dot of the last path part on)."""
    return F.regexp_replace(col(path), r"^(.*?/?[^/.]*)(\.[^/]*)?$", f"$1{suffix}$2")


def join_arguments(values: str | Column, separator: str = " ") -> Column:
    """An array of arguments as one string; newlines inside are taken out."""
    return F.array_join(F.transform(col(values), lambda v: F.regexp_replace(v, r"[\r\n]", "")), separator)


def uri_bucket(uri: str | Column) -> Column:
    return F.regexp_extract(col(uri), r"^[a-z0-9+.-]+://([^/]+)", 1)


def uri_prefix(uri: str | Column) -> Column:
    return F.regexp_extract(col(uri), r"^[a-z0-9+.-]+://[^/]+/?(.*)$", 1)


def is_injected(value: str | Column) -> Column:
    """Whether a parameter value names a global: [name]."""
    return col(value).startswith("[") & col(value).endswith("]")
