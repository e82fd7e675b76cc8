"""Column -> Column expressions.  All JVM-side built-ins, no Python UDFs.

Time expressions assume ``spark.sql.session.timeZone=UTC`` (set by
``tickline.context.prepare``): tick timestamps are UTC instants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickline.schema import (
    CONTRACT_PATTERN, EPOCH_SHIFT_US, FIRST_BUNDLE_TRADE, LAST_BUNDLE_TRADE,
    MARKER_TOLERANCE, MINUTE_US, SESSION_TZ,
)

DAY_US = 86_400_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_to_timestamp(raw) -> Column:
    """Raw file time (µs since 1899-12-30 UTC) -> UTC timestamp."""
    return F.timestamp_micros(_c(raw) - F.lit(EPOCH_SHIFT_US))


def timestamp_to_raw(ts) -> Column:
    """UTC timestamp -> raw file time; used for filter bounds on ``raw_time``."""
    return F.unix_micros(_c(ts)) + F.lit(EPOCH_SHIFT_US)


def file_stem(path) -> Column:
    """Last path component (either separator) without its final suffix."""
    name = F.regexp_extract(_c(path), r"([^/\\]*)$", 1)
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1")


def path_key(path) -> Column:
    """A file's path in a form that compares: lower case, forward slashes, no
    ``file:`` scheme."""
    c = F.col(path) if isinstance(path, str) else path
    return F.lower(F.regexp_replace(F.translate(c, "\\", "/"), "^(?i)file:(//)?(?=/)", ""))


def contract_from_file(path) -> Column:
    """Contract code from a file name: ``ESZ24_FUT_CME.scid`` -> ``ESZ24``;
    names that miss the pattern fall back to the text before the first ``_``."""
    stem = file_stem(path)
    code = F.regexp_extract(stem, CONTRACT_PATTERN, 1)
    return F.when(code != "", code).otherwise(F.substring_index(stem, "_", 1))


def is_first_bundle(open_col="open") -> Column:
    return F.abs(_c(open_col) - F.lit(FIRST_BUNDLE_TRADE)) < MARKER_TOLERANCE


def is_last_bundle(open_col="open") -> Column:
    return F.abs(_c(open_col) - F.lit(LAST_BUNDLE_TRADE)) < MARKER_TOLERANCE


def is_regular_trade(open_col="open") -> Column:
    return F.abs(_c(open_col)) < MARKER_TOLERANCE


def minute_bucket(raw="raw_time") -> Column:
    """Integer minute of the raw clock (floor division; raw times are positive)."""
    r = _c(raw).cast("long")
    return F.call_function("div", r, F.lit(MINUTE_US))


def bucket_to_timestamp(bucket, minutes: int = 1) -> Column:
    """Minute bucket (raw clock) back to the UTC timestamp of its start."""
    return F.timestamp_micros(_c(bucket) * F.lit(MINUTE_US * minutes) - F.lit(EPOCH_SHIFT_US))


def start_of_minute(ts="datetime") -> Column:
    return F.date_trunc("minute", _c(ts))


def month_key(ts="datetime") -> Column:
    """``yyyyMM`` partition key."""
    return F.date_format(_c(ts), "yyyyMM")


def to_eastern(ts="datetime", tz: str = SESSION_TZ) -> Column:
    """UTC instant -> exchange wall time (``timestamp_ntz``), DST aware."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts).cast("timestamp_ntz"))


def session_date(et="et") -> Column:
    return F.to_date(_c(et))


def time_of_day_us(et="et") -> Column:
    """Microseconds since wall-clock midnight of a ``timestamp_ntz``."""
    return F.pmod(F.unix_micros(_c(et).cast("timestamp")), F.lit(DAY_US))


def parse_config_date(c) -> Column:
    """``yyyy-MM-dd`` -> UTC midnight timestamp; null stays null."""
    return F.to_timestamp(_c(c), "yyyy-MM-dd")


def direction_label(c="direction") -> Column:
    return F.coalesce(_c(c), F.lit("Inside"))


def format_levels(high, low) -> Column:
    """Fixed two-decimal ``high / low`` text used by the day list."""
    return F.format_string("%7.2f / %-7.2f", _c(high), _c(low))


# Binary units of the readable size text (fixed values).
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]


def readable_size(nbytes) -> Column:
    """Bytes -> text such as ``1.50 MiB``; two decimals, halves rounded up."""
    b = _c(nbytes).cast("double")
    # Build from the smallest unit upwards so the largest matching unit wins.
    expr = F.format_string("%.2f %s", F.floor(b * 100 + 0.5) / 100, F.lit(SIZE_UNITS[0]))
    for k in range(1, len(SIZE_UNITS)):
        scaled = F.floor(b / F.lit(float(1024 ** k)) * 100 + 0.5) / 100
        expr = F.when(b >= F.lit(float(1024 ** k)),
                      F.format_string("%.2f %s", scaled, F.lit(SIZE_UNITS[k]))).otherwise(expr)
    return F.when(_c(nbytes).isNull(), F.lit(None).cast("string")).otherwise(expr)
