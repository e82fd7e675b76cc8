"""Tick cleaning: time ranges, marker rows, price scaling, open repair."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.functions.expr import (
    is_first_bundle, is_last_bundle, is_regular_trade,
)
from tickline.schema import EPOCH_SHIFT_US

PRICE_COLUMNS = ["open", "high", "low", "close"]


def _as_utc(value) -> _dt.datetime | None:
    """A date/time bound (``'2024-01-05'``, datetime, date) as an aware UTC datetime."""
    if value is None:
        return None
    if isinstance(value, _dt.datetime):
        return value if value.tzinfo else value.replace(tzinfo=_dt.timezone.utc)
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day, tzinfo=_dt.timezone.utc)
    text = str(value).strip().replace("T", " ")
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in text else (
        "%Y-%m-%d %H:%M:%S" if ":" in text else "%Y-%m-%d")
    return _dt.datetime.strptime(text, fmt).replace(tzinfo=_dt.timezone.utc)


def to_raw(value) -> int | None:
    """Bound -> raw file time (µs since 1899-12-30), computed on the driver so
    the predicate reaches the scan as a literal."""
    d = _as_utc(value)
    if d is None:
        return None
    delta = d - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds + EPOCH_SHIFT_US


def scan_time_range(df: DataFrame, start=None, end=None) -> DataFrame:
    """Ticks with ``start <= t < end`` (half-open, UTC).  The predicate is on the
    integer ``raw_time`` (pushed to Parquet row groups / the binary reader), and
    on ``month`` as well when the table is month-partitioned, so Catalyst
    prunes whole partitions."""
    lo, hi = to_raw(start), to_raw(end)
    if lo is not None:
        df = df.where(F.col("raw_time") >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col("raw_time") < F.lit(hi))
    if "month" in df.columns:
        if start is not None:
            df = df.where(F.col("month") >= _as_utc(start).strftime("%Y%m"))
        if end is not None:
            last = _as_utc(end) - _dt.timedelta(microseconds=1)
            df = df.where(F.col("month") <= last.strftime("%Y%m"))
    return df


def scan_limit(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` records of each file, before any other filter.  Uses the
    record ordinal, so it is deterministic and needs no global sort."""
    if not n:
        return df
    return df.where(F.col("record_no") < F.lit(int(n)))


def chosen_ticks(ticks: DataFrame, start=None, end=None, limit: int | None = None, calendar: DataFrame | None = None) -> DataFrame:
    """What the file tools work on: the first ``limit`` records of each file,
    then those in the time range or, if no date is given, in the file's window
    in the calendar."""
    from tickline.sources.calendar import default_window
    ticks = scan_limit(ticks, limit)
    if calendar is not None and start is None and end is None:
        return default_window(ticks, calendar)
    return scan_time_range(ticks, start, end)


def classify_trade(df: DataFrame, open_col: str = "open") -> DataFrame:
    return df.withColumns({
        "is_first_bundle": is_first_bundle(open_col),
        "is_last_bundle": is_last_bundle(open_col),
        "is_regular_trade": is_regular_trade(open_col),
    })


def drop_bundle_markers(df: DataFrame) -> DataFrame:
    """Keep regular trades only (``abs(open) < 1e10``)."""
    return df.where(is_regular_trade("open"))


def scale_prices(df: DataFrame, factor: float = 1.0) -> DataFrame:
    if factor == 1.0:
        return df
    return df.withColumns({c: F.col(c) * F.lit(float(factor)) for c in PRICE_COLUMNS})


def repair_open(df: DataFrame) -> DataFrame:
    """``open := close`` where open is 0.0 (the file leaves it empty)."""
    return df.withColumn("open", F.when(F.col("open") == 0.0, F.col("close")).otherwise(F.col("open")))


def clean_ticks(df: DataFrame, multiplier: float = 1.0) -> DataFrame:
    """Marker rows out, prices scaled, open repaired -- in that order."""
    return repair_open(scale_prices(drop_bundle_markers(df), multiplier))


def standardize_ticks(df: DataFrame) -> DataFrame:
    """Accept an exported dataset in either naming: ``price`` comes from ``close``
    when absent; the time column may be called timestamp / date / datetime."""
    cols = {c.lower(): c for c in df.columns}
    if "price" not in cols and "close" in cols:
        df = df.withColumn("price", F.col(cols["close"]))
    elif "price" in cols and cols["price"] != "price":
        df = df.withColumnRenamed(cols["price"], "price")
    if "datetime" not in df.columns:
        for name in ("timestamp", "date", "datetime"):
            if name in cols:
                df = df.withColumnRenamed(cols[name], "datetime")
                break
    if dict(df.dtypes).get("datetime") not in (None, "timestamp"):
        df = df.withColumn("datetime", F.col("datetime").cast("timestamp"))
    return df
