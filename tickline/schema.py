"""Schemas and the fixed values that must equal the tick-file format's."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (binary tick-file format and session conventions).  They must
# equal the format's own numbers for results to be right; do not derive them.
# ---------------------------------------------------------------------------
HEADER_SIZE = 56                     # bytes, header layout "<4s2I2HI36s"
HEADER_FORMAT = "<4s2I2HI36s"
RECORD_SIZE = 40                     # bytes, record layout "<Q4f4I"
RECORD_FORMAT = "<Q4f4I"
EPOCH_SHIFT_US = 2209161600000000    # microseconds from 1899-12-30 to 1970-01-01
MINUTE_US = 60000000
FIRST_BUNDLE_TRADE = -19990009513251226345509817234554355712.0
LAST_BUNDLE_TRADE = -19990019654456028171345029208179998720.0
MARKER_TOLERANCE = 1e10              # abs(open) below this is a regular trade
CONTRACT_PATTERN = r"^([A-Z]{2,3}[A-Z]\d{2})"
SESSION_TZ = "America/New_York"
FILE_TYPE_ID = b"SCID"

# Numpy record layout of one 40-byte record (little endian).
RECORD_DTYPE = [
    ("raw_time", "<u8"),
    ("open", "<f4"), ("high", "<f4"), ("low", "<f4"), ("close", "<f4"),
    ("num_trades", "<u4"), ("volume", "<u4"),
    ("bid_volume", "<u4"), ("ask_volume", "<u4"),
]

KEY_COLUMNS = ["datetime", "raw_time"]

TICK_SCHEMA = T.StructType([
    T.StructField("datetime", T.TimestampType()),
    T.StructField("raw_time", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("num_trades", T.LongType()),
    T.StructField("volume", T.LongType()),
    T.StructField("bid_volume", T.LongType()),
    T.StructField("ask_volume", T.LongType()),
    T.StructField("contract", T.StringType()),
    T.StructField("record_no", T.LongType()),
])

# What the binary source returns: the tick columns plus the file it came from.
SCAN_SCHEMA = T.StructType(TICK_SCHEMA.fields + [T.StructField("file", T.StringType())])

BAR_COLUMNS_SQL = ["candle_time", "open", "high", "low", "close", "volume", "trades"]
BAR_COLUMNS_FILE = ["datetime", "open", "high", "low", "close", "trades",
                    "volume", "bid_volume", "ask_volume"]

CALENDAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("price_multiplier", T.DoubleType()),
    T.StructField("file", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()),
])
