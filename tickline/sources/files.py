"""Columnar and CSV exports, and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.operators.clean import chosen_ticks, clean_ticks

CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EXPORT_COLUMNS = ["datetime", "open", "high", "low", "close", "num_trades", "volume",
                  "bid_volume", "ask_volume", "contract", "record_no"]


def export_ticks(df: DataFrame, out: str, start=None, end=None, limit=None, multiplier: float = 1.0, calendar: DataFrame | None = None) -> str:
    """Cleaned, scaled ticks (markers out, open repaired, raw clock dropped) to
    Parquet.  Without dates each file's window in the ``calendar`` holds."""
    t = clean_ticks(chosen_ticks(df, start, end, limit, calendar), multiplier)
    t.select(*[c for c in EXPORT_COLUMNS if c in t.columns]).write.mode("overwrite").parquet(out)
    return out


def _csv_writer(df: DataFrame):
    return (df.write.mode("overwrite").option("header", "true")
              .option("timestampFormat", CSV_TIME_FORMAT)
              .option("timestampNTZFormat", CSV_TIME_FORMAT))


def write_csv(df: DataFrame, out: str) -> str:
    _csv_writer(df).csv(out)
    return out


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.option("header", "true").option("timestampFormat", CSV_TIME_FORMAT)
                 .option("timestampNTZFormat", CSV_TIME_FORMAT).schema(schema).csv(path))


def write_bars(bars: DataFrame, out: str | None) -> DataFrame:
    """Save bars; CSV when the target ends in ``.csv``, Parquet otherwise;
    with no target, just return them."""
    if out:
        if out.lower().rstrip("/").endswith(".csv"):
            write_csv(bars, out)
        else:
            bars.write.mode("overwrite").parquet(out)
    return bars


def export_kind(df: DataFrame) -> str:
    """'ticks' or 'bars', from the columns."""
    cols = {c.lower() for c in df.columns}
    return "ticks" if "num_trades" in cols or "record_no" in cols else "bars"


def read_export(spark: SparkSession, path: str, kind: str | None = None, schema=None) -> DataFrame:
    """Read an exported dataset (Parquet, or CSV when the path ends in .csv)."""
    if path.lower().rstrip("/").endswith(".csv"):
        df = read_csv(spark, path, schema) if schema is not None else (
            spark.read.option("header", "true").option("inferSchema", "true").csv(path))
    else:
        df = spark.read.parquet(path)
    found = export_kind(df)
    if kind and kind != found:
        raise ValueError(f"{path} holds {found}, not {kind}")
    return df


def export_to_csv(spark: SparkSession, src: str, out: str, kind: str | None = None) -> str:
    return write_csv(read_export(spark, src, kind), out)


def results_csv(trades: DataFrame, out: str) -> str:
    return write_csv(trades, out)


def sample_to_csv(df: DataFrame, out: str, n: int = 1000, order=("datetime", "raw_time", "record_no")) -> str:
    """The first ``n`` rows by a total order, to CSV (top-k, no full sort)."""
    cols = [c for c in order if c in df.columns]
    return write_csv(df.orderBy(*cols).limit(n), out)
