"""Table checks: counts, ranges, high-water marks, contracts, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def date_range(df: DataFrame) -> DataFrame:
    """First and last tick time; both null on an empty table."""
    return df.agg(F.min("datetime").alias("first_time"), F.max("datetime").alias("last_time"))


def last_raw_time(df: DataFrame) -> DataFrame:
    """High-water mark of the raw clock (null when empty)."""
    return df.agg(F.max("raw_time").alias("last_raw_time"))


def distinct_contracts(df: DataFrame) -> DataFrame:
    c = F.col("contract")
    return df.select("contract").where(c.isNotNull() & (c != "")).distinct().orderBy("contract")


def count_by_contract(df: DataFrame) -> DataFrame:
    return df.groupBy("contract").agg(F.count(F.lit(1)).alias("record_count")).orderBy("contract")


def duplicate_times(df: DataFrame, n: int = 10) -> DataFrame:
    """Timestamps stored more than once; the first ``n`` by time."""
    return (df.groupBy("datetime").agg(F.count(F.lit(1)).alias("cnt"))
              .where(F.col("cnt") > 1).orderBy("datetime").limit(n))
