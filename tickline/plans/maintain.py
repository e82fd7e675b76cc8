"""Table maintenance: layout migration, compaction, dropping and detaching
months, and partition inventories.

Inventories read no rows: files and bytes come from a listing (Spark's file
source without the contents), row counts and time bounds from the Parquet
footers (aggregates pushed into the scan).  What a job replaces or takes out
goes by whole files and one record (``tickline.plans.publish``), so that a
broken job is finished or undone by the next.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.functions.expr import readable_size
from tickline.operators.joins import materialize
from tickline.plans.ingest import (
    TABLE_SCHEMA, _exists, dedupe_batch, read_table, stage_monthly, with_month,
)
from tickline.plans.publish import move_out, new_job, publish, published_files, read_published, recover
from tickline.schema import EPOCH_SHIFT_US, KEY_COLUMNS

COMPACTION_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("bytes_before", T.LongType()),
    T.StructField("bytes_after", T.LongType()),
    T.StructField("compacted_at", T.TimestampType()),
])


def _footers(spark: SparkSession) -> SparkSession:
    """A session whose Parquet scans answer counts and bounds from footers."""
    s = spark.newSession()
    s.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    s.conf.set("spark.sql.session.timeZone", "UTC")
    return s


def partition_files(spark: SparkSession, table_path: str) -> DataFrame:
    """One row per data file: month, file, bytes."""
    if not _exists(spark, table_path):
        return spark.createDataFrame([], "month string, file string, bytes long")
    listed = read_published(spark, table_path, None, fmt="binaryFile")
    return (listed.select(F.regexp_extract("path", "/month=([^/]*)/[^/]+$", 1).alias("month"), F.col("path").alias("file"), F.col("length").alias("bytes"))
                  .where("month <> ''"))


def month_rows(spark: SparkSession, table_path: str) -> DataFrame:
    """Rows, least and greatest raw time per month, from the footers."""
    if not _exists(spark, table_path):
        return spark.createDataFrame([], "month string, rows long, first_raw long, last_raw long")
    stored = read_published(_footers(spark), table_path, TABLE_SCHEMA)
    return stored.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.min("raw_time").alias("first_raw"), F.max("raw_time").alias("last_raw"))


def table_summary(spark: SparkSession, table_path: str) -> DataFrame:
    """Record count, first and last time, and high-water mark of the raw clock
    of a table, from its footers (times follow from the raw clock)."""
    at = lambda c: F.timestamp_micros(F.col(c) - F.lit(EPOCH_SHIFT_US))
    return (month_rows(spark, table_path)
            .agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("record_count"), F.min("first_raw").alias("f"), F.max("last_raw").alias("last_raw_time"))
            .select("record_count", at("f").alias("first_time"), at("last_raw_time").alias("last_time"), "last_raw_time"))


def partition_inventory(spark: SparkSession, table_path: str) -> DataFrame:
    """Rows, files and bytes per month partition, newest first."""
    files = partition_files(spark, table_path).groupBy("month").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").cast("long").alias("bytes"))
    g = month_rows(spark, table_path).select("month", "rows").join(files, "month")
    return g.select("month", "files", "rows", "bytes", readable_size("bytes").alias("size")).orderBy(F.col("month").desc())


def table_sizes(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Total bytes and rows per table."""
    out = None
    for name, path in tables.items():
        rows = month_rows(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))
        size = partition_files(spark, path).agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"))
        one = rows.withColumn("table", F.lit(name)).join(size.withColumn("table", F.lit(name)), "table")      # one row each
        out = one if out is None else out.unionByName(one)
    return out.select("table", "bytes", "rows", readable_size("bytes").alias("size"))


def read_compactions(spark: SparkSession, ledger_path: str) -> DataFrame:
    if not _exists(spark, ledger_path):
        return spark.createDataFrame([], COMPACTION_SCHEMA)
    return spark.read.schema(COMPACTION_SCHEMA).parquet(ledger_path)


def compact_old(spark: SparkSession, table_path: str, ledger_path: str, as_of, days: int = 7,
                table: str = "ES", codec: str = "zstd") -> list[str]:
    """Rewrite every month that ended more than ``days`` before ``as_of`` and
    is not compacted yet: clustered by contract, newest first inside, zstd.
    Idempotent: compacted months are recorded and skipped.  Returns the months
    rewritten."""
    recover(spark, table_path)
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    cutoff = as_of - _dt.timedelta(days=days)
    inv = partition_files(spark, table_path).groupBy("month").agg(F.sum("bytes").alias("bytes"))
    done = read_compactions(spark, ledger_path).where(F.col("table") == table).select("month")
    # month m ends at the first day of m+1
    month_end = F.add_months(F.to_date(F.concat(F.col("month"), F.lit("01")), "yyyyMMdd"), 1)
    todo = (inv.join(done, "month", "left_anti")
               .where(month_end.cast("timestamp") <= F.lit(cutoff)))
    plan = materialize(todo)
    months = [r.month for r in plan.df.select("month").collect()]     # bounded: months
    if not months:
        return []
    old = [n for n in published_files(spark, table_path) if n.split("/")[0].removeprefix("month=") in set(months)]
    data = read_published(spark, table_path, TABLE_SCHEMA, only=old)
    job = new_job("compact")
    stage_monthly(data, table_path, job, data.count(), ("contract", F.col("datetime").desc()), codec)      # counted from footers
    publish(spark, table_path, job, old)
    after = partition_files(spark, table_path).where(F.col("month").isin(months)) \
        .groupBy("month").agg(F.sum("bytes").alias("bytes_after"))
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rec = (plan.df.withColumnRenamed("bytes", "bytes_before").join(after, "month")
           .select(F.lit(table).alias("table"), "month", F.col("bytes_before").cast("long"),
                   F.col("bytes_after").cast("long"), F.lit(now).cast("timestamp").alias("compacted_at")))
    rec.coalesce(1).write.mode("append").parquet(ledger_path)
    return months


def compacted_counts(spark: SparkSession, tables: dict[str, str], ledger_path: str) -> DataFrame:
    """Per table: compacted, not compacted and total month partitions."""
    done = read_compactions(spark, ledger_path).select("table", "month").distinct() \
        .withColumn("_c", F.lit(True))
    parts = []
    for name, path in tables.items():
        months = partition_files(spark, path).select("month").distinct().withColumn("table", F.lit(name))
        parts.append(months)
    allm = parts[0]
    for p in parts[1:]:
        allm = allm.unionByName(p)
    j = allm.join(done, ["table", "month"], "left")
    return j.groupBy("table").agg(
        F.count_if(F.col("_c").isNotNull()).alias("compacted"),
        F.count_if(F.col("_c").isNull()).alias("not_compacted"),
        F.count(F.lit(1)).alias("total"))


def compaction_report(spark: SparkSession, ledger_path: str) -> DataFrame:
    c = read_compactions(spark, ledger_path)
    return c.select("table", "month", readable_size("bytes_before").alias("before_compression"),
                    readable_size("bytes_after").alias("after_compression")).orderBy("table", "month")


def _month_files(spark: SparkSession, table_path: str, month: str) -> list[str]:
    return [n for n in published_files(spark, table_path) if n.startswith(f"month={month}/")]


def drop_month(spark: SparkSession, table_path: str, month: str) -> bool:
    """Remove one month partition (its files, no data movement)."""
    recover(spark, table_path)
    gone = _month_files(spark, table_path, month)
    if gone:
        publish(spark, table_path, new_job("drop"), gone)
    return bool(gone)


def detach_month(spark: SparkSession, table_path: str, month: str, archive: str) -> str:
    """Take a month out of the table but keep its data in ``archive``, whose
    month is replaced.  Both happen or neither: a run after a crash finishes or
    undoes it; once detached, another run changes nothing."""
    recover(spark, table_path)
    recover(spark, archive)
    gone = _month_files(spark, table_path, month)
    if gone:
        part, job = read_published(spark, table_path, TABLE_SCHEMA, only=gone), new_job("detach")
        stage_monthly(part, archive, job, part.count())
        move_out(spark, table_path, job, gone, archive)
    return archive


def migrate_layout(spark: SparkSession, src: str, dst: str, keys=KEY_COLUMNS, order=("record_no",)) -> str:
    """Rewrite an unpartitioned tick dataset as month partitions, one row per
    key: the first by ``order`` (load order, then file order).  ``dst`` must
    not hold months already: they would stay beside the new ones."""
    recover(spark, dst)
    if _exists(spark, dst) and read_table(spark, dst).limit(1).count():
        raise ValueError(f"{dst} is not empty")
    df = spark.read.parquet(src)
    cols = [f.name for f in TABLE_SCHEMA.fields]
    o = F.struct(*[F.col(c) for c in order])
    fresh = dedupe_batch(with_month(df).select(*cols, o.alias("_o")), keys, order="_o").drop("_o")
    job = new_job("migrate")
    stage_monthly(fresh, dst, job, None)
    publish(spark, dst, job)
    return dst
