"""Shared pieces of the text operators: word rule, folds, staged tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickline.context import prepare, workspace

WORD = r"[^\x20\x09-\x0D]+"

#: Rows in one Arrow batch: whole texts stay whole, batches stay small.
BATCH_ROWS = 512


def setup(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` as UTF-8 with A-Z in lower case.

    ``bytes.split()`` breaks at exactly those six bytes, and ``bytes.lower()``
    touches ASCII letters only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id gives null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Rows kept out of training.  A row without an id is never held out."""
    return F.coalesce(fold(doc_id, modulus) == remainder, F.lit(False))


def stage(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.  Later
    jobs depend on those files, not on shuffle output of lost executors.  ``by``
    are last columns that get folders of their own."""
    spark = df.sparkSession
    path = workspace(spark, name)
    (df.write.partitionBy(*by) if by else df.write).mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside."""
    was = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def discard(*staged: DataFrame, folder: str = "") -> None:
    """Delete tables (or one ``folder`` of them) that ``stage`` has written.  Only for
    those whose successors are staged as well: no frame that is still to be
    computed may read them."""
    for df in staged:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{df.staged_at}/{folder}")
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def packed(df: DataFrame) -> DataFrame:
    """Each row as one struct column ``row``; ``select("row.*")`` unpacks it."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def numbered(df: DataFrame, order: str) -> tuple[DataFrame, int]:
    """``df`` with a column ``number`` from 0 on, by ``order``, and its row count.
    Ranges are sorted each by itself; the counts of earlier ranges are added."""
    rows = stage(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"))
    before = sizes.select("_part", (F.sum("_c").over(Window.orderBy("_part")) - F.col("_c")).alias("_before"))      # one row a range
    out = (rows.withColumn("_part", part).join(before, "_part")
               .withColumn("number", F.col("_before") + F.col("_at") - F.shiftleft(F.col("_part"), 33)).drop("_at", "_part", "_before"))
    return out, rows.count()
