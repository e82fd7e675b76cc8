"""Distributed ordered scans (prefix maxima) without putting a group on one task.

Spark's window functions need every row of a ``partitionBy`` group in one task.
For a group that may hold a large share of the data (one trading day can), we
instead cut the ordered rows into bounded chunks with ``repartitionByRange``
(sampled boundaries, so a hot group spans many chunks), compute

* the maximum of every chunk (a small aggregate),
* the exclusive prefix maximum over the chunks of a group (a window over
  chunk rows only -- at most one row per chunk),
* the running maximum inside each chunk (a window bounded by the chunk size),

and combine them.  Range partition ids increase with the sort key, so chunk
order is the row order inside every group.

The rows with their chunk ids are written once to the shared folder and both
branches read those files: range bounds come from a sample, so two exchanges
of the same rows need not cut them at the same places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickline.operators.joins import materialize


def first_drawdown(rows: DataFrame, keys: list[str], order: list[str], value: str,
                   start: str, depth: str, chunks: int, carry: list[str] | None = None) -> DataFrame:
    """Per group, the first row (by ``order``) whose ``value`` is at least
    ``depth`` below the running maximum of ``value`` (seeded with ``start``,
    which may be null).

    Returns one row per group that has such a row: ``keys`` plus a struct
    ``hit`` = (order..., value, ext, carry...) where ``ext`` is the running
    maximum at that row.
    """
    carry = list(carry or [])
    ranged = materialize(rows.repartitionByRange(int(max(1, chunks)), *keys, *order)
                             .withColumn("_chunk", F.spark_partition_id())).df
    # Chunk maxima -> exclusive prefix over earlier chunks of the same group.
    chunk_max = ranged.groupBy(*keys, "_chunk").agg(F.max(value).alias("_cmax"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    prefix = chunk_max.select(*keys, "_chunk", F.max("_cmax").over(before).alias("_before"))
    # Running maximum inside the chunk; the chunk is bounded by the range partitioner.
    local = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    scanned = (ranged.withColumn("_run", F.max(value).over(local))
                     .join(prefix, [*keys, "_chunk"], "left")
                     .withColumn("_ext", F.greatest(F.col(start), F.col("_before"), F.col("_run"))))
    hits = scanned.where(F.col(value) <= F.col("_ext") - F.col(depth))
    fields = [F.col(c) for c in order] + [F.col(value), F.col("_ext").alias("ext")] + [F.col(c) for c in carry]
    return hits.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("hit"))

