"""Size-checked joins and staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.context import workspace

# Broadcast a side only when its measured size is below this many bytes.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_limit(spark) -> int:
    v = spark.conf.get("tickline.broadcast.maxBytes", None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES


def _type_width(t) -> int:
    if isinstance(t, T.StructType):
        return sum(_type_width(f.dataType) for f in t.fields) + 8
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 32
    if isinstance(t, (T.ArrayType, T.MapType)):
        return 64
    return 8


def row_width(df: DataFrame) -> int:
    """Estimate of one row's in-memory size from its schema (strings counted
    at 32 bytes; this only decides broadcast vs. shuffle)."""
    return 16 + sum(_type_width(f.dataType) for f in df.schema.fields)


class Measured:
    """A materialised DataFrame with its row count (and so a size bound)."""

    def __init__(self, df: DataFrame, rows: int):
        self.df = df
        self.rows = rows

    @property
    def bytes(self) -> int:
        return self.rows * row_width(self.df)

    def small(self) -> bool:
        return self.bytes <= broadcast_limit(self.df.sparkSession)

    def side(self) -> DataFrame:
        """The frame to put on the build side: broadcast only if measured small;
        otherwise a plain join (shuffle; AQE splits skewed partitions)."""
        return F.broadcast(self.df) if self.small() else self.df


def materialize(df: DataFrame) -> Measured:
    """Cut lineage by writing Parquet to the shared checkpoint folder; the row
    count comes from the files' footers.  Survives executor loss: later stages
    read the files (and only the columns they need), not the lineage."""
    spark = df.sparkSession
    path = workspace(spark, "staged")
    df.write.parquet(path)
    done = spark.read.schema(df.schema).parquet(path)
    return Measured(done, done.count())


def attach(big: DataFrame, small: Measured, on, how: str = "inner") -> DataFrame:
    return big.join(small.side(), on, how)
