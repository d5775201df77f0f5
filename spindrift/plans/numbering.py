"""Dense global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import cut

_ROW = (1 << 33) - 1


def number_rows(df: DataFrame, order: list[Column], name: str = "pos", start: int = 0) -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order`` (a total order).

    The rows are range-partitioned and sorted inside each partition; the only
    thing gathered is one row count per partition, which is added back as an
    offset. The sorted rows are materialised first, so the partition numbers
    of the count pass and of the final pass are the same ones.
    """
    ordered = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    part = F.shiftright("_mid", 33)
    offsets = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        # one row per partition: this window never sees the data itself
        .withColumn("_off", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
        .select("_part", "_off")
    )
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_ROW)) + F.lit(start))
        .drop("_part", "_off", "_mid")
    )
