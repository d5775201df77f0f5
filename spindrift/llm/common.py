"""What several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ids_and_texts(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``more``: a table's other columns can then clash with nothing."""
    return df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more
    )


def hash_order(col: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the value and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(col, F.lit(seed)), 11) / F.lit(float(1 << 53))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
