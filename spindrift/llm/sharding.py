"""Shards by jump consistent hashing: a key and a shard count decide, no table of any kind.

Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm" (2014). Only SQL
expressions are used; the 64-bit generator is kept as two 32-bit halves, since products
of longs would overflow.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: multiplier of the generator, as four 16-bit digits, lowest first
MULTIPLIER = 2862933555777941757
DIGITS = [MULTIPLIER >> (16 * i) & 0xFFFF for i in range(4)]

LOW32 = 0xFFFFFFFF
MOST_JUMPS = 200  # a key jumps about ln(shards) times; 2^31 shards need some 22
CHUNK_ROWS = 4_000
COPIES = 10_000  # of a row that are written from one array


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2^64."""
    m0, m1, m2, m3 = (F.lit(d).cast("long") for d in DIGITS)
    low = lambda x: x.bitwiseAND(F.lit(LOW32))
    up16 = lambda x: F.shiftleft(x.bitwiseAND(F.lit(0xFFFF)), 16)
    first = low(lo * m0) + up16(lo * m1) + F.lit(1)
    second = (
        F.shiftright(lo * m0, 32) + F.shiftright(lo * m1, 16) + low(lo * m2) + low(hi * m0)
        + up16(lo * m3) + up16(hi * m1) + F.shiftright(first, 32)
    )
    return low(second), low(first)


def jump_bucket(key: Column, buckets: int) -> Column:
    """Bucket 0 .. ``buckets``-1 of a long key; a null key counts as 0.

    With one more bucket a key either stays or moves into the new one.
    """
    if not 1 <= buckets < 1 << 31:
        raise ValueError("buckets must lie between 1 and 2^31 - 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def state(b, hi, lo):
        hi, lo = _next(hi, lo)
        return F.struct(b.cast("long").alias("b"), hi.alias("hi"), lo.alias("lo"))

    def jump(s):
        return F.floor((s.b + 1) * (F.lit(float(1 << 31)) / (F.shiftright(s.hi, 1) + 1)))

    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(buckets, MOST_JUMPS))),
        state(F.lit(0), F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(LOW32))),
        lambda s, _: F.when(jump(s) < buckets, state(jump(s), s.hi, s.lo)).otherwise(s),
        lambda s: F.when(jump(s) >= buckets, s.b).otherwise(F.raise_error(F.lit("too many jumps"))),
    )
    return end.cast("int")


def stable_key(df: DataFrame, col: str) -> Column:
    """Whole numbers stand for themselves; other keys for a hash of their text form."""
    if dict(df.dtypes)[col] in ("tinyint", "smallint", "int", "bigint"):
        return F.col(col).cast("long")
    return F.when(F.col(col).isNotNull(), F.xxhash64(F.col(col).cast("string")))


def shard_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """One row per row of ``df``: id, size, text_crc32, shard, slot, grown_shard.

    The id and the number of shards decide the shard; ``grown_shard`` is the one with
    ``shards`` + 1. ``size`` is the number of UTF-8 bytes plus 1. ``slot`` numbers the rows of
    a shard from 0 without gaps: rows alike in all that is returned are counted first, each shard is cut
    into chunks by a hash of id, checksum and size, copies are numbered inside a chunk, and the chunk
    counts give the offsets, so no task holds a shard or the rows of an id.

    A null text counts as empty, a null id as key 0. Repeated rows get slots of their own
    (which of them gets which is open). An empty table gives no rows. Other columns are ignored.
    """
    chunks = max(1, math.ceil(df.count() / (shards * CHUNK_ROWS)))
    key = stable_key(df, id_col)
    alike = df.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text_col), F.lit(0)).cast("long").alias("text_crc32"),
        jump_bucket(key, shards).alias("shard"),
        jump_bucket(key, shards + 1).alias("grown_shard"),
    ).groupBy("doc_id", "size", "text_crc32", "shard", "grown_shard").agg(F.count(F.lit(1)).alias("_n"))
    alike = alike.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(chunks)))
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        alike.groupBy("shard", "_chunk").agg(F.sum("_n").alias("_n"))
        # a row for each chunk of a few thousand rows
        .select("shard", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    earlier = Window.partitionBy("shard", "_chunk").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    copies = F.sequence(F.col("_part") * COPIES, F.least(F.col("_n"), (F.col("_part") + 1) * COPIES) - 1)
    return (
        alike.withColumn("_place", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(offsets, ["shard", "_chunk"])
        # in two steps, so that no array grows with the number of copies by more than a fraction
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES))))
        .withColumn("_copy", F.explode(copies))
        .select(
            "doc_id", "size", "text_crc32", "shard",
            (F.col("_before") + F.col("_place") + F.col("_copy")).cast("long").alias("slot"), "grown_shard",
        )
    )


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", shards: int = 16) -> None:
    """Write all columns of ``df``, one folder ``jump_shard=i`` per shard."""
    where = jump_bucket(stable_key(df, id_col), shards)
    df.withColumn("jump_shard", where).write.partitionBy("jump_shard").parquet(path)
