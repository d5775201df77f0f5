"""Bounded blocks of rows, and exact block-by-block work on near pairs.

Several results need distances between rows that share no join key: the k-th
neighbour, the nearest other cluster, the mean distance to a whole cluster.
Here rows are packed into blocks of at most a few hundred, Spark joins block
to block, and a small array kernel reduces each pair of blocks to one value
per row. Row pairs never become rows of a table, and which block pairs can be
skipped is decided by bounding boxes, which keeps the results exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import box_gap, num
from .cut import cut
from .numbering import number_rows

FAN_OUT_BITS = 5
MORTON_BITS = 60
MORTON_DIMS = 6


def block_rows(n: int, at_least: int = 0) -> int:
    """Rows per block: enough blocks to keep the tasks busy, none too large."""
    return max(at_least, min(1024, max(64, n // 32)))


def morton_key(df: DataFrame, cols: list[str]) -> tuple[Column, int]:
    """Bit-interleaved position of a row in its table, and the row count.

    Only the widest columns take part; rows with near keys are near in space.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"min({c}) AS a{i}") for i, c in enumerate(cols)],
        *[F.expr(f"max({c}) AS b{i}") for i, c in enumerate(cols)],
    ).first()
    spans = [(row[f"b{i}"] - row[f"a{i}"], i) for i in range(len(cols))] if row["n"] else []
    used = [i for span, i in sorted(spans, reverse=True)[:MORTON_DIMS] if span > 0]
    if not used:
        return F.lit(0).cast("long"), row["n"]
    bits = min(20, MORTON_BITS // len(used))
    top = (1 << bits) - 1
    terms = []
    for j, i in enumerate(used):
        lo, span = row[f"a{i}"], row[f"b{i}"] - row[f"a{i}"]
        step = f"CAST(floor(({cols[i]} - {num(lo)}) / {num(span)} * {num(top)}) AS BIGINT)"
        terms += [f"shiftleft(shiftright({step}, {b}) & 1L, {b * len(used) + j})" for b in range(bits)]
    return F.expr(" | ".join(terms)), row["n"]


@dataclass(frozen=True)
class Blocks:
    """``data``: block, ids, x (row-major), extras; ``boxes``: block, n, lo_*, hi_*."""

    data: DataFrame
    boxes: DataFrame
    n_rows: int
    n_blocks: int
    dims: int


def spatial_blocks(
    df: DataFrame,
    id_col: str,
    cols: list[str],
    extras: list[str] = (),
    rows: int | None = None,
    at_least: int = 0,
) -> Blocks:
    """Pack rows that lie near each other into blocks of equal size.

    Blocks are cut from one global order (space-filling curve, then id), so
    even many equal rows are spread over several blocks.
    """
    placed, n, n_blocks = place_rows(df, id_col, cols, extras, rows, at_least)
    data = cut(pack(placed, "block", id_col, cols, extras))
    boxes = cut(
        placed.groupBy("block").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.expr(f"min({c}) AS lo_{i}") for i, c in enumerate(cols)],
            *[F.expr(f"max({c}) AS hi_{i}") for i, c in enumerate(cols)],
        )
    )
    return Blocks(data, boxes, n, n_blocks, len(cols))


def place_rows(
    df: DataFrame,
    id_col: str,
    cols: list[str],
    extras: list[str] = (),
    rows: int | None = None,
    at_least: int = 0,
) -> tuple[DataFrame, int, int]:
    """Rows with their ``block``, the row count and the block count."""
    key, n = morton_key(df, cols)
    rows = rows or block_rows(n, at_least)
    kept = df.select(id_col, *cols, *extras)
    if n <= rows:
        return kept.withColumn("block", F.lit(0).cast("long")), n, 1
    placed = number_rows(kept.withColumn("_key", key), [F.col("_key"), F.col(id_col)], "_pos")
    block = F.floor(F.col("_pos") / F.lit(rows)).cast("long")
    return placed.withColumn("block", block).drop("_key", "_pos"), n, -(-n // rows)


def pack(df: DataFrame, key, id_col: str, cols: list[str], extras: list[str] = ()) -> DataFrame:
    """One row per key: ids and extras as arrays, features as one flat array."""
    keys = [key] if isinstance(key, str) else list(key)
    member = F.struct(F.col(id_col).alias("id"), F.array(*cols).alias("x"), *extras)
    return (
        df.groupBy(*keys)
        # in the order of the ids, whatever way the rows came
        .agg(F.array_sort(F.collect_list(member)).alias("_m"))
        .select(
            *keys,
            F.col("_m.id").alias("ids"),
            F.flatten("_m.x").alias("x"),
            *[F.col(f"_m.{e}").alias(e) for e in extras],
        )
    )


def near_pairs(boxes: DataFrame, n_blocks: int, dims: int, bound: str, metric: str,
               others: DataFrame | None = None) -> DataFrame:
    """Block pairs ``(a, b)`` whose boxes are at most ``boxes[bound]`` of a apart.

    Descends a tree of block groups from one root. Every level is an equi-join
    of the surviving pairs with the children of both sides, so pairs that are
    too far apart are dropped as whole subtrees.
    """
    levels = max(1, math.ceil(math.log2(max(n_blocks, 2)) / FAN_OUT_BITS))
    lo, hi = [f"lo_{i}" for i in range(dims)], [f"hi_{i}" for i in range(dims)]
    others = boxes if others is None else others

    def nodes(source, level, side, with_bound):
        shift = FAN_OUT_BITS * level
        aggs = [F.expr(f"min({c}) AS {side}_{c}") for c in lo] + [F.expr(f"max({c}) AS {side}_{c}") for c in hi]
        if with_bound:
            aggs.append(F.max(bound).alias("_bound"))
        return (
            source.groupBy(F.shiftright("block", shift).alias(side))
            .agg(*aggs)
            .withColumn(f"{side}_up", F.shiftright(side, FAN_OUT_BITS))
        )

    pairs = None
    for level in range(levels - 1, -1, -1):
        left, right = nodes(boxes, level, "a", True), nodes(others, level, "b", False)
        if pairs is None:
            joined = left.join(right, F.col("a_up") == F.col("b_up"))
        else:
            up = pairs.select(F.col("a").alias("a_up"), F.col("b").alias("b_up"))
            joined = up.join(left, "a_up").join(right, "b_up")
        gap = box_gap(
            *[[f"{s}_{c}" for c in side] for s in "ab" for side in (lo, hi)], metric
        )
        pairs = joined.filter(gap <= F.col("_bound")).select("a", "b")
    return pairs


def matrix(flat, dims: int) -> np.ndarray:
    return np.asarray(flat, dtype=float).reshape(-1, dims)


def join_blocks(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Attach both blocks' arrays; the columns end in ``_a`` and ``_b``.

    The left side comes last, so the pairs of one left block tend to arrive
    next to each other and a kernel can keep its running result for them.
    """
    def side(df, s):
        return df.select(
            F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in df.columns if c != "block"]
        )

    return pairs.join(side(right, "b"), "b").join(side(left, "a"), "a")


def spread(both: DataFrame, n_blocks: int) -> DataFrame:
    """Joined blocks over many tasks: they are few bytes and much work, so that by size they would be left to one."""
    return both.repartition(max(min(n_blocks, 96), n_blocks // 16))
