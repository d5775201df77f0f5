"""Sums of Euclidean distances from every row to all rows of each label, in one or two columns.

Fast multipole method by Chebyshev interpolation (Fong and Darve, "The black-box fast multipole method",
2009). Rows are packed into blocks in space-filling order, and blocks into a tree. Two nodes whose boxes are
at least a box's side apart act on each other through ``NODES`` points a column; only the rows of blocks that lie
nearer are compared row by row. So every row counts, and the work grows with n log n instead of n squared. What
interpolation adds to a distance is about 1e-10 of the boxes' size, below the sixth digit of any score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import box_gap, distance_matrix
from ..plans.blocks import matrix, spatial_blocks
from ..plans.cut import cut
from .result import LABEL

NODES = 14       # interpolation points a column
LEAF_ROWS = 512  # rows of a block
MOST_COLUMNS = 2
MOST_LABELS = 32  # so many sums are kept for each point of a node

_T = np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))
_COSINES = np.cos(np.arange(NODES)[:, None] * np.arccos(_T)[None, :])  # T_j at the points
_COSINES[1:] *= 2
NODE = "node long, lo array<double>, hi array<double>, w array<double>"


def _frame(lo, hi) -> tuple[np.ndarray, np.ndarray]:
    """Middle and half sides of a box, none quite 0."""
    lo, hi = np.asarray(lo, float), np.asarray(hi, float)
    half = (hi - lo) / 2
    return lo + half, np.maximum(half, max(half.max() * 1e-3, 1e-12))


def _points(lo, hi) -> np.ndarray:
    middle, half = _frame(lo, hi)
    axes = [m + h * _T for m, h in zip(middle, half)]
    return np.stack([g.ravel() for g in np.meshgrid(*axes, indexing="ij")], axis=1)


def _basis(x: np.ndarray, lo, hi) -> np.ndarray:
    """What each point of the box counts for each row of ``x``."""
    middle, half = _frame(lo, hi)
    out = np.ones((len(x), 1))
    for i in range(x.shape[1]):
        angle = np.arccos(np.clip((x[:, i] - middle[i]) / half[i], -1.0, 1.0))
        one = np.cos(angle[:, None] * np.arange(NODES)) @ _COSINES / NODES
        out = (out[:, :, None] * one[:, None, :]).reshape(len(x), -1)
    return out


def _one_hot(labels, names: np.ndarray) -> np.ndarray:
    return (np.asarray(labels)[:, None] == names[None, :]).astype(float)


def _tree(data: DataFrame, n_blocks: int, dims: int, names: np.ndarray) -> list[DataFrame]:
    """Nodes of all levels, blocks first: their boxes, and the labels' rows as weights of their points."""
    k = len(names)

    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for block, flat, labels in zip(f["block"], f["x"], f[LABEL]):
                x = matrix(flat, dims)
                lo, hi = x.min(axis=0), x.max(axis=0)
                out.append((block, lo, hi, (_basis(x, lo, hi).T @ _one_hot(labels, names)).ravel()))
            yield pd.DataFrame(out, columns=["node", "lo", "hi", "w"])

    def parents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for node, kids in zip(f["node"], f["kids"]):
                lo = np.min([c["lo"] for c in kids], axis=0)
                hi = np.max([c["hi"] for c in kids], axis=0)
                w = sum(_basis(_points(c["lo"], c["hi"]), lo, hi).T @ matrix(c["w"], k) for c in kids)
                out.append((node, lo, hi, w.ravel()))
            yield pd.DataFrame(out, columns=["node", "lo", "hi", "w"])

    levels = [cut(data.mapInPandas(leaves, NODE))]
    while n_blocks > 1:
        kids = levels[-1].groupBy(F.shiftright("node", dims).alias("node")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("node").alias("at"), "lo", "hi", "w"))).alias("kids")
        )
        levels.append(cut(kids.mapInPandas(parents, NODE)))
        n_blocks = -(-n_blocks // (1 << dims))
    return levels


def label_sums(rows: DataFrame, id_col: str, f_cols: list[str], labels: list[int]) -> DataFrame:
    """``ids, cluster_label, sums`` of blocks of rows; ``sums`` holds partial sums, each by row and then by label of ``labels``."""
    dims, names = len(f_cols), np.asarray(labels)
    k = len(names)
    blocks = spatial_blocks(rows, id_col, f_cols, [LABEL], rows=LEAF_ROWS)
    data = blocks.data
    levels = _tree(data, blocks.n_blocks, dims, names)

    def side(df: DataFrame, s: str, *more: str) -> DataFrame:
        corners = [F.get(c, F.lit(i)).alias(f"{s}_{c}_{i}") for c in ("lo", "hi") for i in range(dims)]
        return df.select(F.col("node").alias(s), F.shiftright("node", dims).alias(f"{s}_up"), *corners)

    corner = lambda s, c: [f"{s}_{c}_{i}" for i in range(dims)]
    gap = box_gap(corner("a", "lo"), corner("a", "hi"), corner("b", "lo"), corner("b", "hi"), "euclidean")
    widths = [F.col(h) - F.col(lo) for s in "ab" for h, lo in zip(corner(s, "hi"), corner(s, "lo"))]
    apart = (gap > 0) & (gap >= F.greatest(*widths))

    def act(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums at the points of a node, over all the nodes that act on it at its level."""
        at = lo = hi = points = total = None

        def done():
            return pd.DataFrame([(at, lo, hi, total.ravel())], columns=["node", "lo", "hi", "w"])

        for f in frames:
            for a, lo_a, hi_a, lo_b, hi_b, w in zip(f["a"], f["lo_a"], f["hi_a"], f["lo_b"], f["hi_b"], f["w_b"]):
                if a != at:
                    if at is not None:
                        yield done()
                    at, lo, hi, points, total = a, lo_a, hi_a, _points(lo_a, hi_a), 0.0
                total = total + distance_matrix(points, _points(lo_b, hi_b), "euclidean") @ matrix(w, k)
        if at is not None:
            yield done()

    pairs, fields = None, []
    for level in range(len(levels) - 1, -1, -1):
        a, b = side(levels[level], "a"), side(levels[level], "b")
        if pairs is None:
            met = a.crossJoin(F.broadcast(b))  # the root alone
        else:
            met = pairs.select(F.col("a").alias("a_up"), F.col("b").alias("b_up")).join(a, "a_up").join(b, "b_up")
        met = cut(met.select("a", "b", apart.alias("apart")))
        pairs = met.filter(~F.col("apart"))
        one = levels[level].select(F.col("node").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
        two = levels[level].select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("lo", "hi", "w")])
        acting = met.filter("apart").select("a", "b").join(two, "b").join(one, "a").drop("b")
        # all that acts on a node in one task, one after the other
        field = acting.repartition("a").sortWithinPartitions("a").mapInPandas(act, NODE)
        fields.append(field.withColumn("level", F.lit(level)))
    near = pairs.select("a", "b")
    fields = cut(_union(fields))

    def direct(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            held: dict = {}
            for a, x_a, x_b, labels_b in zip(f["a"], f["x_a"], f["x_b"], f["labels_b"]):
                d = distance_matrix(matrix(x_a, dims), matrix(x_b, dims), "euclidean")
                held[a] = held.get(a, 0.0) + d @ _one_hot(labels_b, names)
            yield pd.DataFrame({"block": list(held), "part": [v.ravel() for v in held.values()]})

    def read_off(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            held: dict = {}
            for block, x, lo, hi, w in zip(f["block"], f["x"], f["lo"], f["hi"], f["w"]):
                held[block] = held.get(block, 0.0) + _basis(matrix(x, dims), lo, hi) @ matrix(w, k)
            yield pd.DataFrame({"block": list(held), "part": [v.ravel() for v in held.values()]})

    part = "block long, part array<double>"
    met = near.join(data.select(F.col("block").alias("b"), F.col("x").alias("x_b"), F.col(LABEL).alias("labels_b")), "b")
    met = met.join(data.select(F.col("block").alias("a"), F.col("x").alias("x_a")), "a").drop("b")
    # few rows, each much work: tasks of a few blocks
    by_rows = met.repartition(max(1, blocks.n_blocks // 16), "a").mapInPandas(direct, part)
    above = F.explode(F.sequence(F.lit(0), F.lit(len(levels) - 1))).alias("level")
    asked = data.select("block", "x", above).withColumn("node", F.expr(f"shiftright(block, {dims} * level)"))
    by_nodes = asked.join(fields, ["level", "node"]).select("block", "x", "lo", "hi", "w").mapInPandas(read_off, part)
    parts = by_rows.unionByName(by_nodes).groupBy("block").agg(F.collect_list("part").alias("sums"))
    return parts.join(data.select("block", "ids", LABEL), "block").select("ids", LABEL, "sums")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
