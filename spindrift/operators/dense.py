"""DBSCAN for rows of many columns that share no cells, block against block.

In many columns nearly every row has a cell of its own, and boxes decide nothing. Rows are packed into blocks of
bounded size, each pair of blocks is looked at by a small array kernel, and what leaves it grows with the
rows of the two blocks, not with their pairs: neighbours counted, each core row with the smallest it is joined to, and
each other row with the lowest cluster in reach. The number of block pairs is quadratic unless boxes keep them apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import distance_matrix
from ..plans.blocks import matrix, pack, place_rows
from ..plans.components import connected_components
from ..plans.cut import cut

BLOCK_ROWS = 1024
MOST_PARTS = 48  # partitions of the blocks; each is held against each


def near_rows(x: np.ndarray, y: np.ndarray, eps: float, metric: str) -> np.ndarray:
    """Which rows of ``x`` and ``y`` are at most ``eps`` apart, as ``distance_matrix`` would decide it."""
    if metric != "euclidean":
        return distance_matrix(x, y, metric) <= eps
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    over = xx[:, None] + yy[None, :] - 2.0 * (x @ y.T) - eps * eps
    near = over <= 0
    # a product rounds otherwise than differences do
    slack = 1e-12 * x.shape[1] * (xx.max(initial=0) + yy.max(initial=0) + eps * eps)
    i, j = np.nonzero(np.abs(over) <= slack)
    square = np.zeros(len(i))
    for k in range(x.shape[1]):
        gap = x[i, k] - y[j, k]
        square += gap * gap
    near[i, j] = np.sqrt(square) <= eps
    return near


def _joined(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows of both sides the smallest number they are joined to by ``near``, their own at most."""
    while True:
        found = np.minimum(right, np.where(near, left[:, None], np.iinfo("int64").max).min(axis=0, initial=np.iinfo("int64").max))
        back = np.minimum(left, np.where(near, found[None, :], np.iinfo("int64").max).min(axis=1, initial=np.iinfo("int64").max))
        if (back == left).all() and (found == right).all():
            return left, right
        left, right = back, found


class Blocks:
    """``data``: block, ids, x, lo, hi and what later steps add."""

    def __init__(self, rows: DataFrame, cols: list[str], eps: float, metric: str):
        self.dims, self.eps, self.metric = len(cols), eps, metric
        placed, _, n_blocks = place_rows(rows, "id", cols, rows=BLOCK_ROWS)
        dims = self.dims

        def boxed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                xs = [matrix(x, dims) for x in f["x"]]
                yield f.assign(lo=[x.min(axis=0) for x in xs], hi=[x.max(axis=0) for x in xs])

        self.id_type = rows.schema["id"].dataType.simpleString()
        self.schema = f"block long, ids array<{self.id_type}>, x array<double>, lo array<double>, hi array<double>"
        self.parts = max(1, min(MOST_PARTS, n_blocks // 3))
        self.data = self.dealt(pack(placed, "block", "id", cols).mapInPandas(boxed, self.schema))

    def dealt(self, data: DataFrame) -> DataFrame:
        return cut(data.repartition(self.parts, "block"))

    def met(self, data: DataFrame, *extras: str) -> DataFrame:
        """Pairs of blocks a <= b whose boxes are within eps; the columns end in ``_a`` and ``_b``."""
        def side(s):
            return data.select(F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "x", "lo", "hi", *extras)])

        # every partition meets every other without a shuffle of pairs
        both = side("a").hint("shuffle_replicate_nl").crossJoin(side("b")).filter("a <= b")
        gap = "greatest(x._l - y._h, y._l - x._h, 0D)"
        sides = [f"zip_with(lo_{s}, hi_{s}, (l, h) -> struct(l AS _l, h AS _h))" for s in "ab"]
        terms = f"zip_with({sides[0]}, {sides[1]}, (x, y) -> {gap if self.metric == 'manhattan' else f'{gap} * {gap}'})"
        total = f"aggregate({terms}, 0D, (s, t) -> s + t)"
        limit = self.eps if self.metric == "manhattan" else self.eps * self.eps
        return both.filter(F.expr(total) <= limit * (1 + 1e-9)).drop("lo_a", "hi_a", "lo_b", "hi_b")

    def near(self):
        dims, eps, metric = self.dims, self.eps, self.metric
        return lambda x, y: near_rows(x, y, eps, metric), lambda flat: matrix(flat, dims)


def block_components(rows: DataFrame, cols: list[str], eps: float, metric: str, min_samples: int) -> DataFrame:
    """``id, comp`` of ``rows(id, cols)``: comp is the smallest core row of the lowest cluster in reach, null for noise."""
    blocks = Blocks(rows, cols, eps, metric)
    near, unpacked = blocks.near()
    id_type = blocks.id_type

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            held: dict = {}
            for a, b, x_a, x_b in zip(f["a"], f["b"], f["x_a"], f["x_b"]):
                hit = near(unpacked(x_a), unpacked(x_b))
                held[a] = held.get(a, 0) + hit.sum(axis=1)
                if a != b:
                    held[b] = held.get(b, 0) + hit.sum(axis=0)
            yield pd.DataFrame({"block": list(held), "m": list(held.values())})

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(core=[sum(np.asarray(p) for p in parts) >= min_samples for parts in f["parts"]]).drop(columns="parts")

    found = blocks.met(blocks.data).select("a", "b", "x_a", "x_b").mapInPandas(count, "block long, m array<long>")
    parts = found.groupBy("block").agg(F.collect_list("m").alias("parts"))
    data = blocks.dealt(blocks.data.join(parts, "block").mapInPandas(judge, blocks.schema + ", core array<boolean>"))

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a, b, ids_a, ids_b, x_a, x_b, core_a, core_b in zip(*(f[c] for c in ("a", "b", "ids_a", "ids_b", "x_a", "x_b", "core_a", "core_b"))):
                i, j = np.flatnonzero(core_a), np.flatnonzero(core_b)
                if not len(i) or not len(j):
                    continue
                names, place = np.unique(np.concatenate([np.asarray(ids_a)[i], np.asarray(ids_b)[j]]), return_inverse=True)
                left, right = place[:len(i)], place[len(i):]
                to = np.concatenate(_joined(near(unpacked(x_a)[i], unpacked(x_b)[j]), left, right))
                yield pd.DataFrame({"a": names[place], "b": names[to]})[place != to].drop_duplicates()

    columns = ["a", "b", "ids_a", "ids_b", "x_a", "x_b", "core_a", "core_b"]
    comps = cut(connected_components(
        blocks.met(data, "core").select(*columns).mapInPandas(link, f"a {id_type}, b {id_type}")
    ))
    each = data.select("block", F.explode(F.arrays_zip("ids", "core")).alias("r")).select("block", F.col("r.ids").alias("id"), F.col("r.core").alias("core"))
    each = cut(each.join(comps.withColumnRenamed("node", "id"), "id", "left").select(
        "block", "id", "core", F.when(F.col("core"), F.coalesce("comp", "id")).alias("comp")
    ))
    core = each.filter("core").select("id", "comp")
    others = each.filter("NOT core").select("id")
    if others.isEmpty() or core.isEmpty():
        return each.select("id", "comp")
    # in the order of the ids, as the rows of a block are
    named = each.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("id", "comp"))).alias("_m")).select("block", F.col("_m.comp").alias("comp"))
    data = blocks.dealt(data.join(named, "block"))

    def reach(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a, b, *both in zip(*(f[c] for c in (*columns, "comp_a", "comp_b"))):
                ids_a, ids_b, x_a, x_b, core_a, core_b, comp_a, comp_b = both
                ways = [(ids_a, x_a, core_a, x_b, core_b, comp_b)]
                if a != b:
                    ways.append((ids_b, x_b, core_b, x_a, core_a, comp_a))
                for ids, x, own, y, other, comp in ways:
                    i, j = np.flatnonzero(~np.asarray(own, bool)), np.flatnonzero(other)
                    if not len(i) or not len(j):
                        continue
                    names, place = np.unique(np.array([comp[q] for q in j]), return_inverse=True)
                    lowest = np.where(near(unpacked(x)[i], unpacked(y)[j]), place[None, :], len(names)).min(axis=1)
                    hit = lowest < len(names)
                    yield pd.DataFrame({"id": np.asarray(ids)[i[hit]], "comp": names[lowest[hit]]})

    met = blocks.met(data, "core", "comp").select(*columns, "comp_a", "comp_b")
    border = met.mapInPandas(reach, f"id {id_type}, comp {id_type}").groupBy("id").agg(F.min("comp").alias("comp"))
    return core.unionByName(others.join(border, "id", "left"))
