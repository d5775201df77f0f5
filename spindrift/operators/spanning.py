"""Single linkage: a minimum spanning tree and the merge tree it stands for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import distance_matrix
from ..plans.blocks import join_blocks, matrix, near_pairs, pack, place_rows, spread
from ..plans.components import connected_components
from ..plans.cut import cut, table
from ..plans.numbering import number_rows
from ..plans.skew import attach
from .agglomerative import tie_number

# edges of one part of the tree that are put in order inside one group
PART_BITS = 14
FEW_EDGES = 1 << 14  # whose components one task finds
EDGE = "d double, t long, lo long, hi long"


class SpanningTree:
    def __init__(self, firsts: DataFrame, zero: DataFrame, n: int, x_cols: list[str], metric: str):
        self.n = n
        z = cut(number_rows(zero, [F.col("seq")], "rank"))
        self.zero = z
        self.n_zero = z.count()
        edges = _edges(firsts, x_cols, "manhattan" if metric == "manhattan" else "euclidean")
        height = F.col("d") * F.col("d") / 2 if metric == "cosine" else F.col("d")
        ranked = number_rows(edges, [F.col(c) for c in ("d", "t", "lo", "hi")], "rank", start=self.n_zero)
        self.edges = cut(ranked.select("rank", "lo", "hi", height.alias("height")))
        self.firsts = firsts
        self.links = z.select("rank", "winner", "loser").unionByName(
            self.edges.select("rank", F.col("lo").alias("winner"), F.col("hi").alias("loser"))
        )

    def nodes(self) -> DataFrame:
        """rank, left_id, right_id, height, size of every merge."""
        n = F.lit(self.n)
        named = self.zero.select(F.col("loser").alias("key"), (F.col("rank") + n).alias("node"))
        copies = self.zero.join(named.withColumnRenamed("key", "left_key"), "left_key", "left").select(
            "rank", F.coalesce("node", "winner").alias("left_id"), F.col("loser").alias("right_id"),
            "height", F.col("size").cast("long").alias("size"),
        )
        start = self.firsts.join(named, "key", "left").select("cid", F.coalesce("node", "cid").alias("node"), "n")
        u = start.select(F.col("cid").alias("lo"), F.col("node").alias("u"), F.col("n").alias("w_u"))
        v = start.select(F.col("cid").alias("hi"), F.col("node").alias("v"), F.col("n").alias("w_v"))
        part = self.edges.select((F.col("rank") - self.n_zero).alias("r"), "lo", "hi", "height")
        part = cut(part.join(u, "lo").join(v, "hi").select("r", "height", "u", "w_u", "v", "w_v"))
        n_edges = self.n - 1 - self.n_zero
        for bit in range(max(n_edges - 1, 0).bit_length() - 1, PART_BITS - 1, -1):
            part = self._split(part, bit)
        first = self.n + self.n_zero
        shift, n_zero = PART_BITS, self.n_zero

        def order(pdf: pd.DataFrame) -> pd.DataFrame:
            # at most 2**PART_BITS edges of one part, lowest first
            top, size, out = {}, {}, []

            def find(x):
                while x in top:
                    if top[x] in top:
                        top[x] = top[top[x]]
                    x = top[x]
                return x

            for e in pdf.sort_values("r").itertuples(index=False):
                size.setdefault(e.u, e.w_u)
                size.setdefault(e.v, e.w_v)
                a, b, node = find(e.u), find(e.v), first + e.r
                top[a] = top[b] = node
                size[node] = size[a] + size[b]
                out.append((e.r + n_zero, a, b, e.height, size[node]))
            return pd.DataFrame(out, columns=["rank", "left_id", "right_id", "height", "size"])

        ordered = part.groupBy(F.shiftright("r", shift).alias("part")).applyInPandas(
            order, "rank long, left_id long, right_id long, height double, size long"
        )
        return cut(copies.unionByName(ordered))

    def _split(self, part: DataFrame, bit: int) -> DataFrame:
        """Halve every part by rank.

        The lower half's components become single nodes for the upper half,
        named by their highest merge; after that both halves stand alone.
        """
        sub = F.shiftright("r", bit + 1)
        upper = F.shiftright("r", bit).bitwiseAND(F.lit(1).cast("long")) == 1
        # a part's nodes are told apart by its number; as one number the two could pass 64 bits
        of_part = lambda c: F.struct(sub.alias("part"), F.col(c).alias("node"))
        part = part.withColumn("ku", of_part("u")).withColumn("kv", of_part("v"))
        low, high = part.filter(~upper), part.filter(upper)
        comps = cut(connected_components(low.select(F.col("ku").alias("a"), F.col("kv").alias("b")), FEW_EDGES))
        ends = F.explode(
            F.array(
                F.struct(F.col("ku").alias("node"), F.col("w_u").alias("w"), "r"),
                F.struct(F.col("kv").alias("node"), F.col("w_v").alias("w"), "r"),
            )
        )
        vertices = low.select(ends.alias("e")).select("e.*").groupBy("node").agg(F.first("w").alias("w"), F.max("r").alias("r"))
        tops = vertices.join(comps, "node").groupBy("comp").agg(
            F.sum("w").alias("w"), (F.max("r") + self.n + self.n_zero).alias("top"), F.count(F.lit(1)).alias("_n")
        )
        named = cut(attach(comps, tops, ["comp"], "_n").select("node", "top", "w"))
        for end in "uv":
            used = high.groupBy(F.col(f"k{end}").alias("node")).agg(F.count(F.lit(1)).alias("_m"))
            to = used.join(named, "node", "left").select(
                F.col("node").alias(f"k{end}"), F.col("top").alias(f"t_{end}"), F.col("w").alias(f"tw_{end}"), "_m"
            )
            high = attach(high, to, [f"k{end}"], "_m").drop("_m")
        high = high.select(
            "r", "height", F.coalesce("t_u", "u").alias("u"), F.coalesce("tw_u", "w_u").alias("w_u"),
            F.coalesce("t_v", "v").alias("v"), F.coalesce("tw_v", "w_v").alias("w_v"),
        )
        return table(low.drop("ku", "kv").unionByName(high))


def _edges(points: DataFrame, x_cols: list[str], metric: str) -> DataFrame:
    """Borůvka rounds: every component adds its lowest outgoing edge.

    Edges are compared by (distance, mixed ids), a total order, so no round
    can close a cycle, and the number of components at least halves.
    """
    dims = len(x_cols)
    placed, n, n_blocks = place_rows(points, "cid", x_cols)
    placed = cut(placed.select("cid", "block", *x_cols, F.col("cid").alias("comp")))
    boxes = cut(
        placed.groupBy("block").agg(
            *[F.expr(f"min({c}) AS lo_{i}") for i, c in enumerate(x_cols)],
            *[F.expr(f"max({c}) AS hi_{i}") for i, c in enumerate(x_cols)],
        )
    )
    edges, left = points.sparkSession.createDataFrame([], EDGE), n
    while left > 1:
        packed = cut(pack(placed, "block", "cid", x_cols, ["comp"]))
        best = cut(_lowest_edges(packed, boxes, n_blocks, dims, metric))
        new = cut(best.select("d", "t", "lo", "hi").distinct())
        edges = edges.unionByName(new)
        found = new.count()
        if not found:
            raise RuntimeError("no edge leaves any component")
        left -= found
        if left > 1:
            linked = connected_components(best.select(F.col("comp").alias("a"), F.col("to").alias("b")), FEW_EDGES)
            sizes = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("_n"))
            moved = linked.select(F.col("node").alias("comp"), F.col("comp").alias("new")).join(sizes, "comp")
            placed = table(attach(placed, moved, ["comp"], "_n").drop("comp", "_n").withColumnRenamed("new", "comp"))
    return cut(edges)


def _lowest_edges(packed: DataFrame, boxes: DataFrame, n_blocks: int, dims: int, metric: str) -> DataFrame:
    """``comp, to, d, t, lo, hi``: the lowest edge leaving each component."""

    def lowest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples(index=False):
                a, b = np.asarray(row.ids_a), np.asarray(row.ids_b)
                ca, cb = np.asarray(row.comp_a), np.asarray(row.comp_b)
                other = ca[:, None] != cb[None, :]
                if not other.any():
                    continue
                d = np.where(other, distance_matrix(matrix(row.x_a, dims), matrix(row.x_b, dims), metric), np.inf)
                least = d.min(axis=1)
                # ties are broken among the lowest alone, which are few
                i, at = np.nonzero(d == np.where(np.isfinite(least), least, -1.0)[:, None])
                lo, hi = np.minimum(a[i], b[at]), np.maximum(a[i], b[at])
                out = pd.DataFrame({"comp": ca[i], "to": cb[at], "d": least[i], "t": tie_number(lo, hi), "lo": lo, "hi": hi})
                yield out.sort_values(["d", "t", "lo", "hi"]).drop_duplicates("comp")

    def run(pairs):
        return spread(join_blocks(pairs, packed, packed), n_blocks).mapInPandas(lowest, f"comp long, to long, {EDGE}")

    def best(found):
        return found.groupBy("comp").agg(F.min(F.struct("d", "t", "lo", "hi", "to")).alias("m")).select(
            "comp", "m.to", "m.d", "m.t", "m.lo", "m.hi"
        )

    # rows of the same and the next block in the global order: this reaches
    # another component from at least one row of every component
    step = F.explode(F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)]))
    close = boxes.select(F.col("block").alias("a"), step.alias("s")).select("a", (F.col("a") + F.col("s")).alias("b"))
    close = close.filter(F.col("b").between(0, n_blocks - 1))
    found = run(close)
    if n_blocks <= 2:
        return best(found)
    first = cut(best(found))
    inside = packed.select("block", F.explode(F.array_distinct("comp")).alias("comp"))
    reach = inside.join(first.select("comp", "d"), "comp").groupBy("block").agg(
        F.max(F.col("d") * (1 + 1e-9)).alias("bound")
    )
    pairs = near_pairs(boxes.join(reach, "block"), n_blocks, dims, "bound", metric)
    pairs = pairs.filter(F.abs(F.col("a") - F.col("b")) > 1)
    pure = packed.select("block", F.when(F.array_min("comp") == F.array_max("comp"), F.array_min("comp")).alias("only"))
    pairs = (
        pairs.join(pure.select(F.col("block").alias("a"), F.col("only").alias("o_a")), "a")
        .join(pure.select(F.col("block").alias("b"), F.col("only").alias("o_b")), "b")
        .filter("o_a IS NULL OR o_b IS NULL OR o_a <> o_b").select("a", "b")
    )
    return best(first.unionByName(run(pairs)))
