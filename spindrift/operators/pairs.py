"""Agglomerative clustering from a table of distances.

The clusters are the nodes of a graph, an edge for each pair of clusters with a distance. All
mutual nearest pairs merge in a round, and their edges are contracted: the edges between two
clusters become one, whose value follows from theirs (Lance and Williams, 1967). Distances are
measured once, at the start, and kept. Single linkage takes the least, complete the largest, and
average the mean weighted by rows. Ward keeps the mean squared distance of an edge and the variance of a cluster, from
which its height follows.

Up to ``PACKED`` clusters the edges of a cluster are one row, packed: its neighbours and their values as arrays,
kept at both ends. A round moves the row of a merged cluster to that of its winner and adds both up. Numbers and sizes of
those clusters, of which there is a fixed number at most, are with the driver and sent to all tasks, as a broadcast
table would be; distances never are.

A pair that is not in the table is infinitely far: for complete, average and ward linkage two
clusters can only merge if every pair between them is given, for single linkage one is enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import distance_matrix
from ..plans.blocks import block_rows, join_blocks, matrix, pack
from ..plans.cut import cut, table
from ..plans.numbering import number_rows
from ..plans.skew import BROADCAST_ROWS, attach
from . import agglomerative as tree

PACKED = BROADCAST_ROWS  # clusters up to which a row holds all edges of a cluster
TASK_EDGES = 4_000_000   # edges of a task at most, if all pairs are given
BATCH_EDGES = 1_000_000  # edges that leave a task at once


def pair_table(clusters: DataFrame, x_cols: list[str], metric: str, n: int, blocks: int = 0) -> DataFrame:
    """``a, b, d`` for all pairs a < b of ``clusters(cid, x_cols)``, measured block by block."""
    n_blocks = max(1, -(-n // block_rows(n)))
    data = cut(pack(clusters.withColumn("block", F.pmod(F.xxhash64("cid"), F.lit(n_blocks))), "block", "cid", x_cols))
    pairs = data.select(F.col("block").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("block"))).alias("b"))
    dims = len(x_cols)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples(index=False):
                a, b = np.asarray(row.ids_a), np.asarray(row.ids_b)
                d = distance_matrix(matrix(row.x_a, dims), matrix(row.x_b, dims), metric, blocks)
                keep = a[:, None] > b[None, :] if row.a == row.b else np.ones(d.shape, bool)
                i, j = np.nonzero(keep)
                yield pd.DataFrame({"a": np.minimum(a[i], b[j]), "b": np.maximum(a[i], b[j]), "d": d[i, j]})

    # a block that holds no rows is not there to be joined
    return join_blocks(pairs, data, data).mapInPandas(measure, "a long, b long, d double")


class PairRounds:
    """Merges of ``state(cid, n, key, h)`` over ``edges(a, b, d)``, a < b, each pair once (up to ``PACKED`` clusters more often, too: the least counts)."""

    def __init__(self, state: DataFrame, edges: DataFrame, linkage: str, round_no: int = 0, given: bool = True):
        """After ``round_no`` rounds; if not ``given``, ``state`` has a variance ``v`` and ``edges`` are (a, b, s), what an edge keeps."""
        self.linkage, self.round_no, self.given = linkage, round_no, given
        self.state = table(state.select("cid", "n", "key", "h", (F.lit(0.0) if given else F.col("v")).alias("v")))
        self.left = self.state.count()
        self.edges = edges
        if self.left > PACKED:
            self.edges = table(self.sized(edges.select("a", "b", (self.squared(F.col("d")) if given else F.col("s")).alias("s"))))

    def squared(self, d):
        """What an edge of distance ``d`` keeps."""
        return d * d if self.linkage == "ward" else d

    def sized(self, edges: DataFrame) -> DataFrame:
        """Rows and variances of both ends."""
        for side in "ab":
            ends = self.state.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("v").alias(f"v_{side}"), F.lit(self.left).alias("_n"))
            edges = attach(edges, ends, [side], "_n", small_rows=self.left).drop("_n")
        return edges

    def height(self):
        """Distance of the clusters of an edge."""
        if self.linkage != "ward":
            return F.col("s")
        return F.expr("sqrt(2D * n_a * n_b / (n_a + n_b) * greatest(s - v_a - v_b, 0D))")

    def run(self) -> DataFrame | None:
        done, round_no = None, self.round_no
        given = self.given and self.left <= PACKED
        while self.left > 1:
            round_no += 1
            last = self.left <= PACKED
            merges = PackedRounds(self.state, self.edges, self.linkage, round_no, given).run() if last else self.round(round_no)
            done = merges if done is None else done.unionByName(merges)
            if last:
                break
            found = merges.count()
            if not found:
                break  # nothing is left that a pair connects
            self.left -= found
        return done

    def round(self, round_no: int) -> DataFrame:
        d = self.height().alias("d")
        ways = F.inline(F.array(F.struct("a", "b", "d"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "d")))
        both = self.edges.select("a", "b", d).select(ways)
        best = both.groupBy("a").agg(F.min(F.struct("d", tree.tie_break(F.col("a"), F.col("b")).alias("t"), "b")).alias("m"))
        nearest = cut(best.select("a", F.col("m.b").alias("b"), F.col("m.d").alias("d")))
        pairs = cut(tree.mutual_pairs(nearest))
        merges = cut(tree.merged_rows(pairs, self.state, round_no))

        lost = self.state.select(F.col("cid").alias("loser"), F.col("n").alias("_n"), F.col("v").alias("_v"))
        m = merges.select("winner", "loser", "height", "size").join(pairs.select("winner", "d"), "winner").join(lost, "loser").withColumnRenamed("winner", "cid")
        alive = self.state.join(merges.select(F.col("loser").alias("cid")), "cid", "left_anti").join(m, "cid", "left")
        both_ends = F.col("size").isNotNull()
        # mean squared distance to the mean of the union
        v = (F.col("n") * F.col("v") + F.col("_n") * F.col("_v")) / F.col("size") + F.col("d") * F.col("d") / (2 * F.col("size"))
        self.state = table(
            alive.select(
                "cid", F.coalesce("size", "n").alias("n"), F.when(both_ends, F.col("loser")).otherwise(F.col("key")).alias("key"),
                F.coalesce("height", "h").alias("h"),
                (F.when(both_ends, v).otherwise(F.col("v")) if self.linkage == "ward" else F.lit(0.0)).alias("v"),
            )
        )
        moved = merges.select(F.col("loser").alias("_from"), F.col("winner").alias("_to"), F.lit(self.left).alias("_n"))
        edges = self.edges
        for side in "ab":
            to = moved.select(F.col("_from").alias(side), F.col("_to").alias(f"_{side}"), "_n")
            edges = attach(edges, to, [side], "_n", "left", small_rows=self.left).drop("_n").withColumn(side, F.coalesce(f"_{side}", side)).drop(f"_{side}")
        w = F.col("n_a") * F.col("n_b")
        one = {"single": F.min("s"), "complete": F.max("s")}.get(self.linkage, F.sum(w * F.col("s")) / F.sum(w))
        joined = edges.filter("a <> b").withColumn("w", w).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(one.alias("s"), F.sum("w").alias("w"))
        ready = self.sized(joined)
        if self.linkage != "single":
            # a missing pair makes two clusters infinitely far
            ready = ready.filter(F.col("w") == F.col("n_a") * F.col("n_b"))
        self.edges = table(ready.drop("w"))
        return merges


class Clusters:
    """Clusters of a round by their place: number, rows and variance."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, v: np.ndarray, linkage: str):
        self.ids, self.n, self.v, self.linkage = ids, n, v, linkage

    def heights(self, a: int, b: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Distances of cluster ``a`` to ``b``, the same from either end."""
        if self.linkage != "ward":
            return s
        n_a, n_b, lo, hi = self.n[a], self.n[b], np.minimum(a, b), np.maximum(a, b)
        return np.sqrt(2.0 * n_a * n_b / (n_a + n_b) * np.maximum(s - self.v[lo] - self.v[hi], 0.0))

    def nearest(self, a: int, b: np.ndarray, s: np.ndarray) -> tuple[int, float]:
        """The nearest of ``b``, which are in order, and its distance; ties as ``tie_break`` says."""
        d = self.heights(a, b, s)
        least = d.min()
        tied = b[d == least]
        if len(tied) > 1:
            tied = tied[[np.argmin(tree.tie_number(self.ids[np.minimum(a, tied)], self.ids[np.maximum(a, tied)]))]]
        return int(tied[0]), float(least)

    def packed(self, rows: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """The rows (a, b, s) as ``ROW``, some at a time; a cluster without edges has none."""
        out, size = [], 0
        for a, b, s in rows:
            if len(b):
                out.append((a, b.astype(np.int32).tobytes(), s.tobytes(), *self.nearest(a, b, s)))
                size += len(b)
            if size > BATCH_EDGES:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)


ROW = "a int, b binary, s binary, near int, d double"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in ROW.split(", ")])


def _least(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the least distance of each."""
    key, d = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.minimum.reduceat(d[order], first)


class PackedRounds:
    """The rounds from ``round_no`` on over packed rows, of at most ``PACKED`` clusters.

    ``edges`` are (a, b, d) as given, or (a, b, s) of a round before.
    """

    def __init__(self, state: DataFrame, edges: DataFrame, linkage: str, round_no: int, given: bool):
        self.spark, self.linkage, self.round_no = state.sparkSession, linkage, round_no
        # a fixed number of rows at most
        c = state.select("cid", "n", F.coalesce("key", F.lit(-1)).alias("key"), "h", "v").toPandas().sort_values("cid")
        self.key, self.h = c["key"].to_numpy(np.int64), c["h"].to_numpy(float)
        self.at = Clusters(c["cid"].to_numpy(np.int64), c["n"].to_numpy(float), c["v"].to_numpy(float), linkage)
        self.rows = table(self.pack(edges, given))

    def tasks(self) -> int:
        m = len(self.at.ids)
        return max(1, min(32, m // 64), -(-m * m // TASK_EDGES))

    def pack(self, edges: DataFrame, given: bool) -> DataFrame:
        at, m = self.spark.sparkContext.broadcast(self.at), len(self.at.ids)
        square = given and self.linkage == "ward"
        d = "d" if given else "s"
        ways = F.inline(F.array(F.struct("a", "b", F.col(d).alias("d")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col(d).alias("d"))))

        def build(batches):
            ids = at.value.ids
            # numbers without gaps are places
            place = (lambda x: x - ids[0]) if ids[-1] - ids[0] == m - 1 else lambda x: np.searchsorted(ids, x)
            held, size, limit = [], 0, TASK_EDGES
            for batch in batches:
                a, b, d = (batch.column(c).to_numpy(zero_copy_only=False) for c in "abd")
                ok = np.isfinite(d)
                held.append((place(a[ok]) * m + place(b[ok]), d[ok]))
                size += len(held[-1][0])
                if size > limit:
                    held = [_least(held)]
                    size = len(held[0][0])
                    limit = max(TASK_EDGES, 2 * size)
            if not size:
                return
            key, d = _least(held)
            a, b = key // m, key % m
            first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            yield from at.value.packed((int(a[i]), b[i:j], d[i:j] * d[i:j] if square else d[i:j]) for i, j in zip(first, [*first[1:], len(a)]))

        return edges.select("a", "b", d).select(ways).repartition(self.tasks(), "a").mapInArrow(build, ROW)

    def run(self) -> DataFrame:
        names = [c.split()[0] for c in tree.MERGE_ROW.split(", ")]
        kinds = [pa.float64() if c == "height" else pa.int32() if c == "round" else pa.int64() for c in names]
        found, last = [pa.table({c: pa.array([], k) for c, k in zip(names, kinds)})], None
        while len(self.at.ids) > 1:
            if len(self.at.ids) <= tree.LAST_CLUSTERS * tree.LAST_EXACT:
                last = self.finish()
                break
            merges = self.mutual()
            if not len(merges[0]):
                break  # nothing is left that a pair connects
            found.append(pa.table([pa.array(c, k, mask=c < 0 if name.endswith("_key") else None) for name, c, k in zip(names, self.merge(*merges), kinds)], names=names))
            self.round_no += 1
        done = self.spark.createDataFrame(pa.concat_tables(found), tree.MERGE_ROW)
        return done if last is None else done.unionByName(last)

    def mutual(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Winners, losers and distances of the clusters that are each other's nearest."""
        f = self.rows.select("a", "near", "d").toPandas()
        near, d = np.full(len(self.at.ids), -1), np.zeros(len(self.at.ids))
        near[f["a"]], d[f["a"]] = f["near"], f["d"]
        here = np.flatnonzero(near > np.arange(len(near)))
        here = here[near[near[here]] == here]
        return here, near[here], d[here]

    def merge(self, winner: np.ndarray, loser: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
        """Merge records, as ``merged_rows`` gives them; clusters and rows become those of the next round."""
        old, m = self.at, len(self.at.ids)
        height, size = np.maximum(np.maximum(d, self.h[winner]), self.h[loser]), old.n[winner] + old.n[loser]
        records = (old.ids[winner], old.ids[loser], self.key[winner], self.key[loser], height, size, np.full(len(d), self.round_no), old.ids[winner])
        n, v = old.n.copy(), old.v.copy()
        n[winner] = size
        if self.linkage == "ward":
            # mean squared distance to the mean of the union
            v[winner] = (old.n[winner] * v[winner] + old.n[loser] * v[loser]) / size + d * d / (2 * size)
        self.h[winner], self.key[winner] = height, old.ids[loser]
        stay = np.ones(m, bool)
        stay[loser] = False
        first, second = np.flatnonzero(stay), np.full(m, m)
        second[winner] = loser
        second = second[first]
        to = np.cumsum(stay) - 1
        to[loser] = to[winner]
        self.at, self.h, self.key = Clusters(old.ids[stay], n[stay], v[stay], self.linkage), self.h[stay], self.key[stay]
        self.rows = table(self.contract(old, first, second, to))
        return records

    def contract(self, old: Clusters, first: np.ndarray, second: np.ndarray, to: np.ndarray) -> DataFrame:
        """Rows of the new clusters, each made of ``first`` and ``second`` (none: the number of old clusters)."""
        linkage, m = self.linkage, len(old.ids)
        sent = self.spark.sparkContext.broadcast((self.at, np.r_[old.n, 0.0], first, second))
        moved = self.spark.createDataFrame(pa.table({"a": pa.array(np.arange(m), pa.int32()), "key": pa.array(to, pa.int32())}), "a int, key int")
        # what an absent second cluster adds
        none = {"single": np.inf, "complete": -np.inf}.get(linkage, 0.0)

        def line(row):
            x = np.full(m + 1, np.inf)
            x[m] = none
            if row is not None:
                x[np.frombuffer(row[0], np.int32)] = np.frombuffer(row[1])
            return x

        def made(held):
            at, n, one, two = sent.value
            w_1, w_2 = n[one], n[two]
            for key, rows in held.items():
                x, a, b = line(rows.get(one[key])), one[key], two[key]
                y = np.full(m + 1, none) if b == m else line(rows.get(b))
                if linkage in ("single", "complete"):
                    most = np.minimum if linkage == "single" else np.maximum
                    s = most(most(x[one], y[two]), most(x[two], y[one]))
                else:
                    # added crosswise, so that both ends of an edge get the same sum
                    s = ((n[a] * w_1 * x[one] + n[b] * w_2 * y[two]) + (n[a] * w_2 * x[two] + n[b] * w_1 * y[one])) / (at.n[key] * at.n)
                # a missing pair makes two clusters infinitely far
                s[key] = np.inf
                near = np.flatnonzero(np.isfinite(s))
                yield int(key), near, s[near]

        def run(batches):
            held: dict = {}
            for batch in batches:
                for key, a, b, s in zip(*(batch.column(c).to_pylist() for c in ("key", "a", "b", "s"))):
                    held.setdefault(key, {})[a] = b, s
            yield from sent.value[0].packed(made(held))

        # rows of a task are bounded, as TASK_EDGES says
        rows = self.rows.select("a", "b", "s").join(F.broadcast(moved), "a").select("key", "a", "b", "s")
        return rows.repartition(max(self.tasks(), -(-m * m // TASK_EDGES)), "key").mapInArrow(run, ROW)

    def finish(self) -> DataFrame:
        """All merges among the few clusters that remain, by one task."""
        at, h, key, linkage, round_no = self.at, list(self.h), list(self.key), self.linkage, self.round_no

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            d = np.full((len(at.ids), len(at.ids)), np.inf)
            for f in frames:
                for a, b, s in zip(f["a"], f["b"], f["s"]):
                    b = np.frombuffer(b, np.int32)
                    d[a, b] = at.heights(a, b, np.frombuffer(s))
            yield tree._merge_matrix(at.ids, d, at.n.astype(np.int64), h, key, linkage, round_no)

        return cut(self.rows.select("a", "b", "s").repartition(1).mapInPandas(run, tree.MERGE_ROW))


def _rows(ids: DataFrame) -> tuple[DataFrame, int]:
    """Rows ``num, id``, and how many."""
    rows = cut(number_rows(ids.select("id"), [F.col("id")], "num"))
    return rows, rows.count()


def _valid(pairs: DataFrame) -> DataFrame:
    """``a, b, d`` of the pairs that have a distance."""
    return pairs.filter("distance IS NOT NULL AND NOT isnan(distance) AND a <> b").select("a", "b", F.col("distance").cast("double").alias("d"))


def _numbered(rows: DataFrame, n: int, pairs: DataFrame) -> DataFrame:
    """Edges between the numbers of rows; of pairs given more than once the least distance counts."""
    few, known = n <= PACKED, _valid(pairs)
    for side in "ab":
        of_side = rows.select(F.col("id").alias(side), F.col("num").alias(f"_{side}"))
        known = known.join(F.broadcast(of_side) if few else of_side, side)
    known = known.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "d")
    return known if few else known.groupBy("a", "b").agg(F.min("d").alias("d"))


def pair_tree(ids: DataFrame, pairs: DataFrame, linkage: str, once: bool = False) -> tree.MergeTree:
    """Merge tree of the rows ``ids(id)`` from ``pairs(a, b, distance)``; a forest if pairs are missing.

    ``once``: no pair is given twice, nor both ways. Then pairs need not meet their copies, and a long table of them is read
    level by level instead of being kept (``levels``). ``ValueError`` or an error of the job if one is seen to come twice.
    """
    from . import levels

    if linkage not in tree.LINKAGES:
        raise ValueError(f"linkage must be one of {tree.LINKAGES}")
    rows, n = _rows(ids)
    if n < 2:
        raise ValueError("at least 2 rows are needed")
    if once and n * (n - 1) // 2 > levels.LEVEL_EDGES and n <= levels.MOST_ROWS:
        near = _valid(pairs).filter(F.abs("d") < float("inf"))
        return _tree(rows, n, levels.Levels(rows, n, near, linkage).run())
    edges = _numbered(rows, n, pairs)
    state = rows.select(F.col("num").alias("cid"), F.lit(1).cast("long").alias("n"), F.lit(None).cast("long").alias("key"), F.lit(0.0).alias("h"))
    return _tree(rows, n, PairRounds(state, edges, linkage).run())


def _tree(rows: DataFrame, n: int, merges: DataFrame) -> tree.MergeTree:
    ranked = tree._ranked(cut(merges), n)
    return tree.MergeTree(rows, n, ranked, lambda: ranked, "id")


def agglomerative_pairs(ids: DataFrame, pairs: DataFrame, n_clusters: int = 3, linkage: str = "average", once: bool = False) -> DataFrame:
    """``id, cluster_label`` of ``ids(id)`` from a table of distances ``(a, b, distance)``, each pair given once or both ways (``once``: never twice).

    Clusters are numbered by their smallest id. Pairs that are missing, null or NaN are infinitely far;
    ``ValueError`` if they leave more than ``n_clusters`` clusters that nothing connects.
    """
    tree._check(linkage, "euclidean", n_clusters)
    return pair_tree(ids, pairs, linkage, once).cut_at(n_clusters)


def linkage_pairs(ids: DataFrame, pairs: DataFrame, method: str = "average", once: bool = False) -> DataFrame:
    """The merges as ``linkage_table`` gives them; fewer than n - 1 if pairs are missing. ``once``: no pair is given twice."""
    return pair_tree(ids, pairs, method, once).table()
