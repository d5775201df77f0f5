"""Agglomerative clustering from a table of more distances than can be kept.

The pairs of n rows are n * (n - 1) / 2: 4 billion for 90,000 rows. Here they are neither shuffled nor stored. The table is
read a few times, each time whole, and a reading adds up pairs where they arise: what leaves it is one row for two clusters
with a distance up to some ``reach``, how many of the distances between them are, and their sum (least, largest).

All other distances are larger than the reach. So the distance of two clusters is known where all pairs between them are
within it, and bounded from below elsewhere. A cluster whose nearest known partner is no further than any other can be has
found its nearest; two that are each other's merge, as everywhere. The others wait for the next reading, among fewer clusters
and with a longer reach, and in the last the reach is infinite. The merges are those of the whole table.

The reach is taken from the distances of some rows. It decides how much a reading finds, not what merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.cut import cut
from . import agglomerative as tree
from .pairs import Clusters, PairRounds

LEVEL_EDGES = 4_000_000  # pairs of rows the first reading is to find, about
LEVEL_CELLS = 1_000_000  # pairs of clusters a later one is to find; each task adds up its own
SAMPLE_PAIRS = 8_000_000  # pairs from which the reach is taken, about
MOST_ROWS = 1_000_000    # whose numbers, and clusters, are broadcast
TOO_MANY = 2             # times the pairs that were to be found
FINE = 32                # steps of the reach for each doubling
SLOW = 200               # a level ends when fewer than one of so many clusters merges in a round
LEVEL_ROW = f"{tree.MERGE_ROW}, v double"


class Levels:
    """The merges of ``rows(num, id)`` over ``pairs(a, b, d)`` of ids, each pair at most once."""

    def __init__(self, rows: DataFrame, n: int, pairs: DataFrame, linkage: str):
        self.spark, self.rows, self.n, self.pairs, self.linkage = rows.sparkSession, rows, n, pairs, linkage
        self.at = Clusters(np.arange(n), np.ones(n), np.zeros(n), linkage)
        self.h, self.key, self.of = np.zeros(n), np.full(n, -1), np.arange(n)  # of: the cluster of a row
        self.read = 0  # round of the next merge, as rounds are counted over all levels
        self.more = 1

    def run(self) -> DataFrame:
        done, first = None, True
        while True:
            left = len(self.at.ids)
            wanted = (LEVEL_EDGES if first else LEVEL_CELLS) * self.more
            reach, edges = self.level(wanted)
            if np.isinf(reach):
                break
            merges = cut(self.merged(edges, reach))
            done = merges.drop("v") if done is None else done.unionByName(merges.drop("v"))
            self.absorb(merges)
            first = False
            if len(self.at.ids) > 0.9 * left:
                self.more *= 4  # most of the nearest are further than the reach
        last = PairRounds(self.state(), self.whole(edges), self.linkage, self.read, given=False).run()
        return last if done is None else done if last is None else done.unionByName(last)

    # -- a reading ---------------------------------------------------------

    def level(self, wanted: int) -> tuple[float, DataFrame]:
        """A reach that about ``wanted`` pairs of clusters are in, and those pairs."""
        of = self.members()
        reach = self.reach(of, wanted)
        while True:
            edges = cut(self.cells(of, reach))
            found = 0 if np.isinf(reach) else edges.count()
            if found <= TOO_MANY * wanted:
                return reach, edges
            nearer = edges.approxQuantile("least", [wanted / found], 0.001)[0]
            reach = nearer if nearer < reach else np.inf

    def members(self) -> DataFrame:
        """``id, cid, n``: cluster and its size of every row."""
        size = np.zeros(self.n)
        size[self.at.ids] = self.at.n
        of = pa.table({"num": pa.array(np.arange(self.n)), "cid": pa.array(self.of), "n": pa.array(size[self.of])})
        return cut(self.rows.join(F.broadcast(self.spark.createDataFrame(of)), "num").select("id", "cid", "n"))

    def between(self, of: DataFrame, pairs: DataFrame) -> DataFrame:
        """``pairs`` with the clusters of both ends, where they differ."""
        for side in "ab":
            to = of.select(F.col("id").alias(side), F.col("cid").alias(f"c_{side}"), F.col("n").alias(f"n_{side}"))
            pairs = pairs.join(F.broadcast(to), side)
        return pairs.filter("c_a <> c_b")

    def reach(self, of: DataFrame, wanted: int) -> float:
        """The distance up to which there are about ``wanted`` pairs of clusters, from the distances of some rows."""
        left = len(self.at.ids)
        if left * (left - 1) // 2 <= wanted:
            return np.inf
        share = max(1, self.n * (self.n - 1) // 2 // SAMPLE_PAIRS)
        some = self.between(of, self.pairs.filter(F.pmod(F.xxhash64("a"), F.lit(share)) == 0))
        if left < self.n:
            # each row of a cluster stands for the whole of it
            some = some.groupBy("a", "c_b").agg(F.min("d").alias("d"), F.first("n_a").alias("n_a"))
        step = F.floor(F.log2("d") * FINE).alias("step")  # none for zero
        f = some.groupBy(step).agg(F.sum(1 / F.col("n_a")).alias("w")).toPandas().sort_values("step", na_position="first")
        upto = f["w"].cumsum().to_numpy() * share
        if not len(f) or upto[-1] <= wanted:
            return np.inf
        step = f["step"].iloc[max(np.searchsorted(upto, wanted, "right") - 1, 0)]
        return 0.0 if pd.isna(step) else float(2.0 ** ((step + 1) / FINE))

    def cells(self, of: DataFrame, reach: float) -> DataFrame:
        """``a, b, s, c, least``: clusters a < b, what their distances up to ``reach`` come to, how many, and the least."""
        near = self.pairs if np.isinf(reach) else self.pairs.filter(F.col("d") <= float(reach))
        value = F.col("d") * F.col("d") if self.linkage == "ward" else F.col("d")
        one = {"single": F.min, "complete": F.max}.get(self.linkage, F.sum)
        ends = F.least("c_a", "c_b").alias("a"), F.greatest("c_a", "c_b").alias("b")
        return self.between(of, near).select(*ends, "d", value.alias("s")).groupBy("a", "b").agg(
            one("s").alias("s"), F.count(F.lit(1)).cast("double").alias("c"), F.min("d").alias("least")
        )

    def whole(self, edges: DataFrame) -> DataFrame:
        """``a, b, s`` of clusters between which all pairs are given (one, for single linkage), as ``PairRounds`` keeps them."""
        if self.linkage == "single":
            return edges.select("a", "b", "s")
        state = self.state()
        for side in "ab":
            edges = edges.join(F.broadcast(state.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"))), side)
        w = F.col("n_a") * F.col("n_b")
        once = F.when(F.col("c") > w, F.raise_error(F.lit("a pair is given more than once"))).otherwise(F.col("c") == w)
        return edges.filter(once).select("a", "b", (F.col("s") if self.linkage == "complete" else F.col("s") / w).alias("s"))

    # -- merges ------------------------------------------------------------

    def state(self) -> DataFrame:
        at = self.at
        return self.spark.createDataFrame(
            pa.table({"cid": pa.array(at.ids, pa.int64()), "n": pa.array(at.n.astype(np.int64)), "key": pa.array(self.key, pa.int64(), mask=self.key < 0),
                      "h": pa.array(self.h), "v": pa.array(at.v)})
        )

    def merged(self, edges: DataFrame, reach: float) -> DataFrame:
        """The merges that are certain, of a fixed number of pairs whatever the table, by one task."""
        sent = self.spark.sparkContext.broadcast((self.at, self.h, self.key))
        linkage, round_no = self.linkage, self.read

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [[b.column(c).to_numpy(zero_copy_only=False) for c in "absc"] for b in batches]
            if held:
                at, h, key = sent.value
                a, b, s, c = (np.concatenate(x) for x in zip(*held))
                held.clear()
                yield from _rows(certain(at, h, key, np.searchsorted(at.ids, a), np.searchsorted(at.ids, b), s, c, linkage, reach, round_no))

        return edges.select("a", "b", "s", "c").repartition(1).mapInArrow(run, LEVEL_ROW)

    def absorb(self, merges: DataFrame) -> None:
        """Clusters after the merges of a level."""
        f = merges.toPandas().sort_values(["round", "seq"])
        if not len(f):
            return
        self.read = int(f["round"].max())
        at, (winner, loser) = self.at, (f[c].to_numpy(np.int64) for c in ("winner", "loser"))
        # of several merges of a winner the last counts
        w = np.searchsorted(at.ids, winner)
        at.n[w], at.v[w], self.h[w], self.key[w] = f["size"], f["v"], f["height"], loser
        stay = np.ones(len(at.ids), bool)
        stay[np.searchsorted(at.ids, loser)] = False
        self.at = Clusters(at.ids[stay], at.n[stay], at.v[stay], self.linkage)
        self.h, self.key = self.h[stay], self.key[stay]
        to = np.arange(self.n)
        to[loser] = winner
        while (to[to] != to).any():
            to = to[to]
        self.of = to[self.of]


def certain(at: Clusters, h, key, a, b, s, c, linkage: str, reach: float, round_no: int) -> list[tuple[np.ndarray, ...]]:
    """Merge records, and variances, round by round, over the pairs (a, b) of places with ``c`` distances up to ``reach`` that come to ``s``."""
    at, h, key = Clusters(at.ids, at.n.copy(), at.v.copy(), linkage), h.copy(), key.copy()
    n, v, m, out = at.n, at.v, len(at.ids), []
    floor = reach * reach if linkage == "ward" else reach
    live = np.ones(m, bool)
    a, b, s, c = _joined(np.minimum(a, b), np.maximum(a, b), s, c, linkage, m)
    while len(a):
        w = n[a] * n[b]
        if (c > w).any() and linkage != "single":
            raise ValueError("a pair is given more than once")
        known = np.ones(len(a), bool) if linkage == "single" else c == w
        if linkage == "complete":
            # further than the reach, as those not found
            a, b, s, c = (x[known] for x in (a, b, s, c))
            known = known[known]
        mean = s if linkage in ("single", "complete") else (s + (w - c) * floor) / w
        d = at.heights(a, b, mean)
        near, far = np.full(m, np.inf), _beyond(at, live, floor)
        for end in (a, b):
            np.minimum.at(near, end[known], d[known])
            np.minimum.at(far, end[~known], d[~known])
        to = _nearest(at.ids, a[known], b[known], d[known], near)
        to[near > far] = -1
        winner = np.flatnonzero(to > np.arange(m))
        winner = winner[to[to[winner]] == winner]
        if not len(winner):
            break
        loser, gap, round_no = to[winner], near[winner], round_no + 1
        height, size = np.maximum(np.maximum(gap, h[winner]), h[loser]), n[winner] + n[loser]
        if linkage == "ward":
            # mean squared distance to the mean of the union
            v[winner] = (n[winner] * v[winner] + n[loser] * v[loser]) / size + gap * gap / (2 * size)
        ids = at.ids
        out.append((ids[winner], ids[loser], key[winner], key[loser], height, size, np.full(len(winner), round_no), ids[winner], v[winner]))
        n[winner], h[winner], key[winner], live[loser] = size, height, ids[loser], False
        ends = len(np.unique(np.concatenate((a, b))))
        moved = np.arange(m)
        moved[loser] = winner
        a, b = moved[a], moved[b]
        apart = a != b
        a, b, s, c = (x[apart] for x in (a, b, s, c))
        a, b, s, c = _joined(np.minimum(a, b), np.maximum(a, b), s, c, linkage, m)
        if len(winner) * SLOW < ends:
            break
    return out


def _joined(a, b, s, c, linkage: str, m: int):
    """Pairs a < b of places in order, each once."""
    if not len(a):
        return a, b, s, c
    pair = a.astype(np.int64) * m + b
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    one = {"single": np.minimum, "complete": np.maximum}.get(linkage, np.add)
    return pair[first] // m, pair[first] % m, one.reduceat(s[order], first), np.add.reduceat(c[order], first)


def _beyond(at: Clusters, live: np.ndarray, floor: float) -> np.ndarray:
    """The distance that a cluster has at least to those with which no pair was found."""
    if at.linkage != "ward":
        return np.full(len(at.ids), floor)
    out = np.full(len(at.ids), np.inf)
    sizes, of = np.unique(at.n[live], return_inverse=True)
    most = np.zeros(len(sizes))
    np.maximum.at(most, of, at.v[live])
    for size, v in zip(sizes, most):
        out = np.minimum(out, 2.0 * at.n * size / (at.n + size) * np.maximum(floor - at.v - v, 0.0))
    return np.sqrt(out)


def _nearest(ids, a, b, d, near) -> np.ndarray:
    """For each place the other end of a pair of distance ``near``, or -1; ties as ``tie_break`` says."""
    to = np.full(len(ids), -1)
    x, y = [], []
    for one, other in ((a, b), (b, a)):
        least = d == near[one]
        x.append(one[least])
        y.append(other[least])
    x, y = np.concatenate(x), np.concatenate(y)
    t = tree.tie_number(ids[np.minimum(x, y)], ids[np.maximum(x, y)])
    order = np.lexsort((y, t, x))[::-1]
    to[x[order]] = y[order]  # the last assigned is the first in order
    return to


def _rows(rounds: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in LEVEL_ROW.split(", ")]
    kinds = [pa.float64() if c in ("height", "v") else pa.int32() if c == "round" else pa.int64() for c in names]
    for columns in rounds:
        arrays = [pa.array(x.astype(k.to_pandas_dtype()), k, mask=x < 0 if name.endswith("_key") else None) for name, x, k in zip(names, columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)
