"""Bottom-up clustering with ward, complete, average and single linkage.

All four linkages are reducible, so every pair of clusters that are each
other's nearest can merge in the same round and the tree is the one that
merging one pair at a time would give (Bruynooghe, 1977). A round is a search
for every cluster's nearest partner, a self-join for the mutual pairs and an
update of the cluster table.

The nearest partner is found without a table of all pairs. For ward, and for
the average of cosine distances, the distance follows from the two centres.
For complete and average linkage the centres bound it from both sides; only
pairs whose lower bound is under the best upper bound are measured, on blocks
of their rows. Single linkage goes by a minimum spanning tree.

Up to ``PAIR_ROWS`` different rows a table of all pairs is small, and merging goes by contraction of
that table (``pairs``), as it does if the features have sparse blocks or distances are given.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import all_zero, check_metric, distance, distance_matrix, unit_length
from ..plans.blocks import join_blocks, matrix, near_pairs, pack, spatial_blocks, spread
from ..plans.components import connected_components
from ..plans.cut import cut, table
from ..plans.numbering import number_rows
from ..plans.skew import attach
from .features import FeatureSpec, fit_features
from .result import LABEL, ClusterResult

LINKAGES = ("ward", "complete", "average", "single")
MEMBER_ROWS = 256      # rows of one cluster in one block
BLOCK_ROWS = 512       # clusters in one block
LAST_CLUSTERS = 128    # times LAST_EXACT, so few are merged to the end by one task
LAST_EXACT = 8
LAST_ROWS = 4_096      # rows of a group, of which there are up to 16 at least, where those clusters' rows meet
LAST_VALUES = 4_000_000  # numbers of a group at most
PAIR_ROWS = 3_000      # different rows up to which all distances are measured once and kept
MERGE_ROW = (
    "winner long, loser long, left_key long, right_key long, height double, size long, round int, seq long"
)
SLACK = 1e-9  # room for rounding in bounds, relative


def agglomerative(
    df: DataFrame,
    id_col: str,
    cols: list[str] | None = None,
    n_clusters: int = 3,
    linkage: str = "ward",
    metric: str = "euclidean",
    scaler: str | None = "standard",
    cat_encoder: str = "ohe",
    extra_stages: list | None = None,
    spec: FeatureSpec | None = None,
) -> ClusterResult:
    """Merge rows bottom-up and cut the tree at ``n_clusters``.

    Clusters are numbered by their smallest row id.
    """
    _check(linkage, metric, n_clusters)
    spec = spec or fit_features(df, id_col, cols, scaler, cat_encoder, extra_stages)
    tree = merge_tree(spec.transform(df), id_col, spec.f_cols, linkage, metric, len(spec.sparse))
    labels = tree.cut_at(n_clusters)
    params = {"n_clusters": n_clusters, "linkage": linkage, "metric": metric}
    return ClusterResult("AgglomerativeClustering", params, spec, df, label_table=labels, tree=tree)


def _check(linkage: str, metric: str, n_clusters: int = 1):
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}")
    check_metric(metric)
    if linkage == "ward" and metric != "euclidean":
        raise ValueError("ward linkage works with the euclidean metric only")
    if not isinstance(n_clusters, int) or n_clusters < 1:
        raise ValueError("n_clusters must be at least 1")


def linkage_table(
    df: DataFrame, id_col: str, f_cols: list[str], method: str = "ward", metric: str = "euclidean"
) -> DataFrame:
    """``merge_id, left_id, right_id, distance, size``.

    Rows are 0 .. n-1 in the order of their ids; merge ``t`` makes node n + t.
    """
    _check(method, metric)
    return merge_tree(df, id_col, f_cols, method, metric).table()


class MergeTree:
    """Numbered rows ``num, id`` and the merges between them.

    ``links``: rank (order of the merge), winner, loser (one row of each side).
    ``nodes`` gives rank, left_id, right_id, height, size when they are wanted.
    """

    def __init__(self, rows: DataFrame, n: int, links: DataFrame, nodes, id_col: str):
        self.rows, self.n, self.links, self._nodes, self.id_col = rows, n, links, nodes, id_col

    @cached_property
    def nodes(self) -> DataFrame:
        return self._nodes()

    def table(self) -> DataFrame:
        return self.nodes.select(
            F.col("rank").alias("merge_id"),
            F.least("left_id", "right_id").alias("left_id"),
            F.greatest("left_id", "right_id").alias("right_id"),
            F.col("height").alias("distance"),
            "size",
        )

    def cut_at(self, k: int) -> DataFrame:
        """Labels after undoing the k - 1 highest merges."""
        if k > self.n:
            raise ValueError("more clusters than rows")
        apart = self.n - self.links.count()
        if k < apart:
            raise ValueError(f"the given pairs leave {apart} clusters that nothing connects")
        kept = self.links.filter(F.col("rank") < self.n - k)
        comps = connected_components(kept.select(F.col("winner").alias("a"), F.col("loser").alias("b")))
        joined = cut(
            self.rows.join(comps.withColumnRenamed("node", "num"), "num", "left")
            .select(F.col("id").alias(self.id_col), F.coalesce("comp", "num").alias("comp"))
        )
        sizes = joined.groupBy("comp").agg(F.count(F.lit(1)).alias("_n"))
        names = number_rows(sizes, [F.col("comp")], LABEL)
        out = attach(joined, names, ["comp"], "_n", small_rows=k)
        return cut(out.select(self.id_col, F.col(LABEL).cast("int").alias(LABEL)))


def merge_tree(df: DataFrame, id_col: str, f_cols: list[str], linkage: str, metric: str, blocks: int = 0) -> MergeTree:
    """The tree of rows with features ``f_cols`` and ``blocks`` sparse blocks (columns ``w_i``, ``v_i``)."""
    f_cols = [*f_cols, *[f"{c}_{i}" for i in range(blocks) for c in "wv"]]
    if blocks and metric == "cosine":
        raise ValueError("one-hot blocks of many values have no cosine distance here; encode them as ordinal")
    x_cols = [f"x_{i}" for i in range(len(f_cols))]
    rows = df.select(F.col(id_col).alias("id"), *[F.col(f).alias(x) for f, x in zip(f_cols, x_cols)])
    rows = cut(number_rows(rows, [F.col("id")], "num"))
    n = rows.count()
    if n < 2:
        raise ValueError("at least 2 rows are needed")
    if metric == "cosine":
        if not rows.filter(all_zero(x_cols)).isEmpty():
            raise ValueError("cosine linkage cannot place an all-zero row")
        rows = cut(unit_length(rows, x_cols))
    firsts, zero = _equal_rows(rows, x_cols)
    ids = rows.select("num", "id")
    different = firsts.count()
    if blocks or (linkage != "single" and different <= PAIR_ROWS):
        from .pairs import PairRounds, pair_table

        state = firsts.select("cid", "n", "key", F.lit(0.0).alias("h"))
        rounds = PairRounds(state, pair_table(firsts.select("cid", *x_cols), x_cols, metric, different, blocks), linkage).run()
        merges = _ranked(zero if rounds is None else zero.unionByName(rounds), n)
        return MergeTree(ids, n, merges, lambda: merges, id_col)
    if linkage == "single":
        from .spanning import SpanningTree

        found = SpanningTree(firsts, zero, n, x_cols, metric)
        return MergeTree(ids, n, found.links, found.nodes, id_col)
    rounds = _Rounds(firsts, x_cols, linkage, metric).run()
    merges = _ranked(zero if rounds is None else zero.unionByName(rounds), n)
    return MergeTree(ids, n, merges, lambda: merges, id_col)


def _equal_rows(rows: DataFrame, x_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Merge equal rows at height 0 one after the other.

    Returns one cluster ``cid, n, key, x_*`` per distinct row, and the merges.
    Doing this up front keeps a large group of copies from needing one round
    per copy; the order inside a group comes from one global numbering.
    """
    none = F.lit(None).cast("long")
    firsts = cut(rows.groupBy(*x_cols).agg(F.min("num").alias("cid"), F.count(F.lit(1)).alias("n")))
    copies = firsts.filter("n > 1")
    member = attach(rows, copies, x_cols, "n").select("cid", "num")
    placed = number_rows(member, [F.col("cid"), F.col("num")], "at")
    start = placed.groupBy("cid").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("_n"))
    seq = attach(placed, start, ["cid"], "_n").withColumn("j", F.col("at") - F.col("first_at"))
    before = placed.select((F.col("at") + 1).alias("at"), F.col("num").alias("prev"))
    merges = cut(
        seq.filter("j > 0").join(before, "at").select(
            F.col("cid").alias("winner"), F.col("num").alias("loser"),
            F.when(F.col("j") > 1, F.col("prev")).alias("left_key"), none.alias("right_key"),
            F.lit(0.0).alias("height"), (F.col("j") + 1).alias("size"), F.lit(0).alias("round"),
            F.col("at").alias("seq"),
        )
    )
    # the last merge of a group names its cluster
    last = merges.select(F.col("winner").alias("cid"), F.col("size").alias("n"), F.col("loser").alias("key"))
    return cut(firsts.join(last, ["cid", "n"], "left")), merges


def _ranked(merges: DataFrame, n: int) -> DataFrame:
    """Number the merges by height and name both sides by node number.

    A merge is known by its loser - every row but the first loses once.
    """
    ranked = cut(number_rows(merges, [F.col(c) for c in ("height", "round", "seq", "loser")], "rank"))
    names = ranked.select(F.col("loser").alias("_key"), (F.col("rank") + n).alias("_node"))
    left = names.select(F.col("_key").alias("left_key"), F.col("_node").alias("_left"))
    right = names.select(F.col("_key").alias("right_key"), F.col("_node").alias("_right"))
    return cut(
        ranked.join(left, "left_key", "left").join(right, "right_key", "left").select(
            "rank", "winner", "loser",
            F.coalesce("_left", "winner").alias("left_id"), F.coalesce("_right", "loser").alias("right_id"),
            "height", F.col("size").cast("long").alias("size"),
        )
    )


def tie_break(a, b):
    """A fixed order among equally near pairs; mixed, so that ties do not form chains."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    return F.pmod(lo * 48271 + hi * 69621, F.lit(2147483647))


def _tie_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return tie_number(np.minimum.outer(a, b), np.maximum.outer(a, b))


def tie_number(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """``tie_break`` of arrays."""
    return (lo * 48271 + hi * 69621) % 2147483647


def mutual_pairs(nearest: DataFrame) -> DataFrame:
    """``winner, loser, d`` of clusters that are each other's nearest."""
    back = nearest.select(F.col("a").alias("b"), F.col("b").alias("a"))
    return nearest.join(back, ["a", "b"]).filter("a < b").select(
        F.col("a").alias("winner"), F.col("b").alias("loser"), "d"
    )


def merged_rows(pairs: DataFrame, state: DataFrame, round_no: int) -> DataFrame:
    """Merge records of one round."""
    w = state.select(F.col("cid").alias("winner"), F.col("n").alias("n_w"), F.col("h").alias("h_w"), F.col("key").alias("left_key"))
    l = state.select(F.col("cid").alias("loser"), F.col("n").alias("n_l"), F.col("h").alias("h_l"), F.col("key").alias("right_key"))
    return pairs.join(w, "winner").join(l, "loser").select(
        "winner", "loser", "left_key", "right_key",
        # rounding may put a parent a hair below its child
        F.greatest("d", "h_w", "h_l").alias("height"),
        (F.col("n_w") + F.col("n_l")).alias("size"),
        F.lit(round_no).alias("round"), F.col("winner").alias("seq"),
    )


def _merge_matrix(ids, d, n, h, key, linkage, round_no) -> pd.DataFrame:
    """Merge a small distance matrix to one cluster (Lance-Williams updates)."""
    ids = np.asarray(ids, dtype=np.int64)
    n, h, key, out = list(n), list(h), list(key), []
    d = np.array(d, dtype=float)
    np.fill_diagonal(d, np.inf)
    live = np.argsort(ids)
    while len(live) > 1:
        # the same rule as between tables: all mutual nearest merge, ties by the mixed ids
        near = d[np.ix_(live, live)]
        if not np.isfinite(near).any():
            break  # what is left is infinitely far apart
        first = near == near.min(axis=1)[:, None]
        to = np.where(first, _tie_matrix(ids[live], ids[live]), np.iinfo("int64").max).argmin(axis=1)
        pairs = [(live[p], live[q]) for p, q in enumerate(to) if p < q and to[q] == p and np.isfinite(near[p, q])]
        if not pairs:
            raise RuntimeError("no two clusters are each other's nearest")
        for i, j in pairs:
            gap, a, b = d[i, j], d[i].copy(), d[j].copy()
            if linkage == "complete":
                new = np.maximum(a, b)
            elif linkage == "single":
                new = np.minimum(a, b)
            elif linkage == "average":
                new = (n[i] * a + n[j] * b) / (n[i] + n[j])
            else:
                m = np.asarray(n)
                square = (n[i] + m) * a * a + (n[j] + m) * b * b - m * gap * gap
                new = np.sqrt(np.maximum(square / (n[i] + n[j] + m), 0.0))
            height = max(gap, h[i], h[j])
            n[i] += n[j]
            left, right = (None if key[k] < 0 else key[k] for k in (i, j))
            out.append((ids[i], ids[j], left, right, height, n[i], round_no, ids[i]))
            h[i], key[i] = height, ids[j]
            new[i] = np.inf
            d[i] = d[:, i] = new
            d[j] = d[:, j] = np.inf
        gone = {j for _, j in pairs}
        live = np.array([k for k in live if k not in gone])
        round_no += 1
    frame = pd.DataFrame(out, columns=[c.split()[0] for c in MERGE_ROW.split(", ")])
    return frame.astype({"left_key": "Int64", "right_key": "Int64", "size": "int64"})


class _Rounds:
    """Ward, complete and average linkage from cluster centres."""

    def __init__(self, firsts: DataFrame, x_cols: list[str], linkage: str, metric: str):
        self.x, self.linkage, self.metric = x_cols, linkage, metric
        # between unit rows a cosine distance is half a squared chord, so the
        # largest of them belongs to the largest chord
        self.plane = "euclidean" if metric == "cosine" else metric
        self.halve = metric == "cosine" and linkage == "complete"
        self.exact = linkage == "ward" or (metric == "cosine" and linkage == "average")
        self.state = cut(
            firsts.select("cid", "n", "key", F.lit(0.0).alias("h"), F.lit(0.0).alias("r"), *x_cols)
        )
        self.members = None if self.exact else firsts.select(
            F.col("cid").alias("num"), F.col("n").alias("w"), "cid", *x_cols
        )

    def run(self) -> DataFrame | None:
        done, round_no, left = None, 0, self.state.count()
        while left > LAST_CLUSTERS * LAST_EXACT:
            round_no += 1
            nearest = cut(self.nearest(left))
            merges = cut(merged_rows(mutual_pairs(nearest), self.state, round_no))
            done = merges if done is None else done.unionByName(merges)
            found = merges.count()
            if not found:
                raise RuntimeError("no two clusters are each other's nearest")
            left -= found
            self.absorb(merges, left)
        if left > 1:
            last = self.last_merges(round_no + 1)
            done = last if done is None else done.unionByName(last)
        if done is None:
            return None
        return cut(done.withColumn("height", F.col("height") ** 2 / 2) if self.halve else done)

    def last_merges(self, round_no: int) -> DataFrame:
        """All merges among the at most ``LAST_CLUSTERS * LAST_EXACT`` clusters that remain.

        Their distances are one small matrix, measured on the rows by Spark
        where the centres do not give them. One task then merges to the end,
        which saves a round of Spark jobs for nearly every single merge.
        """
        dims, linkage, exact = len(self.x), self.linkage, self.exact
        average, bounds = linkage == "average", self.bounds()
        state = self.state.withColumn("key", F.coalesce("key", F.lit(-1))).withColumn("block", F.lit(0))
        packed = pack(state, "block", "cid", self.x, ["n", "r", "h", "key"])
        if not exact:
            pairs = self.between_all().groupBy(F.lit(0).alias("block")).agg(F.collect_list(F.struct("a", "b", "d")).alias("p"))
            packed = packed.join(
                pairs.select("block", *[F.col(f"p.{c}").alias(f"p_{c}") for c in "abd"]), "block", "left"
            )

        def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for row in f.itertuples(index=False):
                    ids, x, n = np.asarray(row.ids), matrix(row.x, dims), np.asarray(row.n, float)
                    d, _ = bounds(x, n, row.r, x, n, row.r)
                    if not exact and row.p_a is not None:
                        # blocks hold their rows in the order of the ids
                        i, j = np.searchsorted(ids, row.p_a), np.searchsorted(ids, row.p_b)
                        d[i, j] = d[j, i] = row.p_d / (n[i] * n[j]) if average else row.p_d
                    yield _merge_matrix(ids, d, n, row.h, row.key, linkage, round_no)

        return cut(packed.mapInPandas(finish, MERGE_ROW))

    def between_all(self) -> DataFrame:
        """``a, b, d`` of all pairs of clusters a < b: the sum of the weighted distances of their rows, for complete linkage the largest.

        Rows are dealt in the order of their clusters over groups, and each two groups meet in a task.
        """
        dims, plane, complete = len(self.x), self.plane, self.linkage == "complete"
        rows = cut(number_rows(self.members, [F.col("cid"), F.col("num")], "_at"))
        n = rows.count()
        groups = max(min(16, -(-n // LAST_ROWS)), -(-n * dims // LAST_VALUES), 1)
        every = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))
        of_group = F.floor(F.col("_at") * groups / F.lit(n)).cast("long")
        dealt = rows.withColumn("_g", of_group).withColumn("_h", F.explode(every)).select(
            F.least("_g", "_h").alias("ga"), F.greatest("_g", "_h").alias("gb"), "_g", "cid", "w", *self.x
        )

        def strips(cid):
            """Pieces of at most ``BLOCK_ROWS`` rows: where they begin and end, their clusters' first rows, and the places of those clusters."""
            names, of_row = np.unique(cid, return_inverse=True)
            out = []
            for lo in range(0, len(cid), BLOCK_ROWS):
                part = of_row[lo : lo + BLOCK_ROWS]
                out.append((slice(lo, lo + len(part)), np.flatnonzero(np.diff(part, prepend=-1)), slice(part[0], part[-1] + 1)))
            return names, out

        def meet(key, table):
            t = table.sort_by("cid")
            group, cid, w = (t.column(c).to_numpy() for c in ("_g", "cid", "w"))
            x = np.column_stack([t.column(c).to_numpy() for c in self_x])
            ga, gb = (k.as_py() for k in key)
            a, b = group == ga, group == gb
            (names_a, strips_a), (names_b, strips_b) = strips(cid[a]), strips(cid[b])
            x_a, x_b, w_a, w_b = x[a], x[b], w[a].astype(float), w[b].astype(float)
            d = np.zeros((len(names_a), len(names_b)))
            join = np.maximum if complete else np.add
            for rows_a, first_a, at_a in strips_a:
                for rows_b, first_b, at_b in strips_b:
                    gaps = distance_matrix(x_a[rows_a], x_b[rows_b], plane)
                    if not complete:
                        gaps *= w_a[rows_a, None] * w_b[None, rows_b]
                    part = join.reduceat(join.reduceat(gaps, first_a, axis=0), first_b, axis=1)
                    d[at_a, at_b] = join(d[at_a, at_b], part)
            i, j = np.nonzero(names_a[:, None] < names_b[None, :])
            return pa.table({"a": names_a[i], "b": names_b[j], "d": d[i, j]})

        self_x = self.x
        tasks = min(groups * (groups + 1) // 2, 4_096)
        met = dealt.repartition(tasks, "ga", "gb").groupBy("ga", "gb").applyInArrow(meet, "a long, b long, d double")
        return met.groupBy("a", "b").agg((F.max("d") if complete else F.sum("d")).alias("d"))

    # -- nearest partner ---------------------------------------------------

    def nearest(self, left: int) -> DataFrame:
        """``a, b, d`` with the nearest partner of every cluster."""
        met = self.candidates(left)
        if not self.exact:
            met = self.measured(cut(met))
        best = met.groupBy("a").agg(F.min(F.struct("d", tie_break(F.col("a"), F.col("b")).alias("t"), "b")).alias("m"))
        return best.select("a", F.col("m.b").alias("b"), F.col("m.d").alias("d"))

    def bounds(self):
        """Kernel: the distance of centres and the upper bound it implies.

        Ward, and average over cosine, are given by the centres: both values
        are then the cluster distance itself.
        """
        linkage, plane, exact = self.linkage, self.plane, self.exact

        def bounds(xa, na, ra, xb, nb, rb):
            d = distance_matrix(xa, xb, plane)
            if linkage == "ward":
                d *= np.sqrt(2.0 * np.multiply.outer(na, nb) / np.add.outer(na, nb))
            elif exact:
                # mean of 1 - cos over both clusters
                # one sum first, so that both directions round alike
                inner = 2.0 - ((xa * xa).sum(1)[:, None] + (xb * xb).sum(1)[None, :])
                d = (d * d + inner) / 2
            return d, d if exact else (d + np.add.outer(ra, rb)) * (1 + SLACK)

        return bounds

    def candidates(self, left: int) -> DataFrame:
        """``a, b, d, known``: per cluster the partners that can be its nearest.

        ``d`` is the distance where it follows from the centres (``known``).
        """
        dims, linkage, exact, bounds = len(self.x), self.linkage, self.exact, self.bounds()
        one_block = left <= BLOCK_ROWS
        if one_block:
            data = pack(self.state.withColumn("block", F.lit(0).cast("long")), "block", "cid", self.x, ["n", "r"])
        else:
            blocks = spatial_blocks(self.state, "cid", self.x, ["n", "r"], rows=BLOCK_ROWS)
            data = blocks.data

        def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                caps, reaches = [], []
                for x, n, r in zip(f["x"], f["n"], f["r"]):
                    x, n = matrix(x, dims), np.asarray(n, dtype=float)
                    _, high = bounds(x, n, r, x, n, r)
                    np.fill_diagonal(high, np.inf)
                    cap = high.min(axis=1)
                    caps.append(cap)
                    if linkage == "ward":
                        reach = cap / np.sqrt(2.0 * n / (n + 1.0))
                    elif exact:
                        # |mA - mB|^2 <= 2 d - 2 + |mA|^2 + 1
                        reach = np.sqrt(np.maximum(2.0 * cap - 1.0 + (x * x).sum(1), 0.0))
                    else:
                        reach = cap
                    reaches.append(reach.max() * (1 + 1e-9))
                yield f.assign(cap=caps, reach=reaches)

        def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for row in f.itertuples(index=False):
                    a, b = np.asarray(row.ids_a), np.asarray(row.ids_b)
                    d, high = bounds(
                        matrix(row.x_a, dims), np.asarray(row.n_a, dtype=float), row.r_a,
                        matrix(row.x_b, dims), np.asarray(row.n_b, dtype=float), row.r_b,
                    )
                    other = a[:, None] != b[None, :]
                    d = np.where(other, d, np.inf)
                    if exact:
                        first = d == d.min(axis=1)[:, None]
                        at = np.where(first, _tie_matrix(a, b), np.iinfo("int64").max).argmin(axis=1)
                        d = d[np.arange(len(a)), at]
                        keep = np.isfinite(d) & (d <= row.cap_a)
                        yield pd.DataFrame({"a": a[keep], "b": b[at][keep], "d": d[keep], "high": d[keep], "known": True})
                        continue
                    high = np.where(other, high, np.inf)
                    cap = np.minimum(row.cap_a, high.min(axis=1))
                    i, j = np.nonzero(other & (d * (1 - SLACK) <= cap[:, None]))
                    known = (np.add.outer(row.r_a, row.r_b) == 0.0)[i, j]
                    yield pd.DataFrame({"a": a[i], "b": b[j], "d": d[i, j], "high": high[i, j], "known": known})

        kept = "block long, ids array<long>, x array<double>, n array<long>, r array<double>, cap array<double>"
        first = data.mapInPandas(own, kept + ", reach double")
        if one_block:
            pairs = first.select(F.col("block").alias("a"), F.col("block").alias("b"))
            both = first.select(*[F.col(c).alias(f"{c}_a") for c in first.columns if c != "block"],
                                *[F.col(c).alias(f"{c}_b") for c in ("ids", "x", "n", "r")])
        else:
            first = cut(first)
            reach = blocks.boxes.join(first.select("block", F.col("reach").alias("bound")), "block")
            pairs = near_pairs(reach, blocks.n_blocks, dims, "bound", self.plane)
            both = spread(join_blocks(pairs, first.drop("reach"), first.drop("cap", "reach")), blocks.n_blocks)
        found = both.mapInPandas(pick, "a long, b long, d double, high double, known boolean")
        if exact or one_block:
            return found.select("a", "b", "d", "known")
        found = cut(found)
        caps = found.groupBy("a").agg(F.min("high").alias("cap"))
        return found.join(caps, "a").filter(F.col("d") * (1 - SLACK) <= F.col("cap")).select("a", "b", "d", "known")

    def measured(self, met: DataFrame) -> DataFrame:
        """Replace bounds by distances measured on the rows of both clusters."""
        dims, plane, complete = len(self.x), self.plane, self.linkage == "complete"
        known = met.filter("known").select("a", "b", "d")
        asked = met.filter("NOT known").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        slots = self.state.select("cid", F.ceil(F.col("n") / F.lit(MEMBER_ROWS)).cast("long").alias("slots"), "n")
        wide = asked.join(slots.select(F.col("cid").alias("a"), F.col("slots").alias("s_a")), "a").join(
            slots.select(F.col("cid").alias("b"), F.col("slots").alias("s_b")), "b"
        )
        zero = F.lit(0).cast("long")
        wide = wide.withColumn("i", F.explode(F.sequence(zero, F.col("s_a") - 1)))
        wide = wide.withColumn("j", F.explode(F.sequence(zero, F.col("s_b") - 1)))
        pairs = wide.select(F.struct(F.col("a").alias("cid"), F.col("i").alias("slot")).alias("a"),
                            F.struct(F.col("b").alias("cid"), F.col("j").alias("slot")).alias("b"))
        packed = pack(self.slotted(slots), ["cid", "slot"], "num", self.x, ["w"])
        packed = packed.select(F.struct("cid", "slot").alias("block"), "x", "w")

        def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                a, b, d = [], [], []
                for row in f.itertuples(index=False):
                    gaps = distance_matrix(matrix(row.x_a, dims), matrix(row.x_b, dims), plane)
                    a.append(row.a["cid"])
                    b.append(row.b["cid"])
                    d.append(gaps.max() if complete else np.asarray(row.w_a, float) @ gaps @ np.asarray(row.w_b, float))
                yield pd.DataFrame({"a": a, "b": b, "d": d})

        parts = join_blocks(pairs, packed, packed).mapInPandas(measure, "a long, b long, d double")
        if complete:
            values = parts.groupBy("a", "b").agg(F.max("d").alias("d"))
        else:
            n_a = self.state.select(F.col("cid").alias("a"), F.col("n").alias("n_a"))
            n_b = self.state.select(F.col("cid").alias("b"), F.col("n").alias("n_b"))
            sums = parts.groupBy("a", "b").agg(F.sum("d").alias("d")).join(n_a, "a").join(n_b, "b")
            values = sums.select("a", "b", (F.col("d") / (F.col("n_a") * F.col("n_b"))).alias("d"))
        ways = F.explode(F.array(F.struct("a", "b", "d"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "d")))
        return known.unionByName(values.select(ways.alias("w")).select("w.*"))

    def slotted(self, slots: DataFrame) -> DataFrame:
        return attach(self.members, slots, ["cid"], "n").withColumn(
            "slot", F.pmod(F.xxhash64("num"), F.col("slots"))
        )

    # -- after a round -----------------------------------------------------

    def absorb(self, merges: DataFrame, left: int) -> None:
        """Update clusters, and the rows' cluster where rows are still needed."""
        m = merges.select("winner", "loser", "height", "size")
        lost = self.state.select(F.col("cid").alias("loser"), F.col("n").alias("_n"), F.col("r").alias("_r"),
                                 *[F.col(c).alias(f"_{c}") for c in self.x])
        lost = m.join(lost, "loser").withColumnRenamed("winner", "cid")
        alive = self.state.join(m.select(F.col("loser").alias("cid")), "cid", "left_anti").join(lost, "cid", "left")
        both, n = F.col("size").isNotNull(), F.col("size")
        alive = alive.select("*", *[F.expr(f"({c} * n + _{c} * _n) / size AS m_{c}") for c in self.x])
        centre = [f"m_{c}" for c in self.x]
        own = distance(self.x, centre, self.plane) + F.col("r")
        other = distance([f"_{c}" for c in self.x], centre, self.plane) + F.col("_r")
        if self.linkage == "complete":
            r = F.greatest(own, other)
        else:
            r = (own * F.col("n") + other * F.col("_n")) / n
        r = F.lit(0.0) if self.exact else r
        self.state = table(
            alive.select(
                "cid", F.when(both, n).otherwise(F.col("n")).alias("n"),
                F.when(both, F.col("loser")).otherwise(F.col("key")).alias("key"),
                F.when(both, F.col("height")).otherwise(F.col("h")).alias("h"),
                F.when(both, r).otherwise(F.col("r")).alias("r"),
                *[F.expr(f"coalesce(m_{c}, {c}) AS {c}") for c in self.x],
            )
        )
        if self.members is not None and left > 1:
            moved = merges.select(F.col("loser").alias("cid"), F.col("winner").alias("_to"), F.col("size").alias("_s"))
            self.members = table(
                attach(self.members, moved, ["cid"], "_s", "left", small_rows=left + 1)
                .select("num", "w", F.coalesce("_to", "cid").alias("cid"), *self.x)
            )
