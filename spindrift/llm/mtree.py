"""Exact top-k inner products by best-first search of M-trees.

Ciaccia, Patella and Zezula, "M-tree" (1997). Integer vectors get one more component so that all have
the norm of the longest; the inner product with a query (whose own is 0) then falls as
the Euclidean distance grows, and the nearest are the best. Vectors are dealt to the nearest
of a few pivots, and each group becomes an M-tree: pages of entries with covering radii
and distances to their parents. A query searches the tree of its nearest pivot first;
the score it finds there says which other trees it must see at all.
"""

from __future__ import annotations

import heapq
import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.cut import table
from .common import hash_order

TREE_ROWS = 20_000  # different vectors of a tree, about
MAX_PIVOTS = 2_000  # beyond, the groups of the pivots are cut by a hash
PAGE = 128  # entries of a leaf
FANOUT = 16  # children of an inner page
QUERIES = 1_024  # of a block
SLACK = 1e-6  # for rounding of distances


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """vec_id, x: floor(scale * component) of each row whose components are all finite; the others take no part."""
    x = F.transform(vector_col, lambda v: v.cast("double"))
    good = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(
        F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)
    )
    return df.filter(good).select(F.col(id_col).alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("x"))


def _matrix(column, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(column), width))
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    return out


def _lifted(x: np.ndarray, norm2: float) -> np.ndarray:
    """Vectors with the component that gives all the same norm."""
    return np.column_stack([x, np.sqrt(np.maximum(0.0, norm2 - (x * x).sum(axis=1)))])


def _distances(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    d = x - point
    return np.sqrt(np.einsum("ij,ij->i", d, d))


class Tree:
    """An M-tree over different lifted vectors, as pages.

    A page holds its routing vector, covering radius and distance to its parent's routing vector,
    and either child pages or entries with their distances to the routing vector.
    """

    def __init__(self, x: np.ndarray, pages: list[dict] | None = None):
        self.x = x
        self.pages = pages if pages is not None else []
        if pages is None and len(x):
            self._grow(np.arange(len(x)), x[0], 0.0)

    def _grow(self, rows: np.ndarray, routing: np.ndarray, to_parent: float) -> int:
        number = len(self.pages)
        far = _distances(self.x[rows], routing)
        page = {"routing": routing, "radius": float(far.max()), "to_parent": to_parent, "children": None, "rows": None, "far": None}
        self.pages.append(page)
        if len(rows) <= PAGE:
            page["rows"], page["far"] = rows, far
            return number
        # pivots far apart: each next is the row farthest from those so far
        pivots, nearest = [int(far.argmax())], _distances(self.x[rows], self.x[rows[far.argmax()]])
        home = np.zeros(len(rows), int)
        while len(pivots) < FANOUT and nearest.max() > 0:
            new = int(nearest.argmax())
            d = _distances(self.x[rows], self.x[rows[new]])
            home[d < nearest] = len(pivots)
            nearest = np.minimum(nearest, d)
            pivots.append(new)
        page["children"] = [
            self._grow(rows[home == k], self.x[rows[p]], float(far[p])) for k, p in enumerate(pivots) if (home == k).any()
        ]
        return number

    def search(self, query: np.ndarray, score_of, k: int, worst: int | None, distance_of) -> list[tuple[int, int]]:
        """At most ``k`` best (-score, id), ties to the smaller id; ``worst`` is a score known to be reached.

        ``score_of(rows)`` gives (score, id) candidates of rows; ``distance_of(score)`` the distance that belongs to a score.
        """
        best: list[tuple[int, int]] = []
        limit = distance_of(worst) + SLACK if worst is not None else math.inf
        root = self.pages[0]
        d = float(_distances(root["routing"][None], query)[0])
        heap = [(max(0.0, d - root["radius"]), 0, d)]
        while heap:
            least, number, d = heapq.heappop(heap)
            if least > limit:
                break
            page = self.pages[number]
            if page["children"] is None:
                # |d(q, routing) - d(entry, routing)| bounds d(q, entry) from below
                near = page["rows"][np.abs(d - page["far"]) <= limit]
                if len(near):
                    best = sorted(best + score_of(near))[:k]
                    if len(best) == k:
                        limit = min(limit, distance_of(-best[-1][0]) + SLACK)
                continue
            open_ = [
                c for c in page["children"]
                if abs(d - self.pages[c]["to_parent"]) - self.pages[c]["radius"] <= limit
            ]
            if open_:
                to = _distances(np.stack([self.pages[c]["routing"] for c in open_]), query)
                for c, dc in zip(open_, to.tolist()):
                    bound = max(0.0, dc - self.pages[c]["radius"])
                    if bound <= limit:
                        heapq.heappush(heap, (bound, c, dc))
        return best


def top_k(
    df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the ``k`` other rows with the largest inner product.

    Components count as floor(256 * component), scores are whole numbers, ties go to the smaller id.
    Rows with a null id, a null vector, or null or non-finite components take no part. Shorter vectors end
    in zeros. Rows of one id never find each other, and a row found counts once. Of equal
    vectors only the k + 1 smallest ids are indexed: no others can be among the k best. An
    empty table has no results.

    The pivots are rows of the table, at most ``MAX_PIVOTS``, with the smallest hashes; all rows are indexed and the result is exact.
    """
    rows = table(integer_vectors(df, id_col, vector_col).distinct())
    queries = table(integer_vectors(df.filter(is_query), id_col, vector_col).distinct())
    place = F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))
    distinct = table(
        rows.withColumn("_place", place).filter(F.col("_place") <= k + 1)
        .groupBy("x").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    norm = F.aggregate("x", F.lit(0).cast("long"), lambda s, v: s + v * v)
    facts = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"), F.max(norm).alias("norm2")).first()
    kind = rows.schema["vec_id"].dataType.simpleString()
    out = f"query_id {kind}, vec_id {kind}, score long"
    n, width, norm2 = facts["n"], facts["width"] or 0, float(facts["norm2"] or 0)
    n_pivots = max(1, min(MAX_PIVOTS, math.ceil(n / TREE_ROWS)))
    drawn = distinct.select("x", hash_order(F.col("x"), 5).alias("_at")).orderBy("_at", "x").limit(n_pivots).collect()
    pivots = _lifted(_matrix([r["x"] for r in drawn], width), norm2)

    def nearest(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pivot and distance of lifted vectors."""
        d2 = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
        home = d2.argmin(axis=1)
        return home, np.sqrt(np.einsum("ij,ij->i", x - pivots[home], x - pivots[home]))

    def deal(frames):
        for pdf in frames:
            if len(pdf):
                home, far = nearest(_lifted(_matrix(pdf["x"], width), norm2))
                yield pdf.assign(pivot=home.astype(np.int32), far=far)

    dealt = table(distinct.mapInPandas(deal, f"x array<bigint>, ids array<{kind}>, pivot int, far double"))
    sizes = {r["pivot"]: r for r in dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect()}
    slices = {p: math.ceil(r["n"] / (2 * TREE_ROWS)) for p, r in sizes.items()}
    trees = [(p, s) for p in sorted(slices) for s in range(slices[p])]
    first_tree = {p: i for i, (p, s) in enumerate(trees) if s == 0}
    if not trees:
        return df.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    of_pivot = F.create_map(*[F.lit(v) for p in slices for v in (p, first_tree[p])])
    cut_in = F.create_map(*[F.lit(v) for p in slices for v in (p, slices[p])])
    in_tree = dealt.withColumn("tree", (of_pivot[F.col("pivot")] + F.pmod(F.xxhash64("x"), cut_in[F.col("pivot")])).cast("int"))

    def build(key, pdf):
        tree = Tree(_lifted(_matrix(pdf["x"], width), norm2))
        held = pickle.dumps((tree.x, tree.pages, [[int(i) for i in v] if kind == "bigint" else list(v) for v in pdf["ids"]]))
        return pd.DataFrame({"tree": [key[0]], "held": [held]})

    # a tree is bounded by some 2 * TREE_ROWS vectors
    index = table(in_tree.groupBy("tree").applyInPandas(build, "tree int, held binary"))
    n_queries = queries.count()
    blocks = max(1, math.ceil(n_queries / QUERIES))

    def search(_, held, pdf):
        found = []
        if len(held) and len(pdf):
            x, pages, ids_of = pickle.loads(held["held"].iloc[0])
            tree = Tree(x, pages)
            whole = x[:, :-1]
            for q, vector, worst in zip(pdf["query_id"], _matrix(pdf["x"], width), pdf["worst"]):
                q2 = float(vector @ vector)

                def candidates(near, q=q, vector=vector):
                    scores = np.rint(whole[near] @ vector).astype(np.int64)
                    if len(near) > k + 1:
                        # a row besides the query's own has an id that counts, so k + 1 rows of a page suffice, ties kept
                        keep = scores >= np.partition(scores, -k - 1)[-k - 1]
                        near, scores = near[keep], scores[keep]
                    return [(-s, i) for s, row in zip(scores.tolist(), near.tolist()) for i in ids_of[row] if i != q]

                hits = tree.search(
                    np.append(vector, 0.0), candidates, k, None if pd.isna(worst) else int(worst),
                    lambda s, q2=q2: math.sqrt(max(0.0, q2 + norm2 - 2 * s)),
                )
                found += [(q, i, -s) for s, i in hits]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    def ask(asked: DataFrame) -> DataFrame:
        """Search (tree, query_id, x, worst): a block of queries and a tree meet in one task."""
        asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        wanted = asked.select(F.col("tree").alias("at"), F.col("block").alias("part")).distinct()
        copies = index.join(wanted, F.col("tree") == F.col("at")).select("at", "part", "held")
        return copies.groupBy("at", "part").cogroup(asked.groupBy("tree", "block")).applyInPandas(search, out)

    def at_home(frames):
        for pdf in frames:
            if len(pdf):
                home, _ = nearest(np.column_stack([_matrix(pdf["x"], width), np.zeros(len(pdf))]))
                yield pd.DataFrame({"tree": [first_tree.get(h, 0) for h in home], "query_id": pdf["vec_id"], "x": pdf["x"]})

    asked = f"tree int, query_id {kind}, x array<bigint>"
    home = table(queries.mapInPandas(at_home, asked))
    first = table(ask(home.withColumn("worst", F.lit(None).cast("long"))))
    reached = (
        first.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("worst"))
        .filter(F.col("_n") >= k).select("query_id", "worst")
    )
    radius = {p: sizes[p]["radius"] for p in sizes}

    def elsewhere(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            x = np.column_stack([_matrix(pdf["x"], width), np.zeros(len(pdf))])
            limit = np.sqrt(np.maximum(0.0, (x * x).sum(axis=1) + norm2 - 2 * pdf["worst"].to_numpy(float))) + SLACK
            limit[np.isnan(limit)] = math.inf
            for tree, (p, _) in enumerate(trees):
                see = (_distances(x, pivots[p]) - radius[p] <= limit) & (pdf["tree"].to_numpy() != tree)
                if see.any():
                    yield pdf[see].assign(tree=tree)[["tree", "query_id", "x", "worst"]]

    second = ask(home.join(reached, "query_id", "left").mapInPandas(elsewhere, asked + ", worst long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = first.unionByName(second).distinct()
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
