"""KMeans and scores on features with sparse one-hot blocks.

A row is its dense features plus, for each block, one category number ``w_i`` and what that adds, ``v_i``.
The block's other values are the same for all rows, and no distance changes if they are taken as 0. So the
squared distance to a centre c is the dense part plus, for each block, v^2 - 2 v c[w] + |c|^2: only the
centre's value at the row's own category is needed. Those values are a table (block, code, one
value a cluster), as long as the dictionary and no longer, and rows are joined with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import num, plus
from ..plans.cut import table
from ..plans.skew import attach


@dataclass(frozen=True)
class WideCentres:
    """``dense``: a list for each cluster; ``values``: block, code, n (rows), c (value of each cluster that has one); ``squares``: |c|^2 of the blocks."""

    dense: list[list[float]]
    values: DataFrame
    squares: list[float]


def with_centre_values(rows: DataFrame, n_blocks: int, centres: WideCentres) -> DataFrame:
    """``rows`` with ``_c_i``, the clusters' values at the row's category of block i."""
    for i in range(n_blocks):
        own = centres.values.filter(F.col("block") == i).select(F.col("code").alias(f"w_{i}"), F.col("c").alias(f"_c_{i}"), F.col("n").alias("_n"))
        rows = attach(rows, own, [f"w_{i}"], "_n", "left").drop("_n")
    return rows


def squared(f_cols: list[str], n_blocks: int, centres: WideCentres, k: int) -> str:
    """Squared distance to cluster ``k`` as SQL, after ``with_centre_values``."""
    terms = [f"({f} - {num(c)}) * ({f} - {num(c)})" for f, c in zip(f_cols, centres.dense[k])]
    terms += [f"v_{i} * v_{i} - 2D * v_{i} * coalesce(_c_{i}[{k}], 0D)" for i in range(n_blocks)]
    return f"greatest({plus([*terms, num(centres.squares[k])])}, 0D)"


def nearest(rows: DataFrame, f_cols: list[str], n_blocks: int, centres: WideCentres) -> DataFrame:
    """``rows`` with ``_near``, the struct (d2, c) of the nearest centre."""
    options = [f"named_struct('d2', {squared(f_cols, n_blocks, centres, k)}, 'c', {k})" for k in range(len(centres.dense))]
    ready = with_centre_values(rows, n_blocks, centres)
    return ready.withColumn("_near", F.expr(f"array_min(array({', '.join(options)}))")).drop(*[f"_c_{i}" for i in range(n_blocks)])


def centres_of(rows: DataFrame, f_cols: list[str], n_blocks: int, k: int, label: str, old: WideCentres | None = None) -> WideCentres:
    """Means of the labelled rows; a cluster without rows keeps its old centre."""
    found = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f) for f in f_cols]).collect()
    dense = [list(c) for c in old.dense] if old else [[0.0] * len(f_cols) for _ in range(k)]
    n = {}
    for r in found:
        dense[r[label]], n[r[label]] = [r[f] for f in f_cols], r["n"]
    size = F.lit(0.0)
    for c, rows_of in n.items():
        size = F.when(F.col("c") == c, F.lit(float(rows_of))).otherwise(size)
    entries = F.array(*[F.struct(F.lit(i).alias("block"), F.col(f"w_{i}").alias("code"), F.col(f"v_{i}").alias("v")) for i in range(n_blocks)])
    sums = (
        rows.select(F.col(label).alias("c"), F.inline(entries)).filter("code >= 0")
        .groupBy("block", "code", "c").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
        .select("block", "code", "n", "c", (F.col("s") / size).alias("x"))
    )
    empty = [c for c in range(k) if c not in n]
    if empty and old is not None:
        kept = old.values.select("block", "code", F.explode("c").alias("c", "x")).filter(F.col("c").isin(empty))
        sums = sums.unionByName(kept.select("block", "code", F.lit(0).cast("long").alias("n"), "c", "x"))
    values = table(
        sums.groupBy("block", "code").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("c", "x"))).alias("c"))
    )
    return WideCentres(dense, values, _squares(values, k))


def _squares(values: DataFrame, k: int) -> list[float]:
    found = values.select(F.explode("c").alias("c", "x")).groupBy("c").agg(F.sum(F.col("x") * F.col("x")).alias("s")).collect()
    by = {r["c"]: r["s"] for r in found}
    return [by.get(c, 0.0) for c in range(k)]


def _shift(old: WideCentres, new: WideCentres) -> float:
    """Sum of the squared moves of all centres."""
    dense = sum((a - b) ** 2 for x, y in zip(old.dense, new.dense) for a, b in zip(x, y))
    both = old.values.select("block", "code", F.explode("c").alias("c", "x")).join(
        new.values.select("block", "code", F.explode("c").alias("c", "y")), ["block", "code", "c"]
    )
    inner = both.agg(F.sum(F.col("x") * F.col("y"))).first()[0] or 0.0
    return dense + max(0.0, sum(old.squares) + sum(new.squares) - 2 * inner)


def rows_as_centres(rows: DataFrame, f_cols: list[str], n_blocks: int, found: list) -> WideCentres:
    """Centres that are the given rows."""
    spark = rows.sparkSession
    values: dict = {}
    for k, r in enumerate(found):
        for i in range(n_blocks):
            if r[f"w_{i}"] >= 0:
                values.setdefault((i, r[f"w_{i}"]), {})[k] = r[f"v_{i}"]
    flat = [(b, code, 1, c) for (b, code), c in values.items()]
    frame = spark.createDataFrame(flat, "block int, code long, n long, c map<int, double>")
    squares = [sum(r[f"v_{i}"] ** 2 for i in range(n_blocks) if r[f"w_{i}"] >= 0) for r in found]
    return WideCentres([[r[f] for f in f_cols] for r in found], frame, squares)


def _to_row(f_cols: list[str], n_blocks: int, r) -> Column:
    """Squared distance to a given row."""
    terms = [f"({f} - {num(r[f])}) * ({f} - {num(r[f])})" for f in f_cols]
    for i in range(n_blocks):
        terms.append(f"CASE WHEN w_{i} = {r[f'w_{i}']} THEN 0D ELSE v_{i} * v_{i} + {num(r[f'v_{i}'] ** 2)} END")
    return F.expr(plus(terms))


def drawn_rows(rows: DataFrame, id_col: str, f_cols: list[str], n_blocks: int, k: int, seed: int, spread: bool) -> list:
    """``k`` rows to start from: by a hash of the id, or with a chance that grows with the squared distance to those before (k-means++)."""
    found = []
    for i in range(k):
        u = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed), F.lit(i)), 11) + 0.5) / F.lit(float(1 << 53))
        weight = F.least(*[_to_row(f_cols, n_blocks, r) for r in found], F.lit(float("inf"))) if found and spread else F.lit(1.0)
        order = F.when(weight > 0, -F.log(u) / weight).otherwise(F.lit(float("inf")))
        left = rows.filter(~F.col(id_col).isin([r[id_col] for r in found])) if found else rows
        best = left.agg(F.min(F.struct(order.alias("o"), *[F.col(c) for c in rows.columns])).alias("r")).first()["r"]
        if best is None:
            raise ValueError("more clusters than rows")
        found.append(best)
    return found


def lloyd(rows: DataFrame, f_cols: list[str], n_blocks: int, centres: WideCentres, max_iter: int, tol: float):
    """Centres and number of rounds; each is a join with the centres' values and two aggregations."""
    limit, k, done = 0.0, len(centres.dense), 0
    if tol > 0:
        # the mean variance of the dense features; one-hot ones with many values have little
        row = rows.agg(*[F.var_pop(f).alias(f) for f in f_cols]).first() if f_cols else {}
        limit = tol * (sum(row[f] for f in f_cols) / len(f_cols) if f_cols else 1.0)
    for done in range(1, max_iter + 1):
        labelled = nearest(rows, f_cols, n_blocks, centres).withColumn("_c", F.col("_near.c"))
        moved = centres_of(labelled, f_cols, n_blocks, k, "_c", centres)
        shift = _shift(centres, moved)
        centres = moved
        if shift <= limit:
            break
    return centres, done


def fit(features: DataFrame, id_col: str, f_cols: list[str], n_blocks: int, k: int, init, starts: int, seed: int, max_iter: int, tol: float):
    """Labels (id, cluster_label), centres, inertia and rounds of the cheapest of several fits.

    ``init``: "k-means++", "random", or a list of the ids of the rows to start from.
    """
    rows = table(features)
    best = None
    for s in range(starts if isinstance(init, str) else 1):
        if isinstance(init, str):
            first = drawn_rows(rows, id_col, f_cols, n_blocks, k, seed + s, init != "random")
        else:
            by_id = {r[id_col]: r for r in rows.filter(F.col(id_col).isin(list(init))).collect()}
            if len(by_id) != k:
                raise ValueError("init must name n_clusters different rows")
            first = [by_id[i] for i in init]
        centres, rounds = lloyd(rows, f_cols, n_blocks, rows_as_centres(rows, f_cols, n_blocks, first), max_iter, tol)
        labelled = table(nearest(rows, f_cols, n_blocks, centres).select(id_col, F.col("_near.c").alias("cluster_label"), F.col("_near.d2").alias("d2")))
        inertia = labelled.agg(F.sum("d2")).first()[0]
        if best is None or inertia < best[2]:
            best = labelled.select(id_col, "cluster_label"), centres, inertia, rounds
    return best


def scores(labelled: DataFrame, f_cols: list[str], n_blocks: int, label: str) -> tuple[float | None, float | None]:
    """Calinski-Harabasz and Davies-Bouldin scores of labelled rows; None unless 2 <= labels < rows."""
    names = [r[label] for r in labelled.select(label).distinct().orderBy(label).collect()]
    k = len(names)
    number = F.coalesce(*[F.when(F.col(label) == v, F.lit(i)) for i, v in enumerate(names)]) if names else F.lit(0)
    rows = table(labelled.withColumn("_c", number))
    sizes = {r["_c"]: r["n"] for r in rows.groupBy("_c").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    if not 2 <= k < n:
        return None, None
    centres = centres_of(rows, f_cols, n_blocks, k, "_c")
    own = F.coalesce(*[F.when(F.col("_c") == c, F.expr(squared(f_cols, n_blocks, centres, c))) for c in range(k)])
    spread = with_centre_values(rows, n_blocks, centres).groupBy("_c").agg(F.sum(own).alias("w"), F.avg(F.sqrt(own)).alias("s")).collect()
    within, radius = sum(r["w"] for r in spread), {r["_c"]: r["s"] for r in spread}
    # inner products of the centres, from the rows of the value table that several share
    pairs = centres.values.select(F.explode("c").alias("a", "x"), "c").select("a", "x", F.explode("c").alias("b", "y"))
    inner = {(r["a"], r["b"]): r["p"] for r in pairs.groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("p")).collect()}

    def dot(a, b):
        return sum(x * y for x, y in zip(centres.dense[a], centres.dense[b])) + inner.get((a, b), 0.0)

    whole = sum(sizes[a] * sizes[b] * dot(a, b) for a in range(k) for b in range(k)) / n
    between = sum(sizes[a] * dot(a, a) for a in range(k)) - whole
    ch = 1.0 if within == 0 else between * (n - k) / (within * (k - 1))

    def gap(a, b):
        return max(0.0, dot(a, a) + dot(b, b) - 2 * dot(a, b)) ** 0.5

    worst = [max((radius[a] + radius[b]) / gap(a, b) if gap(a, b) > 0 else 0.0 for b in range(k) if b != a) for a in range(k)]
    return ch, sum(worst) / k
