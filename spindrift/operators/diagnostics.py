"""The data behind the diagnostic charts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import check_metric, distance_matrix, num, plus, unit_length
from ..plans.blocks import join_blocks, matrix, near_pairs, spatial_blocks
from ..plans.cut import cut
from ..plans.numbering import number_rows
from ..plans.skew import attach
from .evaluate import metric_rows, silhouette_samples
from .result import LABEL, ClusterResult


def scatter_data(result: ClusterResult, fx: str, fy: str) -> DataFrame:
    """Two processed features, chosen by name, with the label."""
    names = result.spec.names
    if len(names) < 2:
        raise ValueError("a scatter needs at least two features")
    if fx == fy:
        raise ValueError("choose two different features")
    for f in (fx, fy):
        if f not in names:
            raise ValueError(f"no feature {f!r}; there are {names}")
    x, y = (f"f_{names.index(f)}" for f in (fx, fy))
    return result.labelled_features.select(
        result.id_col, F.col(x).alias("x"), F.col(y).alias("y"), LABEL
    )


def pca_projection(result: ClusterResult, n_components: int = 2, ignore_noise: bool = False) -> DataFrame:
    """Two or three coordinates per row.

    Exactly that many features are shown as they are. With more, the features
    are centred and projected on the leading principal components, each signed
    so that its largest loading is positive.
    """
    if n_components not in (2, 3):
        raise ValueError("n_components must be 2 or 3")
    f_cols = result.f_cols
    if len(f_cols) < n_components:
        raise ValueError(f"only {len(f_cols)} feature(s), cannot show {n_components}")
    rows = metric_rows(result.labelled_features, ignore_noise)
    if rows.isEmpty():
        raise ValueError("no rows to project")
    pcs = [f"pc{i + 1}" for i in range(n_components)]
    if len(f_cols) == n_components:
        return rows.select(result.id_col, *[F.col(f).alias(p) for f, p in zip(f_cols, pcs)], LABEL)
    mean = rows.agg(*[F.avg(f).alias(f) for f in f_cols]).first()
    ready = rows.select(array_to_vector(F.array(*[F.col(f) - F.lit(mean[f]) for f in f_cols])).alias("v"))
    loadings = PCA(k=n_components, inputCol="v", outputCol="p").fit(ready).pc.toArray()
    out = []
    for j, p in enumerate(pcs):
        w = loadings[:, j]
        w = w if w[np.abs(w).argmax()] > 0 else -w
        out.append(F.expr(plus([f"({f} - {num(mean[f])}) * {num(v)}" for f, v in zip(f_cols, w)])).alias(p))
    return rows.select(result.id_col, *out, LABEL)


def silhouette_plot_data(result: ClusterResult, ignore_noise: bool = True) -> DataFrame:
    """Bars of a silhouette chart: ``cluster_label, y, s, mean_s``.

    Inside a cluster values ascend; the first bar is at 10 and clusters are
    10 apart.
    """
    rows = cut(metric_rows(result.labelled_features, ignore_noise))
    samples = cut(silhouette_samples(rows, result.id_col, result.f_cols))
    sizes = samples.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))
    if sizes.limit(2).count() < 2:
        raise ValueError("a silhouette chart needs at least two clusters")
    place = number_rows(sizes, [F.col(LABEL)], "_at", start=1)
    mean = samples.agg(F.avg("s").alias("mean_s"))
    ranked = number_rows(samples.select(LABEL, "s", result.id_col), [F.col(LABEL), F.col("s"), F.col(result.id_col)])
    return (
        attach(ranked, place, [LABEL], "n")
        .crossJoin(F.broadcast(mean))
        .select(LABEL, (F.col("pos") + F.col("_at") * 10).cast("long").alias("y"), "s", "mean_s")
    )


def k_distance(
    df: DataFrame,
    id_col: str,
    f_cols: list[str],
    k: int = 5,
    ignore_zero_distance: bool = True,
    metric: str = "euclidean",
    allow_empty: bool = False,
) -> DataFrame:
    """Sorted distances to the k-th nearest other row: ``sample_rank, k_distance``.

    If every row has k copies, no distance above zero is left: ``ValueError``, or no rows with ``allow_empty``.
    """
    near = kth_neighbour(df, id_col, f_cols, k, metric)
    if ignore_zero_distance:
        near = near.filter(F.col("k_distance") > 0)
    near = cut(near)
    if not allow_empty and near.isEmpty():
        raise ValueError("no k-distance above zero remains")
    ranked = number_rows(near, [F.col("k_distance"), F.col(id_col)], "sample_rank", start=1)
    return ranked.select("sample_rank", "k_distance")


def result_k_distance(
    result: ClusterResult, k: int | None = None, ignore_zero_distance: bool = True, metric: str | None = None
) -> DataFrame:
    """``k_distance`` of a fitted model, with its ``min_samples`` and metric as defaults."""
    k = result.params.get("min_samples", 5) if k is None else k
    metric = metric or result.params.get("metric", "euclidean")
    return k_distance(result.features, result.id_col, result.f_cols, k, ignore_zero_distance, metric)


def kth_neighbour(df: DataFrame, id_col: str, f_cols: list[str], k: int, metric: str = "euclidean") -> DataFrame:
    """``id, k_distance``, exact.

    The k best rows of its own block give every row an upper bound. Blocks
    whose boxes lie beyond the bound of a whole block are never joined, and of joined
    blocks only rows within a row's bound of the other box are compared.
    """
    check_metric(metric)
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = df.select(id_col, *f_cols)
    if metric == "cosine":
        rows = unit_length(rows, f_cols)
    blocks = spatial_blocks(cut(rows), id_col, f_cols, at_least=2 * (k + 1))
    if k >= blocks.n_rows:
        raise ValueError("k must be smaller than the number of rows")
    dims = blocks.dims

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            best = []
            for flat in frame["x"]:
                d = distance_matrix(matrix(flat, dims), matrix(flat, dims), metric)
                np.fill_diagonal(d, np.inf)
                best.append(_smallest(d, k).ravel())
            yield frame.assign(near=best)

    id_type = df.schema[id_col].dataType.simpleString()
    first = cut(
        blocks.data.mapInPandas(local, f"block long, ids array<{id_type}>, x array<double>, near array<double>")
    )
    # cosine distance c means a chord of sqrt(2 c) between unit rows
    reach = F.array_max("near")
    reach = F.sqrt(reach * 2.0) if metric == "cosine" else reach
    bounds = blocks.boxes.join(first.select("block", (reach * (1 + 1e-9)).alias("bound")), "block")
    box_metric = "manhattan" if metric == "manhattan" else "euclidean"
    # nothing is nearer than a copy
    bounds = bounds.filter("bound > 0")
    pairs = near_pairs(bounds, blocks.n_blocks, dims, "bound", box_metric, others=blocks.boxes).filter("a <> b")

    def closer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # lists of one row never share a neighbour: each pair of blocks is met once
        block, ids, x, best, cap = None, None, None, None, None

        def flush():
            closer_than = best[:, 0] < cap
            near = pd.Series(list(best[closer_than]), dtype=object)
            return pd.DataFrame({"id": np.asarray(ids)[closer_than], "near": near})

        for f in frames:
            for a, ids_a, x_a, near_a, x_b in zip(f["a"], f["ids_a"], f["x_a"], f["near_a"], f["x_b"]):
                if a != block:
                    if block is not None:
                        yield flush()
                    block, ids, x = a, ids_a, matrix(x_a, dims)
                    cap = matrix(near_a, k)[:, -1]
                    best = np.full((len(ids), k), np.inf)
                y, limit = matrix(x_b, dims), np.minimum(cap, best[:, -1])
                some = _from_box(x, y, metric) < limit
                if not some.any():
                    continue
                y = y[_from_box(y, x[some], metric) < limit[some].max()]
                d = distance_matrix(x[some], y, metric)
                best[some] = _smallest(np.hstack([best[some], d]), k)
        if block is not None:
            yield flush()

    joined = join_blocks(pairs, first, first.select("block", "x")).select("a", "ids_a", "x_a", "near_a", "x_b")
    later = joined.mapInPandas(closer, f"id {id_type}, near array<double>")
    own = first.select(
        F.explode(F.arrays_zip("ids", F.sequence(F.lit(0), F.size("ids") - 1).alias("at"))).alias("r"), "near"
    ).select(
        F.col("r.ids").alias("id"), F.slice("near", F.col("r.at") * k + 1, k).alias("near")
    )
    merged = own.unionByName(later).groupBy("id").agg(
        F.array_sort(F.flatten(F.collect_list("near"))).alias("near")
    )
    return merged.select(F.col("id").alias(id_col), F.get("near", F.lit(k - 1)).alias("k_distance"))


def _from_box(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """No more than the distance of each row of ``x`` from any row of ``y``, by the box of ``y``."""
    gap = np.maximum(np.maximum(y.min(axis=0) - x, x - y.max(axis=0)), 0.0)
    if metric == "manhattan":
        return gap.sum(axis=1) * (1 - 1e-9)
    square = (gap * gap).sum(axis=1)
    return (square / 2 if metric == "cosine" else np.sqrt(square)) * (1 - 1e-9)


def _smallest(d: np.ndarray, k: int) -> np.ndarray:
    """The k smallest of every row, ascending; padded with infinity."""
    if d.shape[1] < k:
        d = np.hstack([d, np.full((len(d), k - d.shape[1]), np.inf)])
    part = np.partition(d, k - 1, axis=1)[:, :k] if d.shape[1] > k else d
    return np.sort(part, axis=1)

