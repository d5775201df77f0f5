"""KMeans: Spark's own trainer, restarts, and start centres given by the user."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.distance import distance_matrix
from ..plans.cut import table
from . import wide
from .features import FeatureSpec, fit_features
from .result import ClusterResult, nearest_centre

MAX_ITER, TOL = 300, 1e-4


def _check_k(k: int) -> int:
    if not isinstance(k, int) or k < 1:
        raise ValueError("the number of clusters must be at least 1")
    return k


def _starts(init, n_init) -> int:
    if n_init == "auto":
        return 10 if init == "random" else 1
    if not isinstance(n_init, int) or n_init < 1:
        raise ValueError("n_init must be 'auto' or a positive number")
    return n_init


def _mode(init: str) -> str:
    modes = {"k-means++": "k-means||", "k-means||": "k-means||", "random": "random"}
    if init not in modes:
        raise ValueError("init must be 'k-means++', 'random' or a list of centres")
    return modes[init]


def vectors(features: DataFrame, f_cols: list[str]) -> DataFrame:
    return features.select(array_to_vector(F.array(*f_cols)).alias("features")).persist(
        StorageLevel.MEMORY_AND_DISK
    )


def from_vectors(vecs: DataFrame, f_cols: list[str]) -> DataFrame:
    """The cached vectors as columns again."""
    parts = vecs.select(vector_to_array("features").alias("_v"))
    return parts.select(*[F.get("_v", F.lit(i)).alias(f) for i, f in enumerate(f_cols)])


def _fit_once(vecs: DataFrame, k: int, seed: int, mode: str):
    """Cost, centres and rounds of one fit; Spark's trainer starts at two clusters."""
    if k == 1:
        mean = vecs.select(Summarizer.mean(F.col("features"))).first()[0]
        return 0.0, [list(map(float, mean))], 1
    model = KMeans(
        featuresCol="features", k=k, seed=seed, initMode=mode, initSteps=5, maxIter=MAX_ITER, tol=TOL
    ).fit(vecs)
    return model.summary.trainingCost, [list(map(float, c)) for c in model.clusterCenters()], model.summary.numIter


def best_fit(vecs: DataFrame, k: int, random_state: int, init: str, n_init):
    """The cheapest of several seeded fits on the same cached vectors; several advance together, one is Spark's own."""
    mode = _mode(init)
    if random_state is None:
        random_state = random.randrange(2**31)
    seeds = [random_state + i for i in range(_starts(init, n_init))]
    if len(seeds) > 1:
        dims = vecs.select(F.size(vector_to_array("features"))).first()[0]
        cols = [f"f_{i}" for i in range(dims)]
        return min(shared_fits(from_vectors(vecs, cols), cols, [k], seeds, init).values(), key=lambda f: f[0])
    return _fit_once(vecs, k, seeds[0], mode)


PARTIAL = "fit int, c int, n long, d2 double"


def _sums(features: DataFrame, f_cols: list[str], fits: dict[int, np.ndarray]) -> list:
    """``fit, c, n, d2, s_0 ...`` of the rows nearest to each centre of each fit: one scan for all fits.

    A task sums up its rows itself, so what is shuffled is a few rows a task and fit.
    """
    dims = len(f_cols)
    names = [c.split()[0] for c in PARTIAL.split(", ")] + [f"s_{i}" for i in range(dims)]

    def run(batches):
        totals: dict = {}
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(dims)])
            for fit, centres in fits.items():
                for lo in range(0, len(x), 4_096):
                    part = x[lo:lo + 4_096]
                    d = distance_matrix(part, centres, "squared")
                    c = d.argmin(axis=1)
                    held = totals.setdefault(fit, np.zeros((len(centres), dims + 2)))
                    held[:, 0] += np.bincount(c, minlength=len(centres))
                    held[:, 1] += np.bincount(c, d[np.arange(len(c)), c], len(centres))
                    for i in range(dims):
                        held[:, 2 + i] += np.bincount(c, part[:, i], len(centres))
        rows = [(fit, c, int(v[0]), *v[1:]) for fit, held in totals.items() for c, v in enumerate(held) if v[0]]
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * (dims + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    partial = features.select(*f_cols).mapInArrow(run, ", ".join([PARTIAL, *[f"s_{i} double" for i in range(dims)]]))
    return partial.groupBy("fit", "c").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect()


def _seeded(features: DataFrame, f_cols: list[str], most: int, seeds: list[int], spread: bool) -> dict[int, list[list[float]]]:
    """``most`` rows to start from for each seed, drawn one after the other; the first k serve k clusters.

    A row is drawn with a chance that grows with its squared distance to those before (k-means++), or evenly; one
    scan draws the next row of every seed.
    """
    chosen: dict[int, list[list[float]]] = {s: [] for s in seeds}
    for i in range(most):
        draws = []
        for s in seeds:
            u = (F.shiftrightunsigned(F.xxhash64(*f_cols, F.lit(s), F.lit(i)), 11) + 0.5) / F.lit(float(1 << 53))
            d2 = nearest_centre(f_cols, chosen[s])["d2"] if chosen[s] else F.lit(1.0)
            # equal rows have equal draws; one that is a start already comes last
            order = F.when(d2 > 0, -F.log(u) / (d2 if spread else F.lit(1.0))).otherwise(F.lit(float("inf")))
            draws.append(F.min(F.struct(order.alias("_o"), *f_cols)).alias(f"r{s}"))
        row = features.agg(*draws).first()
        for s in seeds:
            chosen[s].append([row[f"r{s}"][f] for f in f_cols])
    return chosen


def shared_fits(features: DataFrame, f_cols: list[str], ks: list[int], seeds: list[int], init: str, max_iter: int = MAX_ITER, tol: float = TOL):
    """``(cost, centres, rounds)`` by (k, seed): all fits advance together, one scan a round until the last has settled."""
    starts = _seeded(features, f_cols, max(ks), seeds, _mode(init) != "random")
    row = features.agg(*[F.var_pop(f).alias(f) for f in f_cols]).first()
    limit = tol * sum(row[f] or 0.0 for f in f_cols) / len(f_cols)
    keys = [(k, s) for k in ks for s in seeds]
    centres = {i: np.asarray(starts[s][:k], float) for i, (k, s) in enumerate(keys)}
    rounds, costs, going, closing = dict.fromkeys(centres, 0), {}, dict(centres), {}
    for turn in range(max_iter + 1):
        found = _sums(features, f_cols, going | closing)
        for i in going | closing:
            costs[i] = sum(r["d2"] for r in found if r["fit"] == i)
        if turn == max_iter:
            break
        moved = {i: c.copy() for i, c in going.items()}
        for r in found:
            if r["fit"] in moved:
                moved[r["fit"]][r["c"]] = [r[f"s_{j}"] / r["n"] for j in range(len(f_cols))]
        shift = {i: ((m - going[i]) ** 2).sum() for i, m in moved.items()}
        for i in moved:
            rounds[i] = turn + 1
        centres.update(moved)
        # a settled fit takes part once more if it moved at all, for the cost of where it ended
        going, closing = {i: m for i, m in moved.items() if shift[i] > limit}, {i: m for i, m in moved.items() if 0 < shift[i] <= limit}
        if not going and not closing:
            break
    return {key: (costs[i], centres[i].tolist(), rounds[i]) for i, key in enumerate(keys)}


def inertia_of(features: DataFrame, f_cols: list[str], centres: list[list[float]]) -> float:
    return features.agg(F.sum(nearest_centre(f_cols, centres)["d2"])).first()[0]


def lloyd(features: DataFrame, f_cols: list[str], centres, max_iter: int = MAX_ITER, tol: float = TOL):
    """Lloyd rounds from given centres; each is one map-side combined ``groupBy``.

    The centre shift that stops the rounds is relative to the mean variance of
    the features. A centre that loses all its rows stays where it is.
    """
    centres = [list(map(float, c)) for c in centres]
    if any(len(c) != len(f_cols) for c in centres):
        raise ValueError(f"every start centre needs {len(f_cols)} values")
    limit = 0.0
    if tol > 0:
        row = features.agg(*[F.var_pop(f).alias(f) for f in f_cols]).first()
        limit = tol * sum(row[f] for f in f_cols) / len(f_cols)
    done = 0
    for done in range(1, max_iter + 1):
        rows = (
            features.select(*f_cols, nearest_centre(f_cols, centres)["c"].alias("c"))
            .groupBy("c")
            .agg(*[F.avg(f).alias(f) for f in f_cols])
            .collect()
        )
        moved = [list(c) for c in centres]
        for r in rows:
            moved[r["c"]] = [r[f] for f in f_cols]
        shift = sum((a - b) ** 2 for old, new in zip(centres, moved) for a, b in zip(old, new))
        centres = moved
        if shift <= limit:
            break
    return centres, done


def kmeans(
    df: DataFrame,
    id_col: str,
    cols: list[str] | None = None,
    n_clusters: int = 3,
    random_state: int | None = 42,
    init="k-means++",
    n_init="auto",
    scaler: str | None = "standard",
    cat_encoder: str = "ohe",
    extra_stages: list | None = None,
    max_iter: int = MAX_ITER,
    tol: float = TOL,
    spec: FeatureSpec | None = None,
) -> ClusterResult:
    """Cluster rows around ``n_clusters`` centres.

    ``init`` may be a list of centres in the processed space; the rounds are
    then deterministic and no restart happens. If the features have sparse blocks (one-hot
    columns of many values), such a list holds the ids of the rows to start from.
    """
    _check_k(n_clusters)
    given = not isinstance(init, str)
    if given and len(init) != n_clusters:
        raise ValueError("init must hold n_clusters centres")
    if not given:
        _mode(init), _starts(init, n_init)
    spec = spec or fit_features(df, id_col, cols, scaler, cat_encoder, extra_stages)
    features = spec.transform(df)
    params = {
        "n_clusters": n_clusters, "random_state": random_state,
        "init": init if not given or spec.sparse else [list(map(float, c)) for c in init], "n_init": n_init,
        "max_iter": max_iter, "tol": tol,
    }
    if spec.sparse:
        seed = random.randrange(2**31) if random_state is None else random_state
        labels, found, inertia, n_iter = wide.fit(
            features, id_col, spec.f_cols, len(spec.sparse), n_clusters, init, 1 if given else _starts(init, n_init), seed, max_iter, tol
        )
        return ClusterResult(
            "KMeans", params, spec, df, label_table=labels, inertia=inertia, n_iter=n_iter, wide_centres=found
        )
    if given:
        cached = features.select(*spec.f_cols).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            centres, n_iter = lloyd(cached, spec.f_cols, init, max_iter, tol)
            inertia = inertia_of(cached, spec.f_cols, centres)
        finally:
            cached.unpersist()
    else:
        vecs = vectors(features, spec.f_cols)
        try:
            _, centres, n_iter = best_fit(vecs, n_clusters, random_state, init, n_init)
            inertia = inertia_of(from_vectors(vecs, spec.f_cols), spec.f_cols, centres)
        finally:
            vecs.unpersist()
    return ClusterResult("KMeans", params, spec, df, centres=centres, inertia=inertia, n_iter=n_iter)


def elbow(
    df: DataFrame,
    id_col: str,
    cols: list[str] | None = None,
    k_range=range(2, 11),
    random_state: int | None = 42,
    n_init="auto",
    init: str = "k-means++",
    scaler: str | None = "standard",
    cat_encoder: str = "ohe",
    spec: FeatureSpec | None = None,
) -> DataFrame:
    """``k, inertia`` of the best fit per k; features are prepared and cached once, and all fits share their scans."""
    ks = list(k_range)
    if not ks:
        raise ValueError("k_range is empty")
    for k in ks:
        _check_k(k)
    spec = spec or fit_features(df, id_col, cols, scaler, cat_encoder)
    if spec.sparse:
        seed = random.randrange(2**31) if random_state is None else random_state
        features = table(spec.transform(df))
        costs = [
            (k, wide.fit(features, id_col, spec.f_cols, len(spec.sparse), k, init, _starts(init, n_init), seed, MAX_ITER, TOL)[2]) for k in ks
        ]
        return df.sparkSession.createDataFrame(costs, "k int, inertia double")
    if random_state is None:
        random_state = random.randrange(2**31)
    seeds = [random_state + i for i in range(_starts(init, n_init))]
    features = spec.transform(df).select(*spec.f_cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = shared_fits(features, spec.f_cols, sorted(set(ks)), seeds, init)
    finally:
        features.unpersist()
    best = {k: min(fits[k, s][0] for s in seeds) for k in ks}
    return df.sparkSession.createDataFrame([(k, best[k]) for k in ks], "k int, inertia double")
