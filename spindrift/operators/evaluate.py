"""Scores of a labelled table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.distance import distance, distance_matrix, distance_sums, plus
from ..plans.blocks import block_rows, join_blocks, matrix, pack
from ..plans.cut import cut
from ..plans.skew import attach
from . import farfield, wide
from .result import LABEL, NOISE, ClusterResult

CENTRE_VALUES = 1_000_000  # numbers in one chunk of the centre table
CHUNK_SALTS = 64
GROUP_VALUES = 4_000_000  # numbers of a group of blocks, two of which a task holds
GROUP_ROWS, LEAST_GROUPS = 2_048, 16  # groups there are at least, up to 16 of them: one for so many rows
MOST_TASKS = 4_096
MANY_BLOCKS = 4_096  # beyond, blocks of under 64 rows meet pair by pair
DIRECT_ROWS = 20_000  # rows up to which every pair is measured, whatever the columns


def noise_summary(labels: DataFrame) -> DataFrame:
    n, noise = F.count(F.lit(1)), F.count_if(F.col(LABEL) == NOISE)
    return labels.agg(
        noise.alias("noise_count"),
        F.when(n == 0, 0.0).otherwise(noise / n).alias("noise_ratio"),
    )


def n_clusters_found(labels: DataFrame) -> DataFrame:
    # two steps: a global count_distinct would expand every row
    return (
        labels.filter(F.col(LABEL) != NOISE)
        .groupBy(LABEL)
        .agg(F.lit(1).alias("_one"))
        .agg(F.count(F.lit(1)).alias("n_clusters_found"))
    )


def metric_rows(labelled: DataFrame, ignore_noise: bool = True) -> DataFrame:
    return labelled.filter(F.col(LABEL) != NOISE) if ignore_noise else labelled


def cluster_stats(rows: DataFrame, f_cols: list[str]) -> DataFrame:
    """Per label: n, centre ``c_*`` and mean squared distance to it, one pass."""
    return rows.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"avg({f}) AS c_{i}") for i, f in enumerate(f_cols)],
        F.expr(plus([f"var_pop({f})" for f in f_cols])).alias("spread"),
    )


def silhouette_samples(
    rows: DataFrame, id_col: str, f_cols: list[str], stats: DataFrame | None = None
) -> DataFrame:
    """Exact Euclidean silhouette: ``id, cluster_label, a, b, s``.

    Rows are packed by label into blocks of bounded size, which meet group
    by group; one partial sum per row and label leaves the kernel. A label is
    skipped for a whole block when no row of it can have it as second-nearest:
    by convexity the mean distance to a cluster lies between the distance to
    its centre and the root of that squared plus the cluster's spread.

    Many rows of one or two columns and few labels don't need all pairs: the sums over
    rows that lie far away follow from their places (``farfield``).
    """
    stats = cut(cluster_stats(rows, f_cols)) if stats is None else stats
    sizes = stats.select(LABEL, "n")
    totals = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    n, k = totals[0] or 0, totals[1]
    if n > DIRECT_ROWS and len(f_cols) <= farfield.MOST_COLUMNS and 2 <= k <= farfield.MOST_LABELS:
        return _by_sums(rows, id_col, f_cols, {r[LABEL]: r["n"] for r in sizes.collect()})
    per = block_rows(n)
    slots = sizes.withColumn("slots", F.ceil(F.col("n") / F.lit(per)).cast("long"))
    placed = attach(rows.select(id_col, LABEL, *f_cols), slots, [LABEL], "n", small_rows=k).withColumn(
        "slot", F.pmod(F.xxhash64(id_col), F.col("slots"))
    )
    packed = cut(pack(placed, [LABEL, "slot"], id_col, f_cols))
    dims = len(f_cols)
    wanted = _wanted_labels(packed, stats, dims, k)
    n_blocks = slots.agg(F.sum("slots")).first()[0] or 0
    id_type = rows.schema[id_col].dataType.simpleString()
    if n_blocks <= MANY_BLOCKS or n_blocks * 64 <= n:
        groups = max(min(LEAST_GROUPS, -(-n // GROUP_ROWS)), -(-n * dims // GROUP_VALUES), 1)
        parts = _sums_by_groups(packed, wanted, dims, groups, id_type)
    else:
        parts = _sums_by_blocks(packed, wanted, slots, k, dims, id_type)
    per_label = parts.groupBy("id", "to").agg(F.sum("d").alias("d"))
    own = rows.select(F.col(id_col).alias("id"), LABEL)
    means = per_label.join(own, "id")
    to_sizes = sizes.select(F.col(LABEL).alias("to"), F.col("n").alias("m"))
    means = means.join(F.broadcast(to_sizes) if k <= 50_000 else to_sizes, "to")
    same = F.col("to") == F.col(LABEL)
    per_row = means.groupBy("id", LABEL).agg(
        F.max(F.when(same, F.when(F.col("m") > 1, F.col("d") / (F.col("m") - 1)).otherwise(0.0))).alias("a"),
        F.min(F.when(~same, F.col("d") / F.col("m"))).alias("b"),
        F.max(F.when(same, F.col("m"))).alias("_own"),
    )
    wider = F.greatest("a", "b")
    s = F.when((F.col("_own") == 1) | (wider == 0.0), 0.0).otherwise((F.col("b") - F.col("a")) / wider)
    return per_row.select(F.col("id").alias(id_col), LABEL, "a", "b", s.alias("s"))


def _sums_by_groups(packed: DataFrame, wanted: DataFrame, dims: int, groups: int, id_type: str) -> DataFrame:
    """``id, to, d``: the sum of each row's distances to the rows of each wanted label.

    Blocks are dealt over groups and each two groups meet in a task, so a row travels once a group and not once a
    pair of blocks. A pair of blocks is measured once for both its sides; a block's sums of a label leave as one array.
    """
    asked = wanted.groupBy(LABEL, "slot").agg(F.collect_set("to").alias("want"))
    group = F.pmod(F.xxhash64(LABEL, "slot"), F.lit(groups))
    blocks = packed.drop("ids").join(asked, [LABEL, "slot"]).withColumn("_g", group)
    every = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))
    dealt = blocks.withColumn("_h", F.explode(every)).select(
        F.least("_g", "_h").alias("ga"), F.greatest("_g", "_h").alias("gb"), "_g", LABEL, "slot", "x", "want"
    )

    def meet(key, table):
        t = table.combine_chunks()
        group, label, slot, want = (t.column(c).to_pylist() for c in ("_g", LABEL, "slot", "want"))
        x = [matrix(row.values.to_numpy(zero_copy_only=False), dims) for row in t.column("x")]
        ga, gb = (k.as_py() for k in key)
        want, one, two = [set(w) for w in want], {}, {}
        for i, g in enumerate(group):
            for side, of in ((ga, one), (gb, two)):
                if g == side:
                    of.setdefault(label[i], []).append(i)
        met = {(i, j) for c in one for i in one[c] for to in want[i] & two.keys() for j in two[to]}
        met |= {(i, j) for c in two for j in two[c] for to in want[j] & one.keys() for i in one[to]}
        if ga == gb:
            met = {(min(p), max(p)) for p in met}
        sums = {}
        for i, j in sorted(met):
            of_i, of_j = distance_sums(x[i], x[j])
            if label[j] in want[i]:
                sums[i, label[j]] = sums.get((i, label[j]), 0.0) + of_i
            if i != j and label[i] in want[j]:
                sums[j, label[i]] = sums.get((j, label[i]), 0.0) + of_j
        return pa.table({
            LABEL: pa.array([label[i] for i, _ in sums], pa.int32()), "slot": pa.array([slot[i] for i, _ in sums], pa.int64()),
            "to": pa.array([to for _, to in sums], pa.int32()), "d": pa.array(list(sums.values()), pa.list_(pa.float64())),
        })

    tasks = min(groups * (groups + 1) // 2, MOST_TASKS)
    met = dealt.repartition(tasks, "ga", "gb").groupBy("ga", "gb").applyInArrow(
        meet, f"{LABEL} int, slot long, to int, d array<double>"
    )
    summed = met.groupBy(LABEL, "slot", "to").agg(F.collect_list("d").alias("d"))
    with_ids = summed.join(packed.select(LABEL, "slot", "ids"), [LABEL, "slot"]).select("to", "ids", "d")

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for to, ids, d in zip(frame["to"], frame["ids"], frame["d"]):
                yield pd.DataFrame({"id": ids, "to": to, "d": np.sum(np.stack(d), axis=0)})

    return with_ids.mapInPandas(add, f"id {id_type}, to int, d double")


def _sums_by_blocks(packed: DataFrame, wanted: DataFrame, slots: DataFrame, k: int, dims: int, id_type: str) -> DataFrame:
    """As ``_sums_by_groups``, in parts, for very many labels of few rows: only blocks that are wanted travel."""
    data = packed.select(F.struct(LABEL, "slot").alias("block"), "ids", "x")
    targets = slots.select(F.col(LABEL).alias("to"), "slots")
    wanted = wanted.join(F.broadcast(targets) if k <= 50_000 else targets, "to")
    pairs = wanted.select(
        F.struct(LABEL, "slot").alias("a"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("_to"),
        "to",
    ).select("a", F.struct(F.col("to").alias(LABEL), F.col("_to").alias("slot")).alias("b"))

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b, ids_a, x_a, x_b in zip(frame["b"], frame["ids_a"], frame["x_a"], frame["x_b"]):
                d = distance_matrix(matrix(x_a, dims), matrix(x_b, dims), "euclidean")
                yield pd.DataFrame({"id": ids_a, "to": b[LABEL], "d": d.sum(axis=1)})

    joined = join_blocks(pairs, data, data.drop("ids")).select("b", "ids_a", "x_a", "x_b")
    return joined.mapInPandas(sums, f"id {id_type}, to int, d double")


def _by_sums(rows: DataFrame, id_col: str, f_cols: list[str], sizes: dict[int, int]) -> DataFrame:
    """``silhouette_samples`` from the sums of distances to all rows of each label; ``sizes`` has few labels."""
    labels = sorted(sizes)
    n, k = np.array([sizes[c] for c in labels], float), len(labels)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, own, parts in zip(frame["ids"], frame[LABEL], frame["sums"]):
                total = sum(matrix(p, k) for p in parts)
                at, every = np.searchsorted(labels, own), np.arange(len(ids))
                a = total[every, at] / np.maximum(n[at] - 1, 1)
                mean = total / n
                mean[every, at] = np.inf
                b = mean.min(axis=1)
                wider = np.maximum(a, b)
                s = np.where((n[at] == 1) | (wider == 0), 0.0, (b - a) / np.where(wider == 0, 1.0, wider))
                yield pd.DataFrame({id_col: ids, LABEL: own, "a": a, "b": b, "s": s})

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (id_col, LABEL)]
    found = farfield.label_sums(rows, id_col, f_cols, labels)
    return found.mapInPandas(score, ", ".join([*kinds, "a double", "b double", "s double"]))


def _wanted_labels(packed: DataFrame, stats: DataFrame, dims: int, k: int) -> DataFrame:
    """For each block the labels that can matter to at least one of its rows.

    The centres are cut into chunks of bounded size; every block meets every
    chunk, on a salted key, and the tightest bound a block gets from any chunk
    thins out the labels kept from the others.
    """
    chunks = max(1, -(-k * dims // CENTRE_VALUES))
    table = pack(
        stats.withColumn("chunk", F.pmod(F.xxhash64(LABEL), F.lit(chunks))),
        "chunk", LABEL, [f"c_{i}" for i in range(dims)], ["spread"],
    ).select("chunk", F.col("ids").alias("names"), F.col("x").alias("centres"), F.col("spread").alias("spreads"))
    blocks = packed.select(LABEL, "slot", "x")
    if chunks == 1:
        met = blocks.crossJoin(F.broadcast(table))  # one row on the right side
    else:
        salts = F.sequence(F.lit(0), F.lit(CHUNK_SALTS - 1))
        met = blocks.withColumn("salt", F.pmod(F.hash(LABEL, "slot"), F.lit(CHUNK_SALTS))).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
        )
        met = met.join(table.withColumn("salt", F.explode(salts)), ["chunk", "salt"])

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                names, spread = np.asarray(row.names), np.asarray(row.spreads)
                low = distance_matrix(matrix(row.x, dims), matrix(row.centres, dims), "euclidean")
                high = np.sqrt(low * low + spread)
                other = names != row.cluster_label
                high[:, ~other] = np.inf
                keep = ~other | (low * (1 - 1e-9) <= high.min(axis=1)[:, None]).any(axis=0)
                yield pd.DataFrame(
                    {LABEL: row.cluster_label, "slot": row.slot, "to": names[keep],
                     "low": np.where(other, low.min(axis=0), 0.0)[keep], "cap": high.max(axis=0).min()}
                )

    found = met.select(LABEL, "slot", "x", "names", "centres", "spreads").mapInPandas(
        pick, f"{LABEL} int, slot long, to int, low double, cap double"
    )
    if chunks == 1:
        return found.select(LABEL, "slot", "to")
    found = cut(found)
    caps = found.groupBy(LABEL, "slot").agg(F.min("cap").alias("_cap"))
    return found.join(caps, [LABEL, "slot"]).filter(F.col("low") * (1 - 1e-9) <= F.col("_cap")).select(LABEL, "slot", "to")


def hash_sample(rows: DataFrame, id_col: str, size: int, random_state: int = 0) -> DataFrame:
    """The ``size`` rows whose id has the smallest md5 with the seed: tasks keep so many each, and the best of those remain."""
    if not isinstance(size, int) or size < 2:
        raise ValueError("sample_size must be a whole number of at least 2")
    draw = F.md5(F.concat_ws(":", F.lit(str(random_state)), F.col(id_col).cast("string")))
    return rows.orderBy(draw, id_col).limit(size)


def silhouette_score(
    rows: DataFrame, id_col: str, f_cols: list[str], stats=None, sample_size: int | None = None, random_state: int = 0
) -> DataFrame:
    """Mean silhouette; with ``sample_size`` that of a sample among itself, null if it holds less than two labels or no two rows of one."""
    if sample_size is None:
        return silhouette_samples(rows, id_col, f_cols, stats).agg(F.avg("s").alias("silhouette_score"))
    drawn = cut(hash_sample(rows, id_col, sample_size, random_state))
    seen = drawn.agg(F.count_distinct(LABEL).alias("k"), F.count(F.lit(1)).alias("n")).first()
    if not 2 <= seen["k"] < seen["n"]:
        return rows.sparkSession.range(1).select(F.lit(None).cast("double").alias("silhouette_score"))
    return silhouette_samples(drawn, id_col, f_cols).agg(F.avg("s").alias("silhouette_score"))


def silhouette_sq(rows: DataFrame, f_cols: list[str]) -> float:
    """Linear-cost silhouette over *squared* Euclidean distances (another measure)."""
    ready = rows.select(array_to_vector(F.array(*f_cols)).alias("features"), F.col(LABEL).alias("prediction"))
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(ready)


def calinski_harabasz(stats: DataFrame, dims: int) -> DataFrame:
    """From per-label statistics alone; null unless 2 <= labels < rows."""
    n = F.sum("n")
    totals = stats.agg(
        n.alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("spread") * F.col("n")).alias("within"),
        *[F.expr(f"sum(c_{i} * n) / sum(n) AS m_{i}") for i in range(dims)],
    )
    gap = F.expr(plus([f"(c_{i} - m_{i}) * (c_{i} - m_{i})" for i in range(dims)]))
    # one row on the right side
    between = stats.crossJoin(F.broadcast(totals.drop("n", "k", "within"))).agg(
        F.sum(gap * F.col("n")).alias("between")
    )
    both = totals.select("n", "k", "within").crossJoin(F.broadcast(between))
    score = F.when(F.col("within") == 0.0, 1.0).otherwise(
        F.col("between") * (F.col("n") - F.col("k")) / (F.col("within") * (F.col("k") - 1))
    )
    return both.select(F.when((F.col("k") >= 2) & (F.col("n") > F.col("k")), score).alias("calinski_harabasz_score"))


def davies_bouldin(rows: DataFrame, f_cols: list[str], stats: DataFrame) -> DataFrame:
    """Mean over clusters of the worst (S_i + S_j) / d_ij."""
    dims = len(f_cols)
    c_cols = [f"c_{i}" for i in range(dims)]
    k = stats.count()
    near = attach(rows.select(LABEL, *f_cols), stats.select(LABEL, "n", *c_cols), [LABEL], "n", small_rows=k)
    own = distance(f_cols, c_cols)
    radius = near.groupBy(LABEL).agg(F.avg(own).alias("r"))
    clusters = stats.select(LABEL, *c_cols).join(radius, LABEL).withColumn(
        "block", F.pmod(F.xxhash64(LABEL), F.lit(max(1, -(-k // 512))))
    )
    packed = cut(pack(clusters, "block", LABEL, c_cols, ["r"]))
    blocks = packed.select("block")
    n_blocks = max(1, -(-k // 512))
    pairs = blocks.select(
        F.col("block").alias("a"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("b"),
    )

    def worst(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a, b, ids, xa, xb, ra, rb in zip(
                f["a"], f["b"], f["ids_a"], f["x_a"], f["x_b"], f["r_a"], f["r_b"]
            ):
                d = distance_matrix(matrix(xa, dims), matrix(xb, dims), "euclidean")
                score = np.where(d > 0, (np.add.outer(ra, rb)) / np.where(d > 0, d, 1.0), 0.0)
                yield pd.DataFrame({"id": ids, "worst": score.max(axis=1)})

    joined = join_blocks(pairs, packed, packed.drop("ids"))
    scored = joined.mapInPandas(worst, "id int, worst double")
    per_cluster = scored.groupBy("id").agg(F.max("worst").alias("worst"))
    guard = (F.count(F.lit(1)) >= 2)
    return per_cluster.agg(F.when(guard, F.avg("worst")).alias("davies_bouldin_score"))


SILHOUETTES = ("exact", "squared", "none")


def evaluate(
    result: ClusterResult, ignore_noise: bool = True, silhouette: str = "exact", sample_size: int | None = None, random_state: int = 0
) -> DataFrame:
    """One row with counts and scores.

    ``silhouette="exact"`` compares every row with every row that can matter; it
    is null for features with sparse blocks. ``"none"`` leaves the score null and ``"squared"`` reports the linear-cost
    measure in a column of its own, ``silhouette_sq``. ``sample_size`` limits the exact
    silhouette to so many rows, drawn by a hash of the id and ``random_state``.
    """
    if silhouette not in SILHOUETTES:
        raise ValueError(f"silhouette must be one of {SILHOUETTES}")
    f_cols, id_col = result.f_cols, result.id_col
    labelled = cut(result.labelled_features)
    rows = metric_rows(labelled, ignore_noise)
    blocks = len(result.spec.sparse)
    # one-hot blocks alone leave no dense feature
    stats = cut(cluster_stats(rows, f_cols or ["0D"]))
    counts = labelled.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(F.col(LABEL) == NOISE).alias("noise_count"),
    )
    seen = stats.agg(
        F.count(F.lit(1)).alias("_k"), F.sum("n").alias("_m"),
        F.count_if(F.col(LABEL) != NOISE).alias("n_clusters_found"),
    ).first()
    n_scored, k = seen["_m"] or 0, seen["_k"]
    null = F.lit(None).cast("double")
    one = counts.select(
        "n_samples",
        F.lit(result.spec.n_original).cast("long").alias("n_original_features"),
        F.lit(result.spec.n_features).cast("long").alias("n_features_after_transform"),
        F.lit(seen["n_clusters_found"]).cast("long").alias("n_clusters_found"),
        "noise_count",
        F.when(F.col("n_samples") == 0, 0.0).otherwise(F.col("noise_count") / F.col("n_samples")).alias("noise_ratio"),
    )
    names = ["silhouette_score", "calinski_harabasz_score", "davies_bouldin_score"]
    if blocks:
        found = wide.scores(rows, f_cols, blocks, LABEL)
        one = one.select("*", null.alias(names[0]), *[F.lit(v).cast("double").alias(c) for v, c in zip(found, names[1:])])
    elif n_scored >= 2 and k >= 2 and n_scored > k:
        if silhouette == "exact":
            one = one.crossJoin(F.broadcast(silhouette_score(rows, id_col, f_cols, stats, sample_size, random_state)))
        else:
            one = one.withColumn("silhouette_score", null)
        one = one.crossJoin(F.broadcast(calinski_harabasz(stats, len(f_cols))))
        one = one.crossJoin(F.broadcast(davies_bouldin(rows, f_cols, stats)))
        if silhouette == "squared":
            one = one.withColumn("silhouette_sq", F.lit(silhouette_sq(rows, f_cols)))
    else:
        one = one.select("*", *[null.alias(c) for c in names])
    extra = ["silhouette_sq"] if "silhouette_sq" in one.columns else []
    return one.select(
        "n_samples", "n_original_features", "n_features_after_transform", "n_clusters_found",
        "noise_count", "noise_ratio", *names,
        F.lit(result.inertia).cast("double").alias("inertia"),
        F.lit(result.centres is not None or result.wide_centres is not None).alias("has_cluster_centers"),
        *extra,
    )


def summary(result: ClusterResult, ignore_noise: bool = True, silhouette: str = "exact") -> DataFrame:
    """The evaluation with the model's name, task and scaler in front."""
    record = evaluate(result, ignore_noise, silhouette)
    return record.select(
        F.lit(result.model).alias("model"),
        F.lit("clustering").alias("task"),
        F.lit(result.spec.scaler).alias("scaler"),
        F.lit(result.spec.n_features).cast("long").alias("feature_names_len"),
        "*",
    )
