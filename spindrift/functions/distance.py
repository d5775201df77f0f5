"""Distances: column expressions for joins, array code for block kernels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("euclidean", "manhattan", "cosine")
FEW_COLUMNS = 4  # up to which differences cost no more than a matrix product
STRIP = 128
NEAR_SHARE = 1e-6  # of the squared lengths; beyond, a matrix product keeps nine digits of a distance


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    return metric


# Wide expressions are written as SQL text: building them from column objects
# costs one call into the JVM per operator.


def num(v: float) -> str:
    """A double as an SQL literal."""
    return f"({float(v)!r}D)"


def plus(terms: list[str]) -> str:
    return " + ".join(terms)


def distance(left: list[str], right: list[str], metric: str = "euclidean") -> Column:
    """Distance of two rows given as equally long lists of double column names.

    For cosine both sides must already have unit length (see ``unit_length``);
    half the squared chord equals 1 - cos and is exactly 0 for equal rows.
    """
    if metric == "manhattan":
        return F.expr(plus([f"abs({a} - {b})" for a, b in zip(left, right)]))
    squares = plus([f"({a} - {b}) * ({a} - {b})" for a, b in zip(left, right)])
    return F.expr(f"({squares}) * 0.5D" if metric == "cosine" else f"sqrt({squares})")


def all_zero(names: list[str]) -> Column:
    return F.expr(" AND ".join(f"{c} = 0" for c in names))


def unit_length(df, names: list[str]):
    """Scale each row to length 1; an all-zero row stays all zero."""
    kept = [c for c in df.columns if c not in names]
    length = f"sqrt({plus([f'{c} * {c}' for c in names])})"
    scaled = df.withColumn("_norm", F.expr(f"CASE WHEN {length} = 0 THEN 1D ELSE {length} END"))
    return scaled.select(*kept, *[F.expr(f"{c} / _norm AS {c}") for c in names])


def box_gap(lo_a, hi_a, lo_b, hi_b, metric: str) -> Column:
    """Smallest possible distance between rows of two axis-parallel boxes."""
    gaps = [
        f"greatest({la} - {hb}, {lb} - {ha}, 0D)"
        for la, ha, lb, hb in zip(lo_a, hi_a, lo_b, hi_b)
    ]
    return _length(gaps, metric)


def box_reach(lo_a, hi_a, lo_b, hi_b, metric: str) -> Column:
    """Largest possible distance between rows of two axis-parallel boxes."""
    spans = [
        f"greatest({ha} - {lb}, {hb} - {la})"
        for la, ha, lb, hb in zip(lo_a, hi_a, lo_b, hi_b)
    ]
    return _length(spans, metric)


def _length(parts: list[str], metric: str) -> Column:
    if metric == "manhattan":
        return F.expr(plus(parts))
    return F.expr(f"sqrt({plus([f'{x} * {x}' for x in parts])})")


def distance_matrix(x: np.ndarray, y: np.ndarray, metric: str, blocks: int = 0) -> np.ndarray:
    """All distances between two small blocks of rows, one feature at a time.

    Differences are taken before squaring, so equal rows are exactly 0 apart;
    a matrix product would not give that. The last 2 * ``blocks`` columns are sparse one-hot
    blocks: the number of the category, and what it adds to the block's base values.
    """
    out = np.zeros((len(x), len(y)))
    dense = x.shape[1] - 2 * blocks
    for k in range(dense, x.shape[1], 2):
        differ = x[:, k, None] != y[None, :, k]
        a, b = np.abs(x[:, k + 1, None]), np.abs(y[None, :, k + 1])
        out += np.where(differ, a + b if metric == "manhattan" else a * a + b * b, 0.0)
    for k in range(dense):
        gap = x[:, k, None] - y[None, :, k]
        out += np.abs(gap) if metric == "manhattan" else gap * gap
    # "squared" leaves the squares as they are
    if metric == "euclidean":
        np.sqrt(out, out=out)
    elif metric == "cosine":
        out *= 0.5
        out[~x.any(axis=1), :] = 1.0
        out[:, ~y.any(axis=1)] = 1.0
    return out


def distance_sums(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the Euclidean distances of each row of ``x`` to all of ``y``, and the other way round.

    Distances of many columns come from a matrix product, in strips that stay in a processor's cache. It blurs pairs that
    lie near each other for their length; those are measured by their differences, as ``distance_matrix`` does, so that
    equal rows are exactly 0 apart.
    """
    if x.shape[1] <= FEW_COLUMNS:
        d = distance_matrix(x, y, "euclidean")
        return d.sum(axis=1), d.sum(axis=0)
    centre = x.mean(axis=0)
    a, b = x - centre, y - centre
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    least = NEAR_SHARE * (aa.max() + bb.max())
    a = np.column_stack([-2.0 * a, aa, np.ones(len(a))])
    b = np.column_stack([b, np.ones(len(b)), bb]).T
    to_x, to_y = np.empty(len(x)), np.zeros(len(y))
    strip = np.empty((STRIP, len(y)))
    for lo in range(0, len(x), STRIP):
        part = x[lo : lo + STRIP]
        d = np.matmul(a[lo : lo + STRIP], b, out=strip[: len(part)])
        # so written that NaN and infinite values are among the near ones
        if not d.min() >= least:
            near = np.flatnonzero(~(d >= least))
            if len(near) > d.size / 32:
                d = distance_matrix(part, y, "squared")
            else:
                i, j = np.divmod(near, len(y))
                gap = part[i] - y[j]
                d.ravel()[near] = (gap * gap).sum(axis=1)
        np.sqrt(d, out=d)
        to_x[lo : lo + STRIP] = d.sum(axis=1)
        to_y += d.sum(axis=0)
    return to_x, to_y
