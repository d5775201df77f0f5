"""Exact interpolated quantiles of many columns in a few scans."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECT_ROWS = 1_000_000
SKETCH = 4_000  # size of an approximate sketch; its ranks are off by about 0.1 %
ACCURACY = 50_000


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float], counts: dict | None = None, size: int = SKETCH) -> dict[str, list[float | None]]:
    """Values of about the wanted ranks, null values skipped, from one scan whatever the number of columns.

    Each column is a KLL sketch of bounded size that tasks build and Spark merges. Nothing is
    interpolated, so a result is always a value of the column; None for a column of nulls.
    """
    if not cols:
        return {}
    sketches = df.agg(
        *[F.kll_sketch_agg_double(F.col(c), F.lit(size)).alias(f"s{i}") for i, c in enumerate(cols)],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
    )
    values = [
        F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(float(p)))).alias(f"q{i}_{j}")
        for i in range(len(cols)) for j, p in enumerate(probs)
    ]
    row = sketches.select(*values).first()
    return {c: [row[f"q{i}_{j}"] for j in range(len(probs))] for i, c in enumerate(cols)}


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    counts: dict[str, int] | None = None,
    direct_rows: int = DIRECT_ROWS,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles, null values skipped.

    ``percentile`` keeps every distinct value of a column in one aggregation
    buffer, so it is used only while a column has at most ``direct_rows``
    values. Beyond that a sketch brackets each wanted order statistic, the
    rows below and inside the bracket are counted, and the exact value is then
    taken from the few rows inside. The bracket is narrowed again until it is
    small, so no buffer grows with the table.
    """
    if not cols:
        return {}
    if counts is None:
        row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)]).first()
        counts = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    direct = [c for c in cols if 0 < counts[c] <= direct_rows]
    if direct:
        arr = ", ".join(f"{float(p)!r}D" for p in probs)
        row = df.agg(
            *[F.expr(f"percentile(`{c}`, array({arr})) AS q{i}") for i, c in enumerate(direct)]
        ).first()
        for i, c in enumerate(direct):
            out[c] = list(row[f"q{i}"])
    large = [c for c in cols if counts[c] > direct_rows]
    if large:
        ranks = {
            c: sorted({r for p in probs for r in _ranks(p, counts[c])}) for c in large
        }
        stats = _order_statistics(df, ranks, counts, direct_rows, accuracy)
        for c in large:
            for j, p in enumerate(probs):
                lo, hi = _ranks(p, counts[c])
                w = p * (counts[c] - 1) - lo
                a, b = stats[c, lo], stats[c, hi]
                out[c][j] = a if w == 0 else a + (b - a) * w
    return out


def _ranks(p: float, n: int) -> tuple[int, int]:
    at = p * (n - 1)
    return math.floor(at), math.ceil(at)


def _order_statistics(df, ranks, counts, direct_rows, accuracy):
    """Values at given 0-based ranks, by ever narrower open intervals."""
    todo = {(c, r): None for c, rs in ranks.items() for r in rs}
    found: dict[tuple[str, int], float] = {}
    while todo:
        keys = list(todo)
        aggs = []
        for i, (c, r) in enumerate(keys):
            if todo[c, r] is None:
                values, at, n = F.col(c), r, counts[c]
            else:
                lo, hi, below, n = todo[c, r]
                values, at = F.when((F.col(c) > lo) & (F.col(c) < hi), F.col(c)), r - below
            ps = [min(1.0, max(0.0, at / n + s * 2.0 / accuracy)) for s in (-1, 1)]
            aggs.append(F.percentile_approx(values, ps, accuracy).alias(f"b{i}"))
        row = df.agg(*aggs).first()
        edges = {k: row[f"b{i}"] for i, k in enumerate(keys)}
        aggs = []
        for i, (c, r) in enumerate(keys):
            lo, hi = edges[c, r]
            aggs += [
                F.count_if(F.col(c) < lo).alias(f"u{i}"),
                F.count_if(F.col(c) <= lo).alias(f"v{i}"),
                F.count_if(F.col(c) < hi).alias(f"w{i}"),
                F.count_if(F.col(c) <= hi).alias(f"x{i}"),
            ]
        row = df.agg(*aggs).first()
        final = []
        for i, (c, r) in enumerate(keys):
            lo, hi = edges[c, r]
            below_lo, to_lo, below_hi, to_hi = (row[f"{k}{i}"] for k in "uvwx")
            if not below_lo <= r < to_hi:
                raise RuntimeError(f"quantile sketch of {c!r} broke its error bound")
            inside = below_hi - to_lo
            if r < to_lo:
                found[c, r] = float(lo)
            elif r >= below_hi:
                found[c, r] = float(hi)
            elif inside <= direct_rows:
                final.append((c, r, lo, hi, (r - to_lo + 0.5) / inside))
            else:
                # both ends are known not to be the answer, so each turn
                # leaves fewer distinct values
                todo[c, r] = (lo, hi, to_lo, inside)
                continue
            del todo[c, r]
        if final:
            row = df.agg(
                *[
                    F.expr(
                        f"percentile_disc({p!r}D) WITHIN GROUP (ORDER BY "
                        f"CASE WHEN `{c}` > {lo!r}D AND `{c}` < {hi!r}D THEN `{c}` END)"
                    ).alias(f"x{i}")
                    for i, (c, _, lo, hi, p) in enumerate(final)
                ]
            ).first()
            for i, (c, r, *_) in enumerate(final):
                found[c, r] = float(row[f"x{i}"])
    return found
