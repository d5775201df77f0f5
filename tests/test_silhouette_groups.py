import time

import numpy as np
import pytest
from helpers import by_id, f_cols, frame
from plain import distances, silhouette
from pyspark.sql import functions as F

from spindrift.functions.distance import distance_matrix, distance_sums
from spindrift.operators import evaluate as ev


def test_sums_of_distances_are_exact_and_cheap():
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(0, 1, (500, 64)), rng.normal(0, 1e-7, (12, 64))])
    y = np.vstack([x[:5], x[-6:] + 1e-9, rng.normal(0, 1, (390, 64))])
    for shift in (0.0, 1e6):
        d = distance_matrix(x + shift, y + shift, "euclidean")
        for got, want in zip(distance_sums(x + shift, y + shift), (d.sum(axis=1), d.sum(axis=0))):
            assert np.allclose(got, want, rtol=1e-10, atol=0)
    # only copies, and of one row far off all others are near
    assert not np.concatenate(distance_sums(x[:1].repeat(9, 0), x[:1].repeat(7, 0))).any()
    far = np.vstack([x, np.full((1, 64), 1e9)])
    assert np.allclose(distance_sums(far, y)[0], distance_matrix(far, y, "euclidean").sum(axis=1), rtol=1e-10)
    odd = x.copy()
    odd[0, 0], odd[1, 1] = np.nan, np.inf
    assert np.allclose(distance_sums(odd, y)[0], distance_matrix(odd, y, "euclidean").sum(axis=1), equal_nan=True)

    def seconds(f):
        f(), (start := time.perf_counter()), f()
        return time.perf_counter() - start

    big = rng.normal(0, 1, (1024, 64))
    assert 4 * seconds(lambda: distance_sums(big, big)) < seconds(lambda: distance_matrix(big, big, "euclidean"))


@pytest.mark.parametrize("dims,labels,values", [(12, 4, 600), (12, 4, 10**6), (3, 40, 200)])
def test_blocks_meet_in_groups(spark, monkeypatch, dims, labels, values):
    monkeypatch.setattr(ev, "GROUP_VALUES", values)
    monkeypatch.setattr(ev, "block_rows", lambda n: 16)
    rng = np.random.default_rng(6)
    lab = np.append(rng.integers(0, labels, 149), labels)  # the last label has one row
    x = rng.normal(0, 1, (150, dims)) + lab[:, None] * rng.normal(0, 1, dims)
    x[20:40] = x[20]
    df = frame(spark, x).withColumn("cluster_label", F.element_at(F.array(*[F.lit(int(c)) for c in lab]), F.col("id").cast("int") + 1))
    got = by_id(ev.silhouette_samples(df, "id", f_cols(x)).select("id", "s"), "s")
    assert np.allclose(got, silhouette(distances(x), lab), atol=1e-9)
