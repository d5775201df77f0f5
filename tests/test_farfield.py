import numpy as np
import pytest
from helpers import by_id, f_cols, frame
from plain import distances
from pyspark.sql import functions as F

from spindrift.operators import evaluate as ev
from spindrift.operators import farfield
from spindrift.operators.result import LABEL


@pytest.mark.parametrize("kind", ["blobs", "line", "grid"])
def test_far_rows_count_in_full(spark, monkeypatch, kind):
    monkeypatch.setattr(ev, "DIRECT_ROWS", 100)
    monkeypatch.setattr(farfield, "LEAF_ROWS", 16)
    rng = np.random.default_rng(5)
    x = {
        "blobs": lambda: np.vstack([rng.normal(c, 0.4, (300, 2)) for c in (-2, 0, 3)]),
        "line": lambda: rng.uniform(-3, 3, (700, 1)),
        "grid": lambda: np.round(rng.uniform(-2, 2, (800, 2)), 1) * [1, 10],
    }[kind]()
    label = rng.integers(0, 3, len(x))
    label[0] = 7
    called = []
    before = farfield.label_sums
    monkeypatch.setattr(farfield, "label_sums", lambda *a: called.append(1) or before(*a))
    rows = frame(spark, x).join(spark.createDataFrame(list(enumerate(label.tolist())), f"id long, {LABEL} int"), "id")
    got = ev.silhouette_samples(rows, "id", f_cols(x))
    d = distances(x)
    names = np.unique(label)
    sums = np.stack([d[:, label == c].sum(axis=1) for c in names], axis=1)
    n = np.array([(label == c).sum() for c in names])
    at = np.searchsorted(names, label)
    a = sums[np.arange(len(x)), at] / np.maximum(n[at] - 1, 1)
    mean = sums / n
    mean[np.arange(len(x)), at] = np.inf
    b = mean.min(axis=1)
    s = np.where(n[at] == 1, 0, (b - a) / np.maximum(a, b))
    got = got.cache()
    assert called
    for name, want in (("a", a), ("b", b), ("s", s)):
        np.testing.assert_allclose(by_id(got, name), want, rtol=1e-8, atol=1e-9)


def test_score_of_more_rows_than_pairs_allow(spark):
    # every pair of these would be 1.6e11 distances
    x = F.rand(3) * 4
    rows = spark.range(400_000).select("id", x.alias("f_0"), F.rand(4).alias("f_1"), (F.col("id") % 3).cast("int").alias(LABEL))
    rows = rows.withColumn("f_0", F.col("f_0") + F.col(LABEL) * 10).localCheckpoint()
    score = ev.silhouette_score(rows, "id", ["f_0", "f_1"]).first()[0]
    part = ev.silhouette_score(rows, "id", ["f_0", "f_1"], sample_size=2_000).first()[0]
    assert abs(score - part) < 0.02
