import numpy as np
import pytest
from helpers import by_id, f_cols, frame
from plain import dbscan as plain_dbscan
from plain import distances
from pyspark.sql import functions as F

from spindrift.operators import dbscan as db
from spindrift.operators import dense


@pytest.mark.parametrize("metric,eps,least", [("euclidean", 2.2, 4), ("manhattan", 6.5, 3), ("cosine", 0.25, 4)])
def test_rows_without_shared_cells(spark, monkeypatch, metric, eps, least):
    monkeypatch.setattr(dense, "BLOCK_ROWS", 16)
    called = []
    monkeypatch.setattr(db, "block_components", lambda *a: called.append(1) or dense.block_components(*a))
    rng = np.random.default_rng(11)
    x = rng.permutation(np.vstack([rng.normal(rng.uniform(-2, 2, 12), 0.5, (40, 12)) for _ in range(4)] + [rng.uniform(-3, 3, (30, 12))]))
    got = by_id(db.dbscan_labels(frame(spark, x), "id", f_cols(x), eps, least, metric))
    want = plain_dbscan(distances(x, metric), eps, least)
    assert called and (got == want).all()
    assert len(set(want)) > 2 and (want == -1).any()


def test_rows_exactly_eps_apart_are_near():
    x = np.random.default_rng(1).normal(0, 1, (200, 30))
    eps = float(distances(x)[0, 1])
    assert (dense.near_rows(x, x, eps, "euclidean") == (dense.distance_matrix(x, x, "euclidean") <= eps)).all()


def test_vectors_of_sixty_four_columns_end(spark):
    # cell pairs by boxes took all of the driver's memory here
    x = [F.randn(i).alias(f"f_{i}") for i in range(64)]
    rows = spark.range(3_000).select("id", *x).localCheckpoint()
    got = db.dbscan_labels(rows, "id", [f"f_{i}" for i in range(64)], 0.66, 3, "cosine")
    assert got.count() == 3_000
