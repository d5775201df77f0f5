import numpy as np
import pytest
from helpers import by_id, f_cols, frame
from plain import dbscan as plain_dbscan
from plain import distances

from spindrift.operators import dbscan as db
from spindrift.plans import skew
from spindrift.plans.components import connected_components

CASES = [("blobs", 2, "euclidean", 0.4, 5), ("crowded", 2, "euclidean", 0.45, 5), ("copies", 3, "manhattan", 0.5, 4),
         ("blobs", 5, "euclidean", 0.7, 4), ("blobs", 3, "cosine", 0.02, 5), ("crowded", 1, "euclidean", 0.3, 10)]


def data(rng, kind, d):
    if kind == "blobs":
        parts = [rng.normal(rng.uniform(-3, 3, d), 0.3, (40, d)) for _ in range(4)] + [rng.uniform(-4, 4, (40, d))]
    elif kind == "copies":
        return np.round(rng.normal(0, 1, (200, d)), 1)
    else:
        parts = [rng.normal(0, 0.05, (120, d)), rng.normal(0.6, 0.05, (120, d)), rng.uniform(-2, 2, (40, d))]
    return rng.permutation(np.vstack(parts))


@pytest.mark.parametrize("kind,d,metric,eps,least", CASES)
def test_labels_match_plain(spark, monkeypatch, kind, d, metric, eps, least):
    x = data(np.random.default_rng(7), kind, d)
    if kind == "crowded":
        for name, value in (("PAIR_ROWS", 50), ("SLOT_ROWS", 20), ("FEW_LOOKS", 10)):
            monkeypatch.setattr(db, name, value)
    if metric == "cosine":
        x[3] = 0
    got = by_id(db.dbscan_labels(frame(spark, x).repartition(3), "id", f_cols(x), eps, least, metric))
    assert (got == plain_dbscan(distances(x, metric), eps, least)).all()


def test_hot_keys_take_the_split_join(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "HOT_SHARE", 10)
    x = np.vstack([np.zeros((60, 2)), data(np.random.default_rng(8), "blobs", 2)[:80]])
    got = by_id(db.dbscan_labels(frame(spark, x), "id", f_cols(x), 0.4, 4))
    assert (got == plain_dbscan(distances(x), 0.4, 4)).all()


def test_border_row_takes_the_lowest_cluster(spark):
    x = np.array([[0.0], [0.1], [0.2], [1.0], [1.8], [1.9], [2.0]])
    got = by_id(db.dbscan_labels(frame(spark, x), "id", ["f_0"], 0.8, 4))
    assert list(got) == list(plain_dbscan(distances(x), 0.8, 4))


def test_pairs_input(spark):
    x = data(np.random.default_rng(9), "blobs", 2)
    d = distances(x)
    i, j = np.triu_indices(len(x), 1)
    pairs = spark.createDataFrame([(int(a), int(b), float(d[a, b])) for a, b in zip(i, j) if d[a, b] < 1], "a long, b long, distance double")
    got = by_id(db.dbscan_pairs(frame(spark, x).select("id"), pairs, 0.4, 5))
    assert (got == plain_dbscan(d, 0.4, 5)).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    got = {r["node"]: r["comp"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_bad_parameters(spark):
    df = frame(spark, np.zeros((3, 1)))
    for args in ((0, 5, "euclidean"), (0.5, 0, "euclidean"), (0.5, 5, "bogus")):
        with pytest.raises(ValueError):
            db.dbscan(df, "id", ["f_0"], *args)
