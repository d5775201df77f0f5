import numpy as np
import pandas as pd
import pytest
from helpers import by_id, f_cols, frame
from plain import distances, silhouette
from pyspark.sql import functions as F

from spindrift.operators import diagnostics as diag
from spindrift.operators import evaluate as ev
from spindrift.operators import features as feat
from spindrift.operators import kmeans as km
from spindrift.operators import result as res
from spindrift.operators import tables as tab
from spindrift.operators.models import cluster
from spindrift.plans import blocks
from spindrift.sources import store

rng = np.random.default_rng(3)


def blobs(n=60):
    return np.vstack([rng.normal(c, 0.4, (n, 2)) for c in ((0, 0), (4, 0), (0, 4))])


def raw(spark, x):
    return frame(spark, x).withColumnsRenamed({"f_0": "a", "f_1": "b"})


def test_kmeans_properties_and_store(spark, tmp_path):
    x = blobs()
    df = raw(spark, x)
    r = cluster(df, "KMeans", "id", scaler="none", n_init=2)
    lab, centres = by_id(r.labels), np.array(r.centres)
    d = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(-1))
    assert (d.argmin(1) == lab).all()
    assert np.allclose(centres, [x[lab == c].mean(0) for c in range(3)], atol=1e-6)
    assert r.inertia == pytest.approx((d.min(1) ** 2).sum())
    path = store.save_model(r, str(tmp_path))
    back = store.load_model(spark, path, df)
    assert (by_id(back.labels) == lab).all() and back.inertia == r.inertia
    assert (by_id(back.predict(df)) == lab).all()
    assert store.list_models(spark, str(tmp_path), "KMeans").count() == 1
    assert store.list_models(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        cluster(df, "Bogus", "id")


def test_array_kernel_gives_the_same_labels(spark, monkeypatch):
    x = blobs()
    r = km.kmeans(raw(spark, x), "id", init=[[0, 0], [1, 0], [0, 1]], tol=0.0, max_iter=3)
    lab = by_id(r.labels)
    monkeypatch.setattr(res, "EXPRESSION_TERMS", 0)
    assert (by_id(r.assign_features(r.features)) == lab).all()


def test_elbow(spark):
    df = raw(spark, blobs())
    out = km.elbow(df, "id", k_range=range(1, 5)).toPandas().sort_values("k")
    assert list(out.k) == [1, 2, 3, 4] and out.inertia.iloc[2] < 0.2 * out.inertia.iloc[0]
    for bad in ([], [0]):
        with pytest.raises(ValueError):
            km.elbow(df, "id", k_range=bad)


@pytest.mark.parametrize("clusters", [3, 9])
def test_silhouette_matches_plain(spark, monkeypatch, clusters):
    monkeypatch.setattr(ev, "block_rows", lambda n: 16)
    x = blobs(40)
    lab = rng.integers(0, clusters, len(x))
    lab[5] = 99
    df = frame(spark, x).join(spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "cluster_label": lab.astype("int32")})), "id")
    got = by_id(ev.silhouette_samples(df, "id", f_cols(x)), "s")
    assert np.allclose(got, silhouette(distances(x), lab))


def test_wanted_labels_in_chunks(spark, monkeypatch):
    x = blobs(20)
    lab = np.repeat([0, 1, 2], 20).astype("int32")
    df = frame(spark, x).join(spark.createDataFrame(pd.DataFrame({"id": np.arange(60), "cluster_label": lab})), "id")
    want = by_id(ev.silhouette_samples(df, "id", f_cols(x)), "s")
    monkeypatch.setattr(ev, "CENTRE_VALUES", 2)
    monkeypatch.setattr(ev, "CHUNK_SALTS", 3)
    assert np.allclose(by_id(ev.silhouette_samples(df, "id", f_cols(x)), "s"), want)


def test_scores_are_null_for_one_cluster_and_noise_is_kept_out(spark):
    x = blobs(10)
    df = raw(spark, x)
    spec = feat.fit_features(df, "id")
    one = res.given_labels(df, spec, df.select("id", F.lit(0).alias("cluster_label")))
    row = ev.evaluate(one).first()
    assert row["silhouette_score"] is None and row["calinski_harabasz_score"] is None and row["davies_bouldin_score"] is None
    noisy = res.given_labels(df, spec, df.selectExpr("id", "CASE WHEN id < 5 THEN -1 ELSE CAST(id % 2 AS INT) END AS cluster_label"))
    row = ev.evaluate(noisy, silhouette="squared").first()
    assert row["n_samples"] == 30 and row["noise_count"] == 5 and row["n_clusters_found"] == 2
    assert row["silhouette_score"] is None and row["silhouette_sq"] is not None
    assert set(tab.cluster_profile(noisy).toPandas().cluster_label) == {-1, 0, 1}
    assert set(tab.cluster_profile(noisy, ignore_noise=True).toPandas().cluster_label) == {0, 1}


@pytest.mark.parametrize("kind,metric", [("spread", "euclidean"), ("copies", "manhattan"), ("copies", "cosine")])
def test_kth_neighbour(spark, monkeypatch, metric, kind):
    monkeypatch.setattr(blocks, "block_rows", lambda n, at_least=0: max(at_least, 16))
    x = rng.normal(0, 1, (300, 3))
    if kind == "copies":
        x[:100] = x[0]
    d = distances(x, metric)
    np.fill_diagonal(d, np.inf)
    got = by_id(diag.kth_neighbour(frame(spark, x), "id", f_cols(x), 4, metric), "k_distance")
    assert np.allclose(got, np.sort(d, axis=1)[:, 3], atol=1e-12)


def test_k_distance_errors(spark):
    x = np.ones((4, 2))
    df = frame(spark, x)
    for k in (0, 4):
        with pytest.raises(ValueError):
            diag.k_distance(df, "id", ["f_0", "f_1"], k)
    with pytest.raises(ValueError):
        diag.k_distance(df, "id", ["f_0", "f_1"], 1)


def test_pca_matches_svd(spark):
    x = rng.normal(0, 1, (80, 3)) @ np.diag([3.0, 1.0, 0.2])
    df = frame(spark, x).withColumnsRenamed({f"f_{i}": c for i, c in enumerate("abc")})
    r = res.given_labels(df, feat.fit_features(df, "id", scaler="none"), df.select("id", F.lit(0).alias("cluster_label")))
    got = diag.pca_projection(r, 2).toPandas().sort_values("id")[["pc1", "pc2"]].to_numpy()
    c = x - x.mean(0)
    _, _, v = np.linalg.svd(c, full_matrices=False)
    v = np.array([w if w[np.abs(w).argmax()] > 0 else -w for w in v[:2]])
    assert np.allclose(got, c @ v.T)
    for bad in (1, 4):
        with pytest.raises(ValueError):
            diag.pca_projection(r, bad)
    for fx, fy in (("a", "a"), ("a", "zzz")):
        with pytest.raises(ValueError):
            diag.scatter_data(r, fx, fy)
