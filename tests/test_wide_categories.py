import numpy as np
import pandas as pd
import pytest
from helpers import by_id
from plain import dbscan as plain_dbscan
from plain import linkage as plain_linkage

from spindrift.operators import features as feat
from spindrift.operators.agglomerative import agglomerative
from spindrift.operators.dbscan import dbscan
from spindrift.operators.evaluate import evaluate
from spindrift.operators.kmeans import elbow, kmeans
from spindrift.operators.tables import cluster_profile
from spindrift.sources import store


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 60
    frame = pd.DataFrame({"id": np.arange(n) * 2, "x": rng.normal(0, 1, n).round(3), "c": [f"v{i}" for i in rng.integers(0, 9, n) ** 2 % 7]})
    frame.loc[[3, 7], "c"] = None
    frame.loc[[5], "x"] = None
    return spark.createDataFrame(frame).repartition(3)


def dense(spec, df):
    out = spec.transform(df).toPandas().sort_values("id")
    return out["id"].to_numpy(), out[spec.f_cols].to_numpy()


@pytest.mark.parametrize("scaler", ["standard", "minmax", "robust", "none"])
def test_same_values_as_columns(table, scaler):
    narrow, wide = feat.fit_features(table, "id", scaler=scaler), feat.fit_features(table, "id", scaler=scaler, narrow=2)
    assert wide.sparse == ["c"] and narrow.sparse == [] and wide.n_features == len(narrow.names)
    ids, want = dense(narrow, table)
    got = np.zeros_like(want)
    for r in wide.base_values().collect():
        got[:, r["index"]] = r["value"]
        assert narrow.names[r["index"]] == r["name"]
    at = {i: k for k, i in enumerate(ids)}
    for r in wide.transform_long(table).collect():
        got[at[r["id"]], r["index"]] = r["value"]
    assert np.allclose(got, want)


def test_unknown_values_and_ordinal_codes(spark, table):
    new = spark.createDataFrame([(1, 0.5, "never seen"), (2, 0.5, None), (3, 0.5, "v1")], "id long, x double, c string")
    wide = feat.fit_features(table, "id", narrow=2)
    found = {r["id"]: r["w_0"] for r in wide.transform(new).collect()}
    assert found[1] == -1 and found[2] >= 0
    assert wide.transform_long(new).filter("id = 1").count() == 1
    a = feat.fit_features(table, "id", cat_encoder="ordinal")
    b = feat.fit_features(table, "id", cat_encoder="ordinal", narrow=2)
    assert np.allclose(dense(a, table)[1], dense(b, table)[1])
    assert by_id(feat.encode(new, ["c"], "ordinal", table, narrow=2), "c").tolist() == [-1.0, -1.0, 1.0]
    with pytest.raises(ValueError):
        feat.encode(table, ["c"], "ohe", narrow=2)
    with pytest.raises(ValueError):
        feat.fit_features(table, "id", narrow=2, extra_stages=["a stage"])


def test_kmeans_equals_lloyd_on_columns(table, tmp_path, spark):
    first = [0, 2, 4]
    narrow, wide = feat.fit_features(table, "id"), feat.fit_features(table, "id", narrow=2)
    ids, x = dense(narrow, table)
    start = x[np.searchsorted(ids, first)].tolist()
    a = kmeans(table, "id", n_clusters=3, init=start, max_iter=4, tol=0.0, spec=narrow)
    b = kmeans(table, "id", n_clusters=3, init=first, max_iter=4, tol=0.0, spec=wide)
    assert by_id(a.labels).tolist() == by_id(b.labels).tolist()
    assert b.inertia == pytest.approx(a.inertia)
    ea, eb = (evaluate(r, silhouette="none").first().asDict() for r in (a, b))
    for k in ea:
        assert eb[k] == pytest.approx(ea[k]) if ea[k] is not None else eb[k] is None
    assert by_id(b.predict(table)).tolist() == by_id(b.labels).tolist()
    loaded = store.load_model(spark, store.save_model(b, str(tmp_path)), table)
    assert by_id(loaded.labels).tolist() == by_id(b.labels).tolist()
    assert evaluate(loaded, silhouette="none").first()["calinski_harabasz_score"] == pytest.approx(eb["calinski_harabasz_score"])
    assert cluster_profile(loaded).count() == 3


def test_kmeans_starts(table):
    wide = feat.fit_features(table, "id", narrow=2)
    costs = [kmeans(table, "id", n_clusters=3, init=i, n_init=1 + (i == "random"), spec=wide).inertia for i in ("k-means++", "random")]
    one = elbow(table, "id", k_range=[1, 3], n_init=1, spec=wide).toPandas().set_index("k")["inertia"]
    assert max(costs) < one[1] and one[3] < one[1]
    with pytest.raises(ValueError):
        kmeans(table, "id", n_clusters=2, init=[0, 1], spec=wide)


@pytest.mark.parametrize("scaler,eps,metric", [("standard", 1.0, "euclidean"), ("none", 1.5, "euclidean"), ("none", 2.1, "manhattan")])
def test_dbscan(table, scaler, eps, metric):
    narrow, wide = (feat.fit_features(table, "id", scaler=scaler, narrow=k) for k in (200, 2))
    x = dense(narrow, table)[1]
    gap = x[:, None] - x[None]
    d = np.abs(gap).sum(-1) if metric == "manhattan" else np.sqrt((gap**2).sum(-1))
    got = by_id(dbscan(table, "id", eps=eps, min_samples=3, metric=metric, spec=wide).labels)
    assert got.tolist() == plain_dbscan(d, eps, 3).tolist()
    with pytest.raises(ValueError):
        dbscan(table, "id", metric="cosine", spec=wide)


@pytest.mark.parametrize("linkage", ["ward", "complete", "average", "single"])
def test_agglomerative(table, linkage):
    narrow, wide = feat.fit_features(table, "id"), feat.fit_features(table, "id", narrow=2)
    x = dense(narrow, table)[1]
    want = plain_linkage(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), linkage)
    tree = agglomerative(table, "id", n_clusters=4, linkage=linkage, spec=wide).tree
    got = tree.table().toPandas().sort_values("merge_id")
    assert np.allclose(got["distance"], [w[2] for w in want], atol=1e-9)
