import numpy as np
import pytest
from helpers import by_id, f_cols, frame
from plain import dbscan as plain_dbscan
from plain import distances
from pyspark.ml.feature import PCA

from spindrift.functions.quantiles import approx_quantiles
from spindrift.operators import dbscan as db
from spindrift.operators import features as feat
from spindrift.operators import kmeans as km
from spindrift.operators.evaluate import evaluate, silhouette_samples, silhouette_score
from spindrift.operators.result import LABEL
from spindrift.sources import store


def test_shared_fits_equal_lloyd(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.3, (30, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    df = frame(spark, x).repartition(3)
    cols = f_cols(x)
    fits = km.shared_fits(df, cols, [1, 3, 4], [7, 8], "k-means++", tol=0.0)
    assert fits[1, 7][0] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    within = sum(((p - p.mean(0)) ** 2).sum() for p in np.split(x, 3))
    assert min(fits[3, s][0] for s in (7, 8)) == pytest.approx(within)
    for (k, _), (cost, centres, _) in fits.items():
        again, _ = km.lloyd(df, cols, centres, 1, 0.0)
        assert np.allclose(again, centres) and len(centres) == k
        assert km.inertia_of(df, cols, centres) == pytest.approx(cost)


def test_fewer_rows_than_clusters_and_copies(spark):
    df = frame(spark, np.ones((5, 2)))
    cost, centres, _ = km.shared_fits(df, ["f_0", "f_1"], [3], [1], "random")[3, 1]
    assert cost == 0 and np.allclose(centres, 1)


def test_approximate_quantiles(spark):
    x = np.random.default_rng(1).permutation(50_000).astype(float)
    df = spark.createDataFrame([(v, None) for v in x.tolist()] + [(None, None)], "a double, b double").repartition(6)
    found = approx_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 1.0])
    assert found["b"] == [None] * 4
    assert np.allclose(found["a"], [0, 12_500, 25_000, 49_999], atol=500)
    few = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "id int, a double")
    assert feat.impute_median(few, ["a"], approx=True).filter("id = 3").first()["a"] in (1.0, 2.0)
    assert feat.fit_features(few, "id", scaler="robust", approx=True).medians["a"] in (1.0, 2.0)


def test_sampled_silhouette(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 1, (40, 2)) for c in (0, 6)])
    df = frame(spark, x).selectExpr("*", f"CAST(id >= 40 AS INT) AS {LABEL}")
    whole = silhouette_samples(df, "id", f_cols(x)).toPandas()["s"].mean()
    assert silhouette_score(df, "id", f_cols(x), sample_size=1_000).first()[0] == pytest.approx(whole)
    part = silhouette_score(df, "id", f_cols(x), sample_size=20).first()[0]
    assert part == silhouette_score(df.repartition(7), "id", f_cols(x), sample_size=20).first()[0]
    assert silhouette_score(df.filter("id < 40"), "id", f_cols(x), sample_size=20).first()[0] is None
    with pytest.raises(ValueError):
        silhouette_score(df, "id", f_cols(x), sample_size=1)


@pytest.mark.parametrize("metric,eps", [("euclidean", 1.9), ("manhattan", 6.5), ("cosine", 0.25)])
def test_dbscan_beyond_the_grid_columns(spark, metric, eps):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.6, (25, 12)) for c in rng.normal(0, 2, (4, 12))] + [rng.normal(0, 4, (10, 12))])
    got = by_id(db.dbscan_labels(frame(spark, x), "id", f_cols(x), eps, 4, metric))
    assert got.tolist() == plain_dbscan(distances(x, metric), eps, 4).tolist()
    assert len(set(got)) > 2


def test_one_hot_columns_as_one(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(rng.normal()), f"k{rng.integers(0, 14)}") for i in range(120)]
    df = spark.createDataFrame(rows, "id long, x double, c string")
    spec = feat.fit_features(df, "id")
    _, cols = db._folded(spec.transform(df), spec, 0.5, "euclidean")
    assert len(cols) == 2 and len(spec.f_cols) == 15
    x = spec.transform(df).toPandas().sort_values("id")[spec.f_cols].to_numpy()
    for eps in (0.5, 6.5):
        got = by_id(db.dbscan(df, "id", eps=eps, min_samples=3, spec=spec).labels)
        assert got.tolist() == plain_dbscan(distances(x), eps, 3).tolist()


def test_loaded_models(spark, tmp_path):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 0.2, (20, 4)) for c in (0, 3)])
    df = frame(spark, x)
    stage = [PCA(k=2, inputCol="features", outputCol="reduced")]
    for fitted in (
        km.kmeans(df, "id", n_clusters=2, init=[[0.0] * 2, [1.0] * 2], extra_stages=stage),
        db.dbscan(df, "id", eps=1.0, min_samples=3),
    ):
        loaded = store.load_model(spark, store.save_model(fitted, str(tmp_path)), df)
        assert by_id(loaded.labels).tolist() == by_id(fitted.labels).tolist()
        got, want = evaluate(loaded).first().asDict(), evaluate(fitted).first().asDict()
        assert got == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in want.items()}
    with pytest.raises(ValueError):
        store.load_model(spark, store.save_model(fitted, str(tmp_path)), df.selectExpr("id + 1 AS id", *f_cols(x)))
