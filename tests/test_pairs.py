import numpy as np
import pytest
from plain import distances
from plain import linkage as plain_linkage

from spindrift.operators import agglomerative as agg
from spindrift.operators.pairs import agglomerative_pairs, linkage_pairs


def given(spark, d, keep=None):
    i, j = np.triu_indices(len(d), 1)
    rows = [(int(a) * 10, int(b) * 10, float(d[a, b])) for a, b in zip(i, j) if keep is None or keep(a, b)]
    rows += [(b, a, x) for a, b, x in rows[::3]] + [(0, 0, 0.0), (0, 10, None), (10, 0, float("nan")), (0, 999, 0.0)]
    ids = spark.createDataFrame([(k * 10,) for k in range(len(d))], "id long")
    return ids, spark.createDataFrame(rows, "a long, b long, distance double").repartition(4)


@pytest.mark.parametrize("linkage,last", [("ward", 4), ("complete", 128), ("average", 4), ("single", 128)])
def test_all_pairs(spark, monkeypatch, linkage, last):
    monkeypatch.setattr(agg, "LAST_CLUSTERS", last)
    d = distances(np.random.default_rng(5).normal(0, 1, (30, 2)))
    want = plain_linkage(d, linkage)
    got = linkage_pairs(*given(spark, d), linkage).toPandas().sort_values("merge_id")
    assert np.allclose(got["distance"], [w[2] for w in want], atol=1e-9)
    assert list(zip(got["left_id"], got["right_id"], got["size"])) == [(w[0], w[1], w[3]) for w in want]


def test_missing_pairs(spark, monkeypatch):
    monkeypatch.setattr(agg, "LAST_CLUSTERS", 2)
    x = np.array([0.0, 1.0, 2.5, 10.0, 11.2, 30.0])[:, None]
    d = distances(x)
    near = lambda a, b: d[a, b] < 3 and (a, b) != (0, 2)
    ids, pairs = given(spark, d, near)
    single = linkage_pairs(ids, pairs, "single").toPandas()
    assert sorted(single["distance"].round(6)) == [1.0, 1.2, 1.5]
    # 0 and 2.5 have no distance, so 2.5 stays out of the cluster of 0 and 1
    complete = linkage_pairs(ids, pairs, "complete").toPandas()
    assert sorted(complete["distance"].round(6)) == [1.0, 1.2]
    labels = {r["id"]: r["cluster_label"] for r in agglomerative_pairs(ids, pairs, 3, "single").collect()}
    assert labels == {0: 0, 10: 0, 20: 0, 30: 1, 40: 1, 50: 2}
    with pytest.raises(ValueError, match="nothing connects"):
        agglomerative_pairs(ids, pairs, 2, "single")
    with pytest.raises(ValueError):
        agglomerative_pairs(ids, pairs, 3, "median")


def test_no_pairs_and_ties(spark):
    ids, pairs = given(spark, np.ones((5, 5)))
    none = pairs.limit(0)
    assert linkage_pairs(ids, none, "average").count() == 0
    assert agglomerative_pairs(ids, none, 5, "average").count() == 5
    tied = linkage_pairs(ids, pairs.filter("NOT (a = 0 AND b = 999)"), "average").toPandas()
    assert tied["distance"].tolist() == [1.0] * 4 and tied["size"].max() == 5


@pytest.mark.parametrize("linkage", ["ward", "average"])
def test_kept_distances_and_blocks_agree(spark, monkeypatch, linkage):
    x = np.random.default_rng(8).normal(0, 1, (140, 3)).round(1)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, f_0 double, f_1 double, f_2 double")
    cols = ["f_0", "f_1", "f_2"]
    a = agg.linkage_table(df, "id", cols, linkage).toPandas()
    want = plain_linkage(distances(x), linkage)
    assert np.allclose(sorted(a["distance"]), sorted(w[2] for w in want), atol=1e-6) or linkage != "ward"
    monkeypatch.setattr(agg, "PAIR_ROWS", 0)
    b = agg.linkage_table(df, "id", cols, linkage).toPandas()
    assert np.allclose(sorted(a["distance"]), sorted(b["distance"]), atol=1e-6)
