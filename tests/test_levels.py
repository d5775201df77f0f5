import numpy as np
import pandas as pd
import pytest
from plain import distances

from spindrift import queries
from spindrift.operators import agglomerative as agg
from spindrift.operators import levels
from spindrift.operators import pairs as ap


def given(spark, x, most=np.inf, missing=0.0):
    """All pairs up to a distance, each once, in any order of its ends; some are missing."""
    rng = np.random.default_rng(1)
    d = distances(x)
    i, j = np.triu_indices(len(x), 1)
    there = (d[i, j] <= most) & (rng.random(len(i)) >= missing)
    i, j = i[there], j[there]
    turned = rng.random(len(i)) < 0.5
    rows = pd.DataFrame({"a": np.where(turned, j, i) * 3, "b": np.where(turned, i, j) * 3, "distance": d[i, j]})
    rows = pd.concat([rows, pd.DataFrame({"a": [0, 3], "b": [0, 9999], "distance": [0.0, 0.0]})])
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)) * 3})), spark.createDataFrame(rows).repartition(3)


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(agg, "LAST_CLUSTERS", 3)
    monkeypatch.setattr(agg, "LAST_EXACT", 1)
    for name, value in {"LEVEL_EDGES": 500, "LEVEL_CELLS": 100, "SAMPLE_PAIRS": 5_000}.items():
        monkeypatch.setattr(levels, name, value)
    kept, cut = [], levels.cut

    def noted(df):
        out = cut(df)
        if "least" in df.columns:
            kept.append(out.count())
        return out

    monkeypatch.setattr(levels, "cut", noted)
    return kept


@pytest.mark.parametrize("linkage,most,missing", [("ward", np.inf, 0.0), ("average", 1.5, 0.0), ("complete", 2.5, 0.001), ("single", 1.5, 0.0)])
def test_levels_merge_as_kept_distances(spark, small, linkage, most, missing):
    ids, pairs = given(spark, np.random.default_rng(7).normal(0, 1, (160, 2)), most, missing)
    want = ap.linkage_pairs(ids, pairs, linkage).toPandas().sort_values("merge_id")
    assert not small
    got = ap.linkage_pairs(ids, pairs, linkage, once=True).toPandas().sort_values("merge_id")
    assert len(small) > 1 and max(small) <= levels.TOO_MANY * levels.LEVEL_EDGES < pairs.count()
    assert np.allclose(got["distance"], want["distance"], atol=1e-9)
    assert (got[["left_id", "right_id", "size"]].to_numpy() == want[["left_id", "right_id", "size"]].to_numpy()).all()


@pytest.mark.parametrize("linkage", ["average", "ward"])
def test_copies_and_ties(spark, small, linkage):
    x = np.repeat(np.random.default_rng(3).normal(0, 1, (20, 2)), 6, axis=0)
    ids, pairs = given(spark, x)
    want = ap.linkage_pairs(ids, pairs, linkage).toPandas()
    got = ap.linkage_pairs(ids, pairs, linkage, once=True).toPandas()
    assert np.allclose(sorted(got["distance"]), sorted(want["distance"]), atol=1e-9)
    assert sorted(got["size"])[-19:] == sorted(want["size"])[-19:]
    # all distances alike: no reach parts them
    ids, pairs = given(spark, np.arange(60.0)[:, None])
    got = ap.linkage_pairs(ids, pairs.withColumn("distance", pairs.distance * 0 + 1), linkage, once=True).toPandas()
    assert len(got) == 59 and got["size"].max() == 60 and (linkage == "ward" or (got["distance"] == 1).all())


def test_labels_and_repeated_pairs(spark, small):
    ids, pairs = given(spark, np.random.default_rng(5).normal(0, 1, (120, 2)))
    want = ap.agglomerative_pairs(ids, pairs, 6, "average").toPandas().sort_values("id")
    got = ap.agglomerative_pairs(ids, pairs, 6, "average", once=True).toPandas().sort_values("id")
    assert small and want["cluster_label"].tolist() == got["cluster_label"].tolist()
    with pytest.raises(Exception, match="more than once"):
        ap.agglomerative_pairs(ids, pairs.unionByName(pairs), 6, "average", once=True).collect()


def test_pairs_of_the_queries_come_once(spark):
    rng = np.random.default_rng(2)
    x = np.r_[rng.normal(0, 2, (150, 2)), np.zeros((5, 2)), [[1.5, 3.0], [-1.5, -3.0]]]
    f = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "f_0": x[:, 0], "f_1": x[:, 1]}))
    found = queries.near_pairs(f, 1.5).toPandas()
    assert (found["a"] < found["b"]).all() and not found.duplicated(["a", "b"]).any()
