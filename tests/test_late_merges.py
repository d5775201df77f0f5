import numpy as np
import pytest
from helpers import f_cols, frame
from plain import distances
from plain import linkage as plain_linkage
from pyspark.sql import functions as F

from spindrift.operators import agglomerative as agg
from spindrift.operators import spanning
from spindrift.plans import components

CASES = [("complete", "manhattan"), ("average", "euclidean"), ("complete", "cosine"), ("ward", "euclidean")]


@pytest.mark.parametrize("linkage,metric", CASES)
@pytest.mark.parametrize("times", [1, 8])
def test_last_clusters_by_their_rows(spark, monkeypatch, linkage, metric, times):
    """70 rows and copies of some: all in one step, or the last 20 clusters after rounds, rows over several groups."""
    monkeypatch.setattr(agg, "PAIR_ROWS", 0)
    monkeypatch.setattr(agg, "LAST_CLUSTERS", 20)
    monkeypatch.setattr(agg, "LAST_EXACT", times)
    monkeypatch.setattr(agg, "LAST_ROWS", 9)
    monkeypatch.setattr(agg, "BLOCK_ROWS", 6)
    rounds, absorb = [], agg._Rounds.absorb
    monkeypatch.setattr(agg._Rounds, "absorb", lambda self, merges, left: (rounds.append(left), absorb(self, merges, left)))
    x = np.random.default_rng(7).normal(0, 1, (70, 2))
    x[60:] = x[:10]
    got = agg.merge_tree(frame(spark, x), "id", f_cols(x), linkage, metric).table().toPandas().sort_values("merge_id")
    assert bool(rounds) == (times == 1)
    want = plain_linkage(distances(x, metric), linkage)
    assert np.allclose(got["distance"], [w[2] for w in want], atol=1e-9)
    assert list(zip(got["left_id"], got["right_id"], got["size"]))[10:] == [(w[0], w[1], w[3]) for w in want][10:]


def test_late_rounds_on_rows_are_one_task(spark, monkeypatch):
    monkeypatch.setattr(agg, "PAIR_ROWS", 0)
    rounds, absorb = [], agg._Rounds.absorb
    monkeypatch.setattr(agg._Rounds, "absorb", lambda self, merges, left: (rounds.append(left), absorb(self, merges, left)))
    x = np.random.default_rng(3).normal(0, 1, (300, 2))
    assert agg.linkage_table(frame(spark, x), "id", f_cols(x), "average").count() == 299
    assert not rounds


def test_few_edges_are_joined_at_once(spark, monkeypatch):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 9), (9, 8), (4, 4), (3, 1)], "a long, b long")
    wanted = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7}
    several = components.connected_components(edges).collect()
    monkeypatch.setattr(components, "_round", None)
    assert {r["node"]: r["comp"] for r in components.connected_components(edges, 100).collect()} == {r["node"]: r["comp"] for r in several} == wanted
    named = edges.select(*[F.struct(F.lit(5).alias("part"), F.col(c).alias("node")).alias(c) for c in "ab"])
    found = components.connected_components(named, 100).collect()
    assert {r["node"]["node"]: (r["comp"]["part"], r["comp"]["node"]) for r in found} == {k: (5, v) for k, v in wanted.items()}


def test_single_linkage_of_a_chain_with_ties(spark, monkeypatch):
    monkeypatch.setattr(spanning, "FEW_EDGES", 20)
    monkeypatch.setattr(spanning, "PART_BITS", 3)
    x = np.array([(i, j) for i in range(9) for j in range(9)], float)
    x[40:] *= 1.25
    got = agg.merge_tree(frame(spark, x), "id", f_cols(x), "single", "euclidean").table().toPandas().sort_values("merge_id")
    assert np.allclose(got["distance"], [w[2] for w in plain_linkage(distances(x), "single")], atol=1e-9)
