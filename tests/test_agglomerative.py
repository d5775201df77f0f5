import numpy as np
import pytest
from helpers import by_id, f_cols, frame
from plain import distances
from plain import linkage as plain_linkage

from spindrift.operators import agglomerative as agg
from spindrift.operators import spanning
from spindrift.operators.dendrogram import dendrogram
from spindrift.plans import blocks

CASES = [("ward", "euclidean"), ("complete", "manhattan"), ("average", "euclidean"), ("average", "cosine"),
         ("complete", "cosine"), ("single", "euclidean")]


def check(spark, x, linkage, metric):
    tree = agg.merge_tree(frame(spark, x, np.arange(len(x)) * 3), "id", f_cols(x), linkage, metric)
    got = tree.table().toPandas().sort_values("merge_id")
    want = plain_linkage(distances(x, metric), linkage)
    assert np.allclose(got["distance"], [w[2] for w in want], atol=1e-9)
    assert list(zip(got["left_id"], got["right_id"], got["size"])) == [(w[0], w[1], w[3]) for w in want]
    return tree


@pytest.mark.parametrize("linkage,metric", [CASES[0], CASES[2], CASES[5]])
def test_small_tree(spark, linkage, metric):
    check(spark, np.random.default_rng(1).normal(0, 1, (50, 3)), linkage, metric)


@pytest.mark.parametrize("linkage,metric", CASES)
def test_many_blocks(spark, monkeypatch, linkage, metric):
    monkeypatch.setattr(agg, "PAIR_ROWS", 0)
    monkeypatch.setattr(agg, "BLOCK_ROWS", 16)
    monkeypatch.setattr(agg, "MEMBER_ROWS", 4)
    monkeypatch.setattr(agg, "LAST_CLUSTERS", 24)
    monkeypatch.setattr(blocks, "block_rows", lambda n, at_least=0: 16)
    monkeypatch.setattr(spanning, "PART_BITS", 4)
    check(spark, np.random.default_rng(2).normal(0, 1, (70, 3)), linkage, metric)


@pytest.mark.parametrize("linkage", ["average", "single"])
def test_copies_merge_first(spark, linkage):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (12, 2))[rng.integers(0, 12, 40)]
    tree = agg.merge_tree(frame(spark, x), "id", f_cols(x), linkage, "euclidean")
    got = tree.table().toPandas().sort_values("merge_id")
    want = plain_linkage(distances(x), linkage)
    assert np.allclose(got["distance"], [w[2] for w in want], atol=1e-9)
    assert got["size"].iloc[-1] == 40
    kids = list(got.left_id) + list(got.right_id)
    assert sorted(kids) == list(range(2 * 40 - 2))
    lab = by_id(tree.cut_at(12 if len(set(map(tuple, x))) >= 12 else len(set(map(tuple, x)))))
    groups = {}
    for row, c in zip(map(tuple, x), lab):
        groups.setdefault(c, set()).add(row)
    assert all(len(g) == 1 for g in groups.values())


def test_all_rows_equal(spark):
    tree = agg.merge_tree(frame(spark, np.ones((5, 2))), "id", ["f_0", "f_1"], "average", "euclidean")
    assert set(tree.table().toPandas()["distance"]) == {0.0}


def test_even_chain(spark):
    x = np.arange(30.0)[:, None]
    tree = agg.merge_tree(frame(spark, x), "id", ["f_0"], "single", "euclidean")
    assert set(tree.table().toPandas()["distance"]) == {1.0}
    assert sorted(set(by_id(tree.cut_at(4)))) == [0, 1, 2, 3]


def test_dendrogram_order(spark):
    x = np.random.default_rng(6).normal(0, 1, (20, 2))
    merges = agg.linkage_table(frame(spark, x), "id", f_cols(x), "average")
    z = {int(r.merge_id) + 20: (int(r.left_id), int(r.right_id)) for r in merges.toPandas().itertuples()}
    height = {int(r.merge_id) + 20: r.distance for r in merges.toPandas().itertuples()}

    def leaves(node):
        if node < 20:
            return [node]
        a, b = z[node]
        if height.get(a, 0) > height.get(b, 0):
            a, b = b, a
        return leaves(a) + leaves(b)

    out = dendrogram(merges, distance_sort="ascending").toPandas()
    assert list(out[out.is_leaf].sort_values("order").node) == leaves(38)
    assert dendrogram(merges, "lastp", 5).filter("is_leaf").count() == 5
    for bad in (("bogus", 5), ("lastp", 0)):
        with pytest.raises(ValueError):
            dendrogram(merges, *bad)


def test_bad_parameters(spark):
    df = frame(spark, np.eye(3))
    for args in ((2, "ward", "manhattan"), (0, "single"), (2, "bogus"), (9, "single")):
        with pytest.raises(ValueError):
            agg.agglomerative(df, "id", None, *args)
    zero = frame(spark, np.array([[0.0, 0.0], [1.0, 2.0]]))
    with pytest.raises(ValueError):
        agg.merge_tree(zero, "id", ["f_0", "f_1"], "average", "cosine")


@pytest.mark.parametrize("linkage,metric", [("ward", "euclidean"), ("average", "cosine")])
def test_late_rounds_by_centres_are_one_task(spark, monkeypatch, linkage, metric):
    monkeypatch.setattr(agg, "PAIR_ROWS", 0)
    x = np.random.default_rng(3).normal(0, 1, (300, 2)).round(6)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, f_0 double, f_1 double")
    rounds, absorb = [], agg._Rounds.absorb
    monkeypatch.setattr(agg._Rounds, "absorb", lambda self, merges, left: (rounds.append(left), absorb(self, merges, left)))
    got = agg.linkage_table(df, "id", ["f_0", "f_1"], linkage, metric).toPandas().sort_values("merge_id")
    assert not rounds
    monkeypatch.setattr(agg, "LAST_EXACT", 1)
    want = agg.linkage_table(df, "id", ["f_0", "f_1"], linkage, metric).toPandas().sort_values("merge_id")
    assert rounds
    assert np.allclose(got["distance"], want["distance"], atol=1e-9)
    assert got[["left_id", "right_id", "size"]].values.tolist() == want[["left_id", "right_id", "size"]].values.tolist()
