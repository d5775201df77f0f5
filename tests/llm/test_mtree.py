import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from spindrift.llm import mtree


def plain(rows, is_query, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            good[i] = [math.floor(256 * c) for c in v]
    out = []
    for q, x in good.items():
        if is_query(q):
            found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(
        [Row(vec_id=i, embedding=v, tree=1, x="x", rank=2, score=3, block=4) for i, v in rows],
        "vec_id long, embedding array<double>, tree int, x string, rank int, score int, block int",
    )


def found(df, k=5, every=5):
    return sorted(map(tuple, mtree.top_k(df, F.col("vec_id") % every == 0, k).collect()))


@pytest.mark.parametrize("tree_rows, page", [(20_000, 64), (40, 4)])
def test_equals_brute_force(spark, monkeypatch, tree_rows, page):
    monkeypatch.setattr(mtree, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(mtree, "PAGE", page)
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=6) * rng.choice([0.1, 1, 5])]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)] + [(i, [0.0] * 6) for i in range(340, 350)]
    assert found(frame(spark, rows)) == plain(rows, lambda i: i % 5 == 0, 5)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (6, [-1.0, 0.5]), (None, [9.0, 9.0])]
    df = frame(spark, rows)
    assert found(df.unionByName(df)) == plain(rows, lambda i: i % 5 == 0, 5)
    assert found(df.limit(0)) == []
    assert found(df.filter("vec_id = 0")) == []
    assert found(df.filter("vec_id = 6")) == []


def test_search_leaves_pages_out():
    rng = np.random.default_rng(1)
    x = np.rint(rng.normal(size=(3_000, 3)) * 100)
    norm2 = float((x * x).sum(axis=1).max())
    tree = mtree.Tree(mtree._lifted(x, norm2))
    seen = []
    q = x[11]

    def score_of(rows):
        seen.extend(rows.tolist())
        return [(-int(x[r] @ q), int(r)) for r in rows]

    got = tree.search(np.append(q, 0.0), score_of, 5, None, lambda s: math.sqrt(max(0.0, q @ q + norm2 - 2 * s)))
    assert got == sorted((-int(v @ q), i) for i, v in enumerate(x))[:5]
    assert len(seen) < 1_000
