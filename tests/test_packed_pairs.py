import numpy as np
import pytest

from spindrift.operators import agglomerative as agg
from spindrift.operators import pairs as ap


def edges(spark, n, share, seed):
    """Distances of some pairs of n ids with gaps, some given twice, both ways, null or infinite; many tie."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 2)).round(1)
    rows = [(i * 7, j * 7, float(np.hypot(*(x[i] - x[j])))) for i in range(n) for j in range(i) if rng.random() < share]
    rows += [(b, a, d + 0.5) for a, b, d in rows[::3]] + [(0, 7, None), (7, 14, float("inf")), (0, 3, 0.0)]
    return spark.createDataFrame([(i * 7,) for i in range(n)], "id long"), spark.createDataFrame(rows, "a long, b long, distance double").repartition(3)


@pytest.mark.parametrize("linkage,share", [("ward", 1.0), ("average", 0.8), ("complete", 0.8), ("single", 0.1)])
def test_packed_rounds_merge_as_edges_as_rows(spark, monkeypatch, linkage, share):
    ids, pairs = edges(spark, 60, share, 3)
    want = ap.linkage_pairs(ids, pairs, linkage).toPandas().sort_values("merge_id")  # one task merges all
    monkeypatch.setattr(agg, "LAST_CLUSTERS", 4)
    monkeypatch.setattr(agg, "LAST_EXACT", 1)
    seen, table = [], ap.table

    def noted(df):
        out = table(df)
        if "near" in df.columns:
            seen.append((out.count(), out.select("a").distinct().count()))
        return out

    monkeypatch.setattr(ap, "table", noted)
    for packed in (1_000, 40):  # from the start, and after a round of edges as rows
        seen.clear()
        monkeypatch.setattr(ap, "PACKED", packed)
        got = ap.linkage_pairs(ids, pairs, linkage).toPandas().sort_values("merge_id")
        assert np.allclose(got["distance"], want["distance"], atol=1e-9)
        assert (got[["left_id", "right_id", "size"]].to_numpy() == want[["left_id", "right_id", "size"]].to_numpy()).all()
        # distances of a cluster are one row, not a row each
        assert len(seen) > 1 and all(n == clusters <= 60 for n, clusters in seen)


def test_small_tasks_keep_the_least_of_repeated_pairs(spark, monkeypatch):
    ids, pairs = edges(spark, 40, 1.0, 4)
    want = sorted(map(tuple, ap.linkage_pairs(ids, pairs, "complete").collect()))
    monkeypatch.setattr(ap, "TASK_EDGES", 50)
    monkeypatch.setattr(ap, "BATCH_EDGES", 30)
    monkeypatch.setattr(agg, "LAST_CLUSTERS", 1)
    got = sorted(map(tuple, ap.linkage_pairs(ids, pairs.unionByName(pairs).unionByName(pairs), "complete").collect()))
    assert got == want
