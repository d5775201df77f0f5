import numpy as np
import pytest
from helpers import by_id, f_cols, frame
from plain import distances
from pyspark.sql import functions as F

from spindrift import queries
from spindrift.operators import diagnostics as diag
from spindrift.plans import blocks


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
@pytest.mark.parametrize("k", [1, 5])
def test_rows_beyond_the_bound_change_nothing(spark, monkeypatch, metric, k):
    monkeypatch.setattr(blocks, "block_rows", lambda n, at_least=0: 16)
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(0, 1, (300, 2)), np.round(rng.normal(3, 1, (200, 2))), np.zeros((1, 2))])
    d = distances(x, metric)
    np.fill_diagonal(d, np.inf)
    got = by_id(diag.kth_neighbour(frame(spark, x), "id", f_cols(x), k, metric), "k_distance")
    assert np.allclose(got, np.sort(d, axis=1)[:, k - 1], atol=1e-12)


def test_query_of_copies_alone_is_empty(spark, tmp_path):
    # six rows of each part: the fifth neighbour of every row is a copy
    rows = spark.range(60).select(
        F.col("id").alias("p_partkey"), (F.col("id") % 10).cast("int").alias("p_size"), (F.col("id") % 10 * 1.5).alias("p_retailprice")
    )
    rows.write.parquet(f"{tmp_path}/part.parquet")
    found = queries.k_distance(spark, str(tmp_path))
    assert found.columns == ["sample_rank", "k_distance"] and found.count() == 0
    assert queries.k_distance_with_zeros(spark, str(tmp_path)).count() == 60
