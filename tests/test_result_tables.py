import numpy as np
import pytest
from helpers import frame
from pyspark.sql import functions as F

from spindrift.operators import result as res
from spindrift.operators import tables as tab
from spindrift.operators.models import cluster
from spindrift.operators.result import nearest_centre

rng = np.random.default_rng(8)
X = np.concatenate([rng.normal(c, 0.2, (15, 3)) for c in (0, 4, 8)])


def test_tables_cover_selected_columns(spark):
    df = frame(spark, X).withColumn("more", F.lit(1.5)).withColumn("s", F.lit("t"))
    made = cluster(df, "KMeans", "id", ["f_0", "f_2", "s"], n_clusters=2)
    assert tab.labelled_data(made).columns == ["id", "f_0", "f_2", "s", "cluster_label"]
    assert tab.cluster_profile(made, numeric_only=False).columns == ["cluster_label", "f_0", "f_2"]
    noise = res.given_labels(df, made.spec, df.select("id", F.lit(-1).alias("cluster_label")))
    with pytest.raises(ValueError):
        tab.cluster_profile(noise, ignore_noise=True)


def test_both_ways_to_the_nearest_centre_agree(spark, monkeypatch):
    df = frame(spark, rng.integers(0, 4, (200, 3)).astype(float))
    cols = ["f_0", "f_1", "f_2"]
    centres = [list(map(float, c)) for c in rng.integers(0, 4, (9, 3))]
    want = df.select("id", nearest_centre(cols, centres).alias("n")).collect()
    monkeypatch.setattr(res, "EXPRESSION_TERMS", 1)
    assert sorted(want) == sorted(df.select("id", nearest_centre(cols, centres).alias("n")).collect())
