import numpy as np
from helpers import f_cols, frame
from plain import distances
from pyspark.sql import functions as F

from spindrift import queries


def test_pairs_are_dealt_over_tasks_and_each_is_there_once(spark):
    # the second feature tells rows of one strip apart, and a crowded square is spread over slots
    x = np.vstack([np.random.default_rng(2).uniform(-2, 2, (200, 2)), np.full((150, 2), 0.05)])
    found = queries.near_pairs(frame(spark, x), 0.3)
    d = distances(x)
    i, j = np.nonzero(np.triu(d <= 0.3, 1))
    got = sorted((r["a"], r["b"]) for r in found.filter("distance <= 0.3").collect())
    assert got == sorted(zip(i.tolist(), j.tolist()))
    tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > queries.PAIR_SLOTS // 2
