import numpy as np
import pandas as pd


def frame(spark, x, ids=None):
    ids = np.arange(len(x)) if ids is None else ids
    return spark.createDataFrame(pd.DataFrame({"id": ids, **{f"f_{i}": x[:, i] for i in range(x.shape[1])}}))


def f_cols(x):
    return [f"f_{i}" for i in range(x.shape[1])]


def by_id(df, column="cluster_label", key="id"):
    return df.toPandas().sort_values(key)[column].to_numpy()
