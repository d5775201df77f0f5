"""The models by name, with the parameter choices they offer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .agglomerative import agglomerative
from .dbscan import dbscan
from .kmeans import kmeans
from .result import ClusterResult

MODELS = {"KMeans": kmeans, "DBSCAN": dbscan, "AgglomerativeClustering": agglomerative}


def available_models() -> list[str]:
    return list(MODELS)


def cluster(df: DataFrame, model: str, id_col: str, cols: list[str] | None = None, **params) -> ClusterResult:
    """Fit a model by name."""
    if model not in MODELS:
        raise ValueError(f"model must be one of {available_models()}, not {model!r}")
    return MODELS[model](df, id_col, cols, **params)


# fixed values: the choices offered per parameter
CHOICES = {
    "common": {
        "cat_encoder": ["ohe", "ordinal"],
        "scaler": ["standard", "minmax", "robust", None],
    },
    "KMeans": {
        "n_clusters": [2, 3, 4, 5, 6, 8, 10],
        "init": ["k-means++", "random"],
        "n_init": [10, 20, 50, "auto"],
        "random_state": [42, 0, 7, 123, None],
    },
    "DBSCAN": {
        "eps": [0.3, 0.5, 0.7, 1.0, 1.5],
        "min_samples": [3, 5, 10, 15],
        "metric": ["euclidean", "manhattan", "cosine"],
    },
    "AgglomerativeClustering": {
        "n_clusters": [2, 3, 4, 5, 6, 8],
        "linkage": ["ward", "complete", "average", "single"],
        "metric": ["euclidean", "manhattan", "cosine"],
    },
}


def parameter_choices(model: str, linkage: str | None = None) -> dict[str, list]:
    """Usual values per parameter; ward linkage leaves no choice of metric."""
    if model not in MODELS:
        raise ValueError(f"model must be one of {available_models()}, not {model!r}")
    found = {**CHOICES["common"], **CHOICES[model]}
    if model == "AgglomerativeClustering" and linkage == "ward":
        found.pop("metric")
    return found
