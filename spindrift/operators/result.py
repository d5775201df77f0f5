"""The immutable outcome of a clustering run."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import distance_matrix, num, plus
from . import wide
from .features import FeatureSpec, col

LABEL = "cluster_label"
NOISE = -1
# above this many terms the nearest centre is found by an array kernel
EXPRESSION_TERMS = 2_000


def nearest_centre(cols: list[str], centres: list[list[float]]):
    """Struct column ``(d2, c)``: squared distance and number of the nearest centre."""
    if len(centres) * len(cols) <= EXPRESSION_TERMS:
        options = []
        for i, c in enumerate(centres):
            squares = plus([f"({x} - {num(v)}) * ({x} - {num(v)})" for x, v in zip(cols, c)])
            options.append(f"named_struct('d2', {squares}, 'c', {i})")
        return F.expr(f"array_min(array({', '.join(options)}))")
    table = np.asarray(centres, dtype=float)

    @F.pandas_udf("d2 double, c int")
    def nearest(*parts: pd.Series) -> pd.DataFrame:
        x = np.column_stack([p.to_numpy(dtype=float) for p in parts])
        d2, c = np.empty(len(x)), np.empty(len(x), dtype="int32")
        for at in range(0, len(x), 512):
            # squares are compared, as in the expression: roots would make ties of their own
            d = distance_matrix(x[at:at + 512], table, "squared")
            c[at:at + 512] = d.argmin(axis=1)
            d2[at:at + 512] = d.min(axis=1)
        return pd.DataFrame({"d2": d2, "c": c})

    return nearest(*cols)


@dataclass(frozen=True)
class ClusterResult:
    """Labels of every row plus what is needed to score and describe them.

    Without ``centres`` the labels are a table joined by id. With centres a
    label is a function of the row, so labelling needs no join at all.
    """

    model: str
    params: dict
    spec: FeatureSpec
    source: DataFrame
    label_table: DataFrame | None = None
    centres: list[list[float]] | None = None
    inertia: float | None = None
    n_iter: int | None = None
    tree: object | None = None
    wide_centres: wide.WideCentres | None = None

    @property
    def id_col(self) -> str:
        return self.spec.id_col

    @property
    def f_cols(self) -> list[str]:
        return self.spec.f_cols

    @property
    def selected(self) -> list[str]:
        """The raw columns the features come from, empty ones included, in the order of the table."""
        used = {*self.spec.numeric, *self.spec.categorical, *self.spec.vectors, *self.spec.dropped}
        return [c for c in self.source.columns if c in used]

    @cached_property
    def features(self) -> DataFrame:
        return self.spec.transform(self.source)

    @cached_property
    def labelled_features(self) -> DataFrame:
        """id, f_0 ..., cluster_label"""
        if self.centres is not None:
            return self.assign_features(self.features)
        return self.features.join(self.label_table, self.id_col)

    @property
    def labels(self) -> DataFrame:
        if self.label_table is not None:
            return self.label_table
        return self.labelled_features.select(self.id_col, LABEL)

    def assign_features(self, features: DataFrame) -> DataFrame:
        return features.select(
            "*", nearest_centre(self.f_cols, self.centres)["c"].alias(LABEL)
        )

    def predict(self, df: DataFrame) -> DataFrame:
        """Labels of new rows; only a model with centres can give them."""
        if self.wide_centres is not None:
            near = wide.nearest(self.spec.transform(df), self.f_cols, len(self.spec.sparse), self.wide_centres)
            return near.select(self.id_col, F.col("_near.c").alias(LABEL))
        if self.centres is None:
            raise ValueError(f"{self.model} has no rule for rows it was not fitted on")
        return self.assign_features(self.spec.transform(df)).select(self.id_col, LABEL)

    def labelled_source(self, df: DataFrame | None = None) -> DataFrame:
        """Id, selected raw columns and ``cluster_label``."""
        raw = self.source if df is None else df
        names = [self.id_col, *self.selected]
        if self.label_table is not None or self.spec.stages is not None:
            return raw.select(*[col(c) for c in names]).join(self.labels, self.id_col)
        ready = self.spec.numbered(raw).select("*", *self.spec.processed("_f_"))
        hidden = [f"_{f}" for f in self.f_cols]
        return ready.select(*[col(c) for c in names], nearest_centre(hidden, self.centres)["c"].alias(LABEL))

    def centre_table(self) -> DataFrame | None:
        if self.centres is None:
            return None
        rows = [(i, *map(float, c)) for i, c in enumerate(self.centres)]
        schema = "cluster_label int, " + ", ".join(f"{f} double" for f in self.f_cols)
        return self.source.sparkSession.createDataFrame(rows, schema)


def labels_of(df: DataFrame, id_col: str, labels: DataFrame) -> DataFrame:
    """The ``labels`` of the rows of ``df``; raises if a row has none."""
    ids = df.select(id_col).distinct()
    if not ids.join(labels, id_col, "left_anti").isEmpty():
        raise ValueError("the table has rows without a label; this model can't label new rows")
    return labels.join(ids, id_col, "left_semi")


def given_labels(df: DataFrame, spec: FeatureSpec, labels: DataFrame, model: str = "given") -> ClusterResult:
    """Describe and score labels that come from elsewhere: ``id, cluster_label``, one for each row."""
    table = labels_of(df, spec.id_col, labels.select(spec.id_col, F.col(LABEL).cast("int").alias(LABEL)))
    return ClusterResult(model, {}, spec, df, label_table=table)
