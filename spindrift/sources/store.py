"""Saving, listing and loading fitted models; profile export."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import FeatureSpec
from ..operators.result import LABEL, ClusterResult, labels_of
from ..operators.wide import WideCentres, nearest

REGISTRY = "model_type string, path string, created_at timestamp"


def write_profile(profile: DataFrame, path: str) -> str:
    """CSV with the label as first column."""
    rest = [c for c in profile.columns if c != LABEL]
    profile.select(LABEL, *rest).write.option("header", True).csv(path)
    return path


def save_model(result: ClusterResult, root: str) -> str:
    """Write the model under ``root/<model>/<time>`` and note it in the registry."""
    spark = result.source.sparkSession
    now = datetime.now(timezone.utc)
    path = f"{root}/{result.model}/{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    spec = result.spec.to_dict()
    saved = {
        "model": result.model, "params": result.params, "spec": spec,
        "centres": result.centres, "wide": None if result.wide_centres is None else [result.wide_centres.dense, result.wide_centres.squares],
        "inertia": result.inertia, "n_iter": result.n_iter,
    }
    spark.createDataFrame([(json.dumps(saved),)], "body string").write.text(f"{path}/spec")
    if result.spec.stages is not None:
        result.spec.stages.write().save(f"{path}/stages")
    if result.spec.dictionary is not None:
        result.spec.dictionary.write.parquet(f"{path}/dictionary")
    if result.wide_centres is not None:
        result.wide_centres.values.write.parquet(f"{path}/centres")
    if result.label_table is not None:
        result.label_table.write.parquet(f"{path}/labels")
    row = spark.createDataFrame([(result.model, path, now)], REGISTRY)
    row.write.mode("append").parquet(f"{root}/registry")
    return path


def list_models(spark: SparkSession, root: str, model_type: str | None = None) -> DataFrame:
    """Saved models, newest first; no rows if there are none."""
    try:
        found = spark.read.schema(REGISTRY).parquet(f"{root}/registry")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], REGISTRY)
    if model_type is not None:
        found = found.filter(F.col("model_type") == model_type)
    return found.orderBy(F.desc("created_at"), "path")


def load_model(spark: SparkSession, path: str, df: DataFrame) -> ClusterResult:
    """The model on ``df``, which must have the id and feature columns.

    Models with centres label any rows; the others keep the labels of the rows
    they were fitted on, matched by id, and a row without one raises.
    """
    body = spark.read.text(f"{path}/spec").first()["value"]
    saved = json.loads(body)
    has_stages = saved["spec"]["has_stages"]
    stages = PipelineModel.load(f"{path}/stages") if has_stages else None
    dictionary = spark.read.parquet(f"{path}/dictionary") if saved["spec"]["wide"] else None
    spec = FeatureSpec.from_dict(saved["spec"], stages, dictionary)
    labels, centres = None, None
    if saved["wide"] is not None:
        centres = WideCentres(saved["wide"][0], spark.read.parquet(f"{path}/centres"), saved["wide"][1])
        near = nearest(spec.transform(df), spec.f_cols, len(spec.sparse), centres)
        labels = near.select(spec.id_col, F.col("_near.c").alias(LABEL))
    elif saved["centres"] is None:
        labels = labels_of(df, spec.id_col, spark.read.parquet(f"{path}/labels"))
    return ClusterResult(
        saved["model"], saved["params"], spec, df, label_table=labels,
        centres=saved["centres"], inertia=saved["inertia"], n_iter=saved["n_iter"], wide_centres=centres,
    )
