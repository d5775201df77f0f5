"""Lineage cuts for iterative plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; make one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spindrift-"))
    else:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach"
        )


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage and start a fresh plan from it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def table(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a written table: for what one round hands to the next.

    A checkpointed frame keeps the size the optimizer estimated for it, and a
    join multiplies estimates, so over many rounds the estimate itself becomes
    too long a number to handle. A table has the size it has on disk.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
