"""Result tables: labelled rows, previews, sizes and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import NUMERIC, role_of
from .features import col
from .result import LABEL, NOISE, ClusterResult


def labelled_data(result: ClusterResult) -> DataFrame:
    """Id and selected raw columns of the rows, with their label."""
    return result.labelled_source()


def label_preview(result: ClusterResult, n: int = 10) -> DataFrame:
    """The first ``n`` rows by id, turned on their side: ``field, r0 ... r{n-1}``."""
    if n < 1:
        raise ValueError("n must be at least 1")
    first = result.labels.orderBy(result.id_col).limit(n)
    # at most n rows from here on
    packed = first.agg(F.array_sort(F.collect_list(F.struct(col(result.id_col).alias("i"), F.col(LABEL)))).alias("rows"))
    fields = F.explode(
        F.array(
            F.struct(F.lit("index").alias("field"), F.transform("rows", lambda r: r["i"].cast("string")).alias("v")),
            F.struct(F.lit(LABEL).alias("field"), F.transform("rows", lambda r: r[LABEL].cast("string")).alias("v")),
        )
    )
    return packed.select(fields.alias("f")).select(
        "f.field", *[F.get(F.col("f.v"), F.lit(i)).alias(f"r{i}") for i in range(n)]
    )


def cluster_sizes(result: ClusterResult) -> DataFrame:
    """``cluster_label, count, ratio`` by label, noise included."""
    sizes = result.labels.groupBy(LABEL).agg(F.count(F.lit(1)).alias("count"))
    total = result.labels.agg(F.count(F.lit(1)).alias("_all"))
    share = F.col("count") / F.col("_all")
    return sizes.crossJoin(F.broadcast(total)).select(LABEL, "count", share.alias("ratio")).orderBy(LABEL)


def profile_columns(result: ClusterResult) -> list[str]:
    schema = result.source.schema
    return [c for c in result.selected if role_of(schema[c].dataType) == NUMERIC]


def cluster_profile(
    result: ClusterResult, numeric_only: bool = True, ignore_noise: bool = False
) -> DataFrame:
    """Mean of every selected numeric column per cluster, missing values skipped.

    Only numbers have a mean, so ``numeric_only=False`` gives the same columns.
    """
    names = profile_columns(result)
    if not names:
        raise ValueError("no numeric column to profile")
    rows = result.labelled_source()
    if ignore_noise:
        rows = rows.filter(F.col(LABEL) != NOISE)
    if ignore_noise and rows.isEmpty():
        raise ValueError("no rows left to profile")

    def mean(c):
        x = col(c).cast("double")
        return F.avg(F.when(~F.isnan(x), x)).alias(c)

    return rows.groupBy(LABEL).agg(*[mean(c) for c in names]).orderBy(LABEL)


def size_bars(result: ClusterResult) -> DataFrame:
    return cluster_sizes(result).select(F.col(LABEL).cast("string").alias(LABEL), "count")


def profile_heatmap_data(
    result: ClusterResult, numeric_only: bool = True, ignore_noise: bool = False
) -> DataFrame:
    """The profile in long form: ``cluster_label, feature, mean``."""
    wide = cluster_profile(result, numeric_only, ignore_noise)
    names = [c for c in wide.columns if c != LABEL]
    return wide.unpivot(LABEL, names, "feature", "mean")
