"""Reading tables and choosing feature columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("parquet", "csv", "json", "orc", "text", "avro")

NUMERIC, CATEGORICAL, VECTOR, UNUSABLE = "numeric", "categorical", "vector", "unusable"


def load_table(spark: SparkSession, path, format: str = "parquet", **options) -> DataFrame:
    """Open a table; ``schema`` and other options go to the Spark reader unchanged."""
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    if format == "csv":
        options.setdefault("header", True)
    schema = options.pop("schema", None)
    reader = spark.read.format(format).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)


def require_table(df) -> DataFrame:
    if not isinstance(df, DataFrame):
        raise TypeError("the source must be a Spark DataFrame")
    if df.isEmpty():
        raise ValueError("the source table has no rows")
    return df


def role_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.StringType, T.BooleanType, T.VarcharType, T.CharType)):
        return CATEGORICAL
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.NumericType):
        return VECTOR
    return UNUSABLE


def column_roles(df: DataFrame) -> DataFrame:
    """One row per column: position, column, type, role."""
    rows = [
        (i, f.name, f.dataType.simpleString(), role_of(f.dataType))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, role string"
    )


def check_columns(df: DataFrame, id_col: str, cols: list[str] | None) -> list[str]:
    """Validated feature column names; ``None`` means all but the id."""
    if id_col not in df.columns:
        raise ValueError(f"no id column {id_col!r} in the table")
    if cols is None:
        return [c for c in df.columns if c != id_col]
    if not isinstance(cols, (list, tuple)):
        raise ValueError("cols must be a list of column names")
    if any(not isinstance(c, str) for c in cols):
        raise ValueError("cols must hold strings only")
    names = [c.strip() for c in cols]
    names = [c for c in names if c]
    if not names:
        raise ValueError("cols names no column")
    twice = sorted({c for c in names if names.count(c) > 1})
    if twice:
        raise ValueError(f"columns named more than once: {twice}")
    unknown = [c for c in names if c not in df.columns]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    if id_col in names:
        raise ValueError(f"the id column {id_col!r} cannot be a feature")
    return names


def select_features(df: DataFrame, id_col: str, cols: list[str] | None = None) -> DataFrame:
    """Id and feature columns only, so the scan reads nothing else."""
    names = check_columns(df, id_col, cols)
    return df.select(_q(id_col), *[_q(c) for c in names])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
