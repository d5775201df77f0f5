"""Feature preparation: fill gaps, encode categories, scale, assemble.

A fit costs a fixed number of aggregations whatever the number of columns.
The result is a ``FeatureSpec`` - plain values - whose ``transform`` is one
``select`` of built-in expressions.

Categories of a column with more than ``NARROW`` values are not written into the plan: they
are numbered in a dictionary table, which rows are joined with. Such a column is one feature if the
encoding is ordinal, and a sparse block if it is one-hot (``wide``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import num
from ..functions.quantiles import approx_quantiles, exact_quantiles
from ..plans.cut import cut
from ..plans.numbering import number_rows
from ..plans.skew import attach
from ..sources.tables import (
    CATEGORICAL,
    NUMERIC,
    UNUSABLE,
    VECTOR,
    check_columns,
    require_table,
    role_of,
)

SCALERS = {
    "none": "none", "no": "none", "off": "none",
    "standard": "standard", "std": "standard",
    "minmax": "minmax", "min_max": "minmax",
    "robust": "robust", "rbst": "robust",
}  # fixed values
ENCODERS = {
    "ohe": "ohe", "onehot": "ohe", "one_hot": "ohe",
    "ordinal": "ordinal", "ord": "ordinal", "ord_label": "ordinal",
}  # fixed values
# up to so many values a category is a column definition (one-hot) or a literal (ordinal)
NARROW = 200


def scaler_name(scaler: str | None) -> str:
    if scaler is None:
        return "none"
    try:
        return SCALERS[scaler.lower().strip()]
    except (KeyError, AttributeError):
        raise ValueError("scaler must be 'standard', 'minmax', 'robust' or 'none'") from None


def encoder_name(encoder: str) -> str:
    try:
        return ENCODERS[encoder.lower().strip()]
    except (KeyError, AttributeError):
        raise ValueError("cat_encoder must be 'ohe' or 'ordinal'") from None


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number(name: str, at: int | None = None) -> str:
    """SQL of a numeric column, or of one array element, as double without NaN."""
    x = quoted(name) if at is None else f"get({quoted(name)}, {at})"
    return f"nullif(CAST({x} AS DOUBLE), double('NaN'))"


def text(name: str) -> Column:
    return col(name).cast("string")


@dataclass(frozen=True)
class FeatureSpec:
    id_col: str
    numeric: list[str]
    categorical: list[str]
    vectors: dict[str, int]
    dropped: list[str]
    medians: dict[str, float]
    vector_medians: dict[str, list[float]]
    modes: dict[str, str]
    categories: dict[str, list[str]]
    encoder: str
    scaler: str
    names: list[str]
    centre: list[float] = field(default_factory=list)
    width: list[float] = field(default_factory=list)
    n_original: int = 0
    stages: PipelineModel | None = None
    stage_output: str | None = None
    stage_size: int = 0
    wide: dict[str, int] = field(default_factory=dict)
    dictionary: DataFrame | None = None

    @property
    def f_cols(self) -> list[str]:
        return [f"f_{i}" for i in range(len(self.names))]

    @property
    def sparse(self) -> list[str]:
        """Columns that are sparse one-hot blocks; their features follow those of ``names``."""
        return [c for c in self.categorical if c in self.wide and self.encoder == "ohe"]

    @property
    def n_features(self) -> int:
        return len(self.names) + sum(self.wide[c] for c in self.sparse)

    def numbered(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of each category of the wide columns, -1 for an unknown one."""
        for i, c in enumerate(self.wide):
            known = self.dictionary.filter(F.col("column") == c).select(
                F.col("value").alias("_value"), F.col("code").alias(f"_code_{i}"), F.col("delta").alias(f"_delta_{i}"), F.col("n").alias("_n")
            )
            df = df.withColumn("_value", F.coalesce(text(c), F.lit(self.modes[c])))
            df = attach(df, known, ["_value"], "_n", "left", small_rows=self.wide[c]).drop("_value", "_n")
            df = df.withColumn(f"_code_{i}", F.coalesce(f"_code_{i}", F.lit(-1).cast("long")))
        return df

    def blocks(self) -> list[Column]:
        """``w_i`` and ``v_i`` of each sparse block: number of the category, and what it adds to the block's base values."""
        at = list(self.wide)
        return [
            x for i, c in enumerate(self.sparse) for x in (
                F.col(f"_code_{at.index(c)}").alias(f"w_{i}"), F.coalesce(f"_delta_{at.index(c)}", F.lit(0.0)).alias(f"v_{i}")
            )
        ]

    def base_values(self) -> DataFrame:
        """``index, name, value``: the features of the sparse blocks in rows of another category."""
        offset, start = F.lit(None).cast("long"), len(self.names)
        for c in self.sparse:
            offset = F.when(F.col("column") == c, F.lit(start).cast("long")).otherwise(offset)
            start += self.wide[c]
        return self.dictionary.withColumn("_at", offset).filter("_at IS NOT NULL").select(
            (F.col("_at") + F.col("code")).alias("index"), F.concat_ws("_", "column", "value").alias("name"), F.col("base").alias("value")
        )

    def transform_long(self, df: DataFrame) -> DataFrame:
        """``id, index, value`` of any table: the features of each row, of a sparse block only that of the row's category.

        What is left out has the value ``base_values`` gives, which is 0 unless the scaler shifts. Of an
        unknown category nothing is left in.
        """
        ready = self.transform(df)
        entry = lambda i, v: F.struct(i.cast("long").alias("index"), v.alias("value"))
        dense = [entry(F.lit(i), F.col(f)) for i, f in enumerate(self.f_cols)]
        start, rest = len(self.names), []
        for i, c in enumerate(self.sparse):
            rest.append(F.when(F.col(f"w_{i}") >= 0, entry(F.col(f"w_{i}") + start, F.col(f"v_{i}"))))
            start += self.wide[c]
        long = ready.select(col(self.id_col), F.explode(F.array_compact(F.array(*dense, *rest))).alias("_e"))
        long = long.select(col(self.id_col), "_e.index", "_e.value")
        if self.scaler == "none" or not self.sparse:
            return long
        base = self.base_values().join(self._block_counts(), "index").select("index", F.col("value").alias("_base"), "_n")
        found = attach(long.filter(F.col("index") >= len(self.names)), base, ["index"], "_n")
        moved = found.select(col(self.id_col), "index", (F.col("value") + F.col("_base")).alias("value"))
        return long.filter(F.col("index") < len(self.names)).unionByName(moved)

    def _block_counts(self) -> DataFrame:
        start, parts = len(self.names), None
        for c in self.sparse:
            part = self.dictionary.filter(F.col("column") == c).select((F.col("code") + start).alias("index"), F.col("n").alias("_n"))
            parts = part if parts is None else parts.unionByName(part)
            start += self.wide[c]
        return parts

    def encoded(self) -> list[Column]:
        """Imputed and encoded columns, before scaling."""
        out = [F.expr(f"coalesce({number(c)}, {num(self.medians[c])})") for c in self.numeric]
        for c, size in self.vectors.items():
            out += [F.expr(f"coalesce({number(c, k)}, {num(self.vector_medians[c][k])})") for k in range(size)]
        for c in self.categorical:
            value = F.coalesce(text(c), F.lit(self.modes[c]))
            if c in self.wide:
                # a sparse block is no column
                if self.encoder != "ohe":
                    out.append(F.col(f"_code_{list(self.wide).index(c)}").cast("double"))
            elif self.encoder == "ohe":
                out += [F.when(value == v, 1.0).otherwise(0.0) for v in self.categories[c]]
            else:
                known = F.array(*[F.lit(v) for v in self.categories[c]])
                out.append((F.array_position(known, value) - 1).cast("double"))
        return out

    def processed(self, prefix: str) -> list[Column]:
        """Imputed, encoded and scaled columns, named ``prefix`` and a number."""
        cols = self.encoded()
        if self.scaler != "none":
            cols = [(c - m) / w for c, m, w in zip(cols, self.centre, self.width)]
        return [c.alias(f"{prefix}{i}") for i, c in enumerate(cols)]

    def transform(self, df: DataFrame) -> DataFrame:
        """Id and ``f_0 ...`` for any table with the fitted columns, then ``w_i, v_i`` of sparse blocks."""
        ready = self.numbered(df).select(col(self.id_col), *self.processed("f_"), *self.blocks())
        if self.stages is None:
            return ready
        cols = [c for c in ready.columns if c != self.id_col]
        ready = ready.select(col(self.id_col), array_to_vector(F.array(*cols)).alias("features"))
        arr = vector_to_array(F.col(self.stage_output))
        return self.stages.transform(ready).select(
            col(self.id_col),
            *[F.get(arr, F.lit(i)).alias(f"f_{i}") for i in range(self.stage_size)],
        )

    def to_dict(self) -> dict:
        plain = {k: v for k, v in self.__dict__.items() if k not in ("stages", "dictionary")}
        return dict(plain, has_stages=self.stages is not None)

    @classmethod
    def from_dict(cls, d: dict, stages: PipelineModel | None = None, dictionary: DataFrame | None = None) -> "FeatureSpec":
        d = {k: v for k, v in d.items() if k != "has_stages"}
        return cls(**d, stages=stages, dictionary=dictionary)


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``column, value, n`` of several columns in one scan, nulls left out."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in cols])
    )
    return (
        df.select(pairs.alias("p"))
        .select("p.column", "p.value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _categories(df: DataFrame, cols: list[str], narrow: int):
    """Per column: sorted values (of narrow columns), most frequent value (smallest on ties), and the number of values of wide ones.

    Also the counted values of all columns as a table.
    """
    if not cols:
        return {}, {}, {}, None
    counts = cut(value_counts(df, cols))
    per_col = (
        counts.groupBy("column")
        .agg(
            F.min(F.struct(-F.col("n"), F.col("value")))["value"].alias("mode"),
            F.count(F.lit(1)).alias("n_values"),
        )
        .collect()
    )
    modes = {r["column"]: r["mode"] for r in per_col}
    wide = {c: r["n_values"] for c in cols for r in per_col if r["column"] == c and r["n_values"] > narrow}
    values: dict[str, list[str]] = {c: [] for c in modes if c not in wide}
    if values:
        # at most ``narrow`` rows a column
        for r in counts.filter(F.col("column").isin(list(values))).collect():
            values[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in values.items()}, modes, wide, counts


def number_values(counts: DataFrame, cols: list[str]) -> DataFrame:
    """``column, value, n, code``: the values of ``cols`` numbered from 0 in their order, column by column."""
    placed = cut(number_rows(counts.filter(F.col("column").isin(cols)), [F.col("column"), F.col("value")], "_pos"))
    # a row for each column
    first = placed.groupBy("column").agg(F.min("_pos").alias("_first"))
    return placed.join(F.broadcast(first), "column").select("column", "value", "n", (F.col("_pos") - F.col("_first")).alias("code"))


def _dictionary(df: DataFrame, counts: DataFrame, wide: dict, modes: dict, scaler: str) -> DataFrame:
    """``number_values`` with ``base`` and ``delta`` of each value: its one-hot feature in other rows, and what its own rows add.

    The scaler's values of a 0/1 column follow from its count, gaps filled.
    """
    total = df.count()
    known = counts.filter(F.col("column").isin(list(wide))).groupBy("column").agg(F.sum("n").alias("_known"))
    mode = F.lit(None).cast("string")
    for c in wide:
        mode = F.when(F.col("column") == c, F.lit(modes[c])).otherwise(mode)
    rows = number_values(counts, list(wide)).join(F.broadcast(known), "column")
    rows = rows.withColumn("n", F.col("n") + F.when(F.col("value") == mode, F.lit(total) - F.col("_known")).otherwise(0)).drop("_known")
    p, n0 = F.col("n") / F.lit(float(total)), F.lit(total) - F.col("n")
    one, zero = F.lit(1.0), F.lit(0.0)
    if scaler == "standard":
        centre, width = p, F.sqrt(p * (1 - p))
    elif scaler == "minmax":
        centre = F.when(n0 == 0, one).otherwise(zero)
        width = one - centre
    elif scaler == "robust":
        def at(q):
            """Interpolated quantile of n0 zeros followed by ones."""
            return F.least(F.greatest(F.lit(q * (total - 1)) - (n0 - 1), zero), one)
        centre, width = at(0.5), at(0.75) - at(0.25)
    else:
        centre, width = zero, one
    width = F.when(width == 0, one).otherwise(width)
    return cut(rows.select("column", "value", "n", "code", (-centre / width + 0.0).alias("base"), (1 / width).alias("delta")))


def fit_features(
    df: DataFrame,
    id_col: str,
    cols: list[str] | None = None,
    scaler: str | None = "standard",
    cat_encoder: str = "ohe",
    extra_stages: list | None = None,
    narrow: int = NARROW,
    approx: bool = False,
) -> FeatureSpec:
    """Learn how to turn ``cols`` of ``df`` into the processed matrix.

    A category column with more than ``narrow`` values is handled through a dictionary table.
    With ``approx`` medians and quartiles come from sketches, in one scan each.
    """
    require_table(df)
    scaler, encoder = scaler_name(scaler), encoder_name(cat_encoder)
    names = check_columns(df, id_col, cols)
    roles = {c: role_of(df.schema[c].dataType) for c in names}
    bad = {c: df.schema[c].dataType.simpleString() for c in names if roles[c] == UNUSABLE}
    if bad:
        raise ValueError(f"columns of these types cannot be features, cast them first: {bad}")
    numeric = [c for c in names if roles[c] == NUMERIC]
    categorical = [c for c in names if roles[c] == CATEGORICAL]
    vectors = [c for c in names if roles[c] == VECTOR]

    sizes = {}
    if vectors:
        row = df.agg(
            *[F.min(F.size(col(c))).alias(f"a{i}") for i, c in enumerate(vectors)],
            *[F.max(F.size(col(c))).alias(f"b{i}") for i, c in enumerate(vectors)],
            *[F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(vectors)],
        ).first()
        for i, c in enumerate(vectors):
            if row[f"m{i}"] or row[f"a{i}"] != row[f"b{i}"] or not row[f"a{i}"]:
                raise ValueError(f"the arrays of {c!r} do not all have one length")
            sizes[c] = row[f"a{i}"]

    cells = [number(c) for c in numeric]
    cells += [number(c, k) for c in vectors for k in range(sizes[c])]
    flat = df.selectExpr(*[f"{x} AS v{i}" for i, x in enumerate(cells)])
    at = [f"v{i}" for i in range(len(cells))]
    counts = {}
    if at:
        row = flat.agg(*[F.expr(f"count({v}) AS {v}") for v in at]).first()
        counts = {v: row[v] for v in at}
    quantiles = approx_quantiles if approx else exact_quantiles
    medians_at = quantiles(flat, at, [0.5], counts)
    medians, dropped = {}, []
    for i, c in enumerate(numeric):
        if counts[f"v{i}"]:
            medians[c] = medians_at[f"v{i}"][0]
        else:
            dropped.append(c)
    vector_medians, i = {}, len(numeric)
    for c in vectors:
        vector_medians[c] = [medians_at[f"v{i + k}"][0] or 0.0 for k in range(sizes[c])]
        i += sizes[c]
    categories, modes, wide, counted = _categories(df, categorical, narrow)
    dropped += [c for c in categorical if c not in modes]
    numeric = [c for c in numeric if c in medians]
    categorical = [c for c in categorical if c in modes]
    if not (numeric or categorical or vectors):
        raise ValueError("every chosen column is empty")

    out_names = list(numeric) + [f"{c}_{k}" for c in vectors for k in range(sizes[c])]
    for c in categorical:
        if encoder != "ohe":
            out_names.append(c)
        elif c not in wide:
            out_names += [f"{c}_{v}" for v in categories[c]]
    if extra_stages and wide and encoder == "ohe":
        raise ValueError(f"extra stages need dense features; encode {list(wide)} as ordinal")
    dictionary = _dictionary(df, counted, wide, modes, scaler) if wide else None
    base = FeatureSpec(
        id_col, numeric, categorical, sizes, dropped, medians, vector_medians, modes,
        categories, encoder, scaler, out_names, n_original=len(names), wide=wide, dictionary=dictionary,
    )
    centre, width = _scaler_values(df, base, quantiles)
    spec = FeatureSpec(**{**base.__dict__, "centre": centre, "width": width})
    return _with_stages(df, spec, extra_stages) if extra_stages else spec


def _scaler_values(df: DataFrame, spec: FeatureSpec, quantiles=exact_quantiles) -> tuple[list[float], list[float]]:
    cols = spec.f_cols
    if spec.scaler == "none" or not cols:
        return [], []
    enc = spec.numbered(df).select(*[e.alias(c) for e, c in zip(spec.encoded(), cols)])
    if spec.scaler == "robust":
        qs = quantiles(enc, cols, [0.25, 0.5, 0.75])
        centre = [qs[c][1] for c in cols]
        width = [qs[c][2] - qs[c][0] for c in cols]
    elif spec.scaler == "standard":
        row = enc.agg(
            *[F.expr(f"avg({c}) AS a{i}") for i, c in enumerate(cols)],
            *[F.expr(f"stddev_pop({c}) AS b{i}") for i, c in enumerate(cols)],
        ).first()
        centre = [row[f"a{i}"] for i in range(len(cols))]
        width = [row[f"b{i}"] for i in range(len(cols))]
    else:
        row = enc.agg(
            *[F.expr(f"min({c}) AS a{i}") for i, c in enumerate(cols)],
            *[F.expr(f"max({c}) AS b{i}") for i, c in enumerate(cols)],
        ).first()
        centre = [row[f"a{i}"] for i in range(len(cols))]
        width = [row[f"b{i}"] - row[f"a{i}"] for i in range(len(cols))]
    return centre, [w if w else 1.0 for w in width]


def _with_stages(df: DataFrame, spec: FeatureSpec, stages: list) -> FeatureSpec:
    """Fit pyspark.ml stages that go from the ``features`` column onwards."""
    cols = spec.f_cols
    ready = spec.numbered(df).select(*spec.processed("f_")).select(array_to_vector(F.array(*cols)).alias("features"))
    model = Pipeline(stages=stages).fit(ready)
    output = model.stages[-1].getOutputCol()
    size = model.transform(ready).select(F.size(vector_to_array(F.col(output)))).first()[0]
    prefix = "pc" if isinstance(model.stages[-1], PCAModel) else output + "_"
    names = [f"{prefix}{i + 1}" for i in range(size)]
    return FeatureSpec(
        **{**spec.__dict__, "names": names, "stages": model,
           "stage_output": output, "stage_size": size}
    )


# Single steps, for use outside a full fit


def impute_median(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Fill missing numbers with the exact median, or a sketch's; all-missing columns go."""
    flat = df.selectExpr(*[f"{number(c)} AS v{i}" for i, c in enumerate(cols)])
    found = (approx_quantiles if approx else exact_quantiles)(flat, [f"v{i}" for i in range(len(cols))], [0.5])
    med = {c: found[f"v{i}"][0] for i, c in enumerate(cols)}
    return df.select(
        *[
            F.expr(f"coalesce({number(c)}, {num(med[c])})").alias(c) if c in med else col(c)
            for c in df.columns
            if c not in med or med[c] is not None
        ]
    )


def impute_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill missing categories with the most frequent one."""
    per_col = (
        value_counts(df, cols)
        .groupBy("column")
        .agg(F.min(F.struct(-F.col("n"), F.col("value")))["value"].alias("mode"))
        .collect()
    )
    modes = {r["column"]: r["mode"] for r in per_col}
    return df.select(
        *[
            F.coalesce(text(c), F.lit(modes[c])).alias(c) if c in modes else col(c)
            for c in df.columns
            if c not in cols or c in modes
        ]
    )


def encode(df: DataFrame, cols: list[str], encoder: str, fit_on: DataFrame | None = None, narrow: int = NARROW) -> DataFrame:
    """Replace ``cols`` by one-hot or ordinal columns learnt from ``fit_on``; an unknown value is all 0, or -1.

    One-hot columns exist for columns of up to ``narrow`` values; use ``onehot_long`` beyond. Ordinal
    codes of more values come from a joined table.
    """
    encoder = encoder_name(encoder)
    values, _, wide, counts = _categories(df if fit_on is None else fit_on, cols, narrow)
    if wide and encoder == "ohe":
        raise ValueError(f"{list(wide)} would give more than {narrow} columns each; onehot_long returns them as rows")
    if wide:
        numbered = cut(number_values(counts, list(wide)))
    out = [col(c) for c in df.columns if c not in cols]
    for i, c in enumerate(cols):
        known = values.get(c, [])
        if c in wide:
            codes = numbered.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"_code_{i}"), F.col("n").alias("_n"))
            df = attach(df.withColumn("_value", text(c)), codes, ["_value"], "_n", "left", small_rows=wide[c]).drop("_value", "_n")
            out.append(F.coalesce(f"_code_{i}", F.lit(-1)).cast("double").alias(c))
        elif encoder == "ohe":
            out += [F.when(text(c) == v, 1.0).otherwise(0.0).alias(f"{c}_{v}") for v in known]
        else:
            arr = F.array(*[F.lit(v) for v in known])
            out.append((F.coalesce(F.array_position(arr, text(c)), F.lit(0)) - 1).cast("double").alias(c))
    return df.select(*out)


def onehot_long(df: DataFrame, id_col: str, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """``id, index, value`` of the ones of the one-hot encoded ``cols``, whatever their number of values.

    The values of each column are numbered in order, those of the first column first. Nulls and
    values that ``fit_on`` lacks have no row.
    """
    fit_on = df if fit_on is None else fit_on
    counts = cut(value_counts(fit_on, cols))
    # the columns in the order given
    name = F.coalesce(*[F.when(F.col("column") == c, F.lit(f"{i:06d}")) for i, c in enumerate(cols)])
    placed = number_rows(counts.withColumn("_at", name), [F.col("_at"), F.col("value")], "index")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in cols])
    long = df.select(col(id_col), F.inline(pairs))
    found = attach(long, placed.select("column", "value", "index", "n"), ["column", "value"], "n")
    return found.select(col(id_col), "index", F.lit(1.0).alias("value"))


def encode_onehot(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    return encode(df, cols, "ohe", fit_on)


def encode_ordinal(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    return encode(df, cols, "ordinal", fit_on)


def scale(df: DataFrame, id_col: str, cols: list[str], scaler: str | None) -> DataFrame:
    """Scale numeric columns in place."""
    spec = fit_features(df, id_col, cols, scaler)
    out = spec.transform(df)
    return out.select(col(id_col), *[F.col(f).alias(c) for f, c in zip(spec.f_cols, spec.names)])


def feature_names(spec: FeatureSpec) -> list[str]:
    return list(spec.names)
