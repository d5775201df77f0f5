import datetime

import pytest

from spindrift.functions.quantiles import exact_quantiles
from spindrift.operators import features as feat
from spindrift.sources.tables import column_roles, select_features


def test_median_is_interpolated_and_scalers_match(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 4.0, 5.0), (4, 10.0, 5.0), (5, None, 5.0)], "id int, a double, c double")
    spec = feat.fit_features(df, "id", ["a", "c"], "none")
    assert spec.medians == {"a": 3.0, "c": 5.0}
    four = df.filter("a IS NOT NULL")
    spec = feat.fit_features(four, "id", scaler="standard")
    assert spec.width[0] == pytest.approx(3.491060, abs=1e-5) and spec.width[1] == 1.0
    spec = feat.fit_features(four, "id", scaler="robust")
    assert spec.centre[0] == 3.0 and spec.width[0] == pytest.approx(5.5 - 1.75)
    for scaler in ("standard", "minmax", "robust"):
        out = feat.scale(four, "id", ["a", "c"], scaler)
        assert {r["c"] for r in out.collect()} == {0.0}


def test_missing_values_and_empty_columns(spark):
    rows = [(1, 1.0, None, "b", None), (2, float("nan"), None, "b", None), (3, None, None, "a", None), (4, 3.0, None, "a", None), (5, 2.0, None, None, None)]
    df = spark.createDataFrame(rows, "id int, x double, gone double, s string, none string")
    spec = feat.fit_features(df, "id", scaler=None)
    assert spec.dropped == ["gone", "none"]
    assert spec.medians["x"] == 2.0 and spec.modes["s"] == "a"
    assert spec.names == ["x", "s_a", "s_b"]
    got = {r["id"]: tuple(r)[1:] for r in spec.transform(df).collect()}
    assert got[2] == (2.0, 0.0, 1.0) and got[5] == (2.0, 1.0, 0.0)
    assert feat.impute_mode(df, ["s", "none"]).columns == ["id", "x", "gone", "s"]


def test_unknown_categories(spark):
    fit = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    new = spark.createDataFrame([(3, "b"), (4, "z")], "id int, s string")
    ohe = feat.fit_features(fit, "id", scaler="none").transform(new)
    assert sorted(map(tuple, ohe.collect())) == [(3, 0.0, 1.0), (4, 0.0, 0.0)]
    ordinal = feat.fit_features(fit, "id", scaler="none", cat_encoder="ord_label").transform(new)
    assert sorted(map(tuple, ordinal.collect())) == [(3, 1.0), (4, -1.0)]


def test_roles_and_refused_types(spark):
    df = spark.createDataFrame([(1, True, datetime.datetime(2020, 1, 1), [1.0, 2.0])], "id int, b boolean, t timestamp, v array<double>")
    roles = {r["column"]: r["role"] for r in column_roles(df).collect()}
    assert roles == {"id": "numeric", "b": "categorical", "t": "unusable", "v": "vector"}
    with pytest.raises(ValueError):
        feat.fit_features(df, "id")
    assert feat.fit_features(df, "id", ["b", "v"], "none").names == ["v_0", "v_1", "b_true"]


@pytest.mark.parametrize("cols", ["a", [], ["a", "a"], ["zzz"], [1], [" "], ["id"]])
def test_bad_columns(spark, cols):
    df = spark.createDataFrame([(1, 2.0)], "id int, a double")
    with pytest.raises(ValueError):
        select_features(df, "id", cols)


def test_error_contract(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, a double")
    with pytest.raises(TypeError):
        feat.fit_features("no table", "id")
    with pytest.raises(ValueError):
        feat.fit_features(df.limit(0), "id")
    with pytest.raises(ValueError):
        feat.fit_features(df, "id", scaler="bogus")
    with pytest.raises(ValueError):
        feat.fit_features(df, "id", cat_encoder="bogus")


def test_sketched_quantiles_are_exact(spark):
    df = spark.range(20_000).selectExpr("CAST(pmod(id * 7919, 20000) AS DOUBLE) AS a", "CAST(pmod(id, 3) AS DOUBLE) AS b",
                                        "exp(id / 1000.0) AS c")
    want = exact_quantiles(df, ["a", "b", "c"], [0.0, 0.25, 0.5, 0.333, 1.0])
    got = exact_quantiles(df, ["a", "b", "c"], [0.0, 0.25, 0.5, 0.333, 1.0], direct_rows=100, accuracy=50)
    for c in want:
        assert got[c] == pytest.approx(want[c], rel=1e-12)
