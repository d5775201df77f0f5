"""The registered queries and the SQL that says what each must return."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import agglomerative as agg
from .operators import dbscan as db
from .operators import diagnostics as diag
from .operators import evaluate as ev
from .operators import features as feat
from .operators import kmeans as km
from .operators import pairs as ap
from .operators import tables as tab
from .operators.dendrogram import dendrogram
from .operators.models import cluster, parameter_choices
from .operators.result import LABEL, given_labels
from .plans.cut import ensure_checkpoint_dir
from .sources import store
from .sources.tables import column_roles as roles_of
from .sources.tables import load_table, select_features

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, without negative zero."""
    return df.select(
        *[
            (F.round(feat.col(f.name), digits) + 0.0).alias(f.name) if f.dataType.typeName() == "double" else feat.col(f.name)
            for f in df.schema.fields
        ]
    )


def R(x: str, digits: int = 6) -> str:
    return f"round({x}, {digits}) + 0.0"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/saved-{uuid.uuid4().hex}"


# -- fixtures, the same expressions on both sides ---------------------------

GAPS = [
    "c_custkey AS id",
    "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS acctbal",
    "CAST(c_nationkey AS DOUBLE) AS nationkey",
    "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS segment",
]
GAPS_SQL = f"g AS (SELECT {', '.join(GAPS)} FROM customer)"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NATIONS = (
    "SELECT n_nationkey AS id, count(*) * 1.0 AS n_customers, avg(c_acctbal) AS avg_acctbal "
    "FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey"
)
CENTRES = [[-1.0, -1.0], [0.0, 1.0], [1.0, 0.0]]
ROUNDS = 5


def gaps(spark, sf):
    return read(spark, sf, "customer").selectExpr(*GAPS)


def nations(spark, sf):
    c = read(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("id")).agg(
        (F.count(F.lit(1)) * 1.0).cast("double").alias("n_customers"), F.avg("c_acctbal").alias("avg_acctbal")
    )
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("id"))
    return n.join(c, "id")


def scaled_sql(table: str, key: str, cols: list[str]) -> str:
    stats = ", ".join(f"avg({c}) AS a{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(cols))
    vals = ", ".join(f"({c} - a{i}) / s{i} AS f_{i}" for i, c in enumerate(cols))
    return f"f AS (SELECT {key} AS id, {vals} FROM {table}, (SELECT {stats} FROM {table}))"


def dist(a: str, b: str, dims: int, metric: str = "euclidean") -> str:
    if metric == "manhattan":
        return " + ".join(f"abs({a}.f_{i} - {b}.f_{i})" for i in range(dims))
    if metric == "cosine":
        def dot(p, q):
            return "(" + " + ".join(f"{p}.f_{i} * {q}.f_{i}" for i in range(dims)) + ")"
        return f"1 - {dot(a, b)} / sqrt({dot(a, a)} * {dot(b, b)})"
    return "sqrt(" + " + ".join(f"({a}.f_{i} - {b}.f_{i}) * ({a}.f_{i} - {b}.f_{i})" for i in range(dims)) + ")"


# -- sources and feature preparation ----------------------------------------


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def load_and_select(spark, sf):
    return select_features(read(spark, sf, "orders"), "o_orderkey", [" o_totalprice ", "o_orderpriority", ""])


@query(f"""WITH {GAPS_SQL} SELECT id, {R("coalesce(acctbal, (SELECT median(acctbal) FROM g))")} AS acctbal FROM g""")
def impute_median(spark, sf):
    return rounded(feat.impute_median(gaps(spark, sf).select("id", "acctbal"), ["acctbal"]))


@query(f"""WITH {GAPS_SQL}, m AS (SELECT segment FROM g WHERE segment IS NOT NULL GROUP BY segment
ORDER BY count(*) DESC, segment LIMIT 1)
SELECT id, coalesce(segment, (SELECT segment FROM m)) AS segment FROM g""")
def impute_mode(spark, sf):
    return feat.impute_mode(gaps(spark, sf).select("id", "segment"), ["segment"])


@query("SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"c_mktsegment_{v}\"" for v in SEGMENTS
) + " FROM customer")
def encode_onehot(spark, sf):
    return feat.encode_onehot(read(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query("""WITH v AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code
FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= 40 AND p_type <> 'ECONOMY'))
SELECT p_partkey, coalesce(code, -1)::DOUBLE AS p_type FROM part LEFT JOIN v USING (p_type)""")
def encode_ordinal_unseen(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    known = p.filter("p_size <= 40 AND p_type <> 'ECONOMY'")
    return feat.encode_ordinal(p.drop("p_size"), ["p_type"], fit_on=known)


def _scaled(spark, sf, scaler):
    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(feat.scale(p, "p_partkey", ["p_size", "p_retailprice"], scaler))


def _scale_sql(centre: str, width: str) -> str:
    cols = ["p_size", "p_retailprice"]
    stats = ", ".join(f"{centre.format(c)} AS c{i}, {width.format(c)} AS w{i}" for i, c in enumerate(cols))
    return "SELECT p_partkey, " + ", ".join(
        R(f"({c} - c{i}) / w{i}") + f" AS {c}" for i, c in enumerate(cols)
    ) + f" FROM part, (SELECT {stats} FROM part)"


@query(_scale_sql("avg({})", "stddev_pop({})"))
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query(_scale_sql("min({})", "(max({0}) - min({0}))::DOUBLE"))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query(_scale_sql("quantile_cont({}, 0.5)", "(quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25))"))
def scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query(_scale_sql("0 * min({})", "1.0::DOUBLE + 0 * min({})"))
def scale_none(spark, sf):
    return _scaled(spark, sf, None)


_FULL = ["acctbal", "nationkey"] + [f"segment_{v}" for v in SEGMENTS]


@query(f"""WITH {GAPS_SQL}, m AS (SELECT segment FROM g WHERE segment IS NOT NULL GROUP BY segment
ORDER BY count(*) DESC, segment LIMIT 1),
e AS (SELECT id, coalesce(acctbal, (SELECT median(acctbal) FROM g)) AS acctbal, nationkey,
{", ".join(f"CASE WHEN coalesce(segment, (SELECT segment FROM m)) = '{v}' THEN 1.0 ELSE 0.0 END AS segment_{v}" for v in SEGMENTS)} FROM g),
s AS (SELECT {", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in _FULL)} FROM e)
SELECT id, {", ".join(R(f"({c} - a_{c}) / s_{c}") + f" AS {c}" for c in _FULL)} FROM e, s""")
def fit_and_transform(spark, sf):
    g = gaps(spark, sf)
    spec = feat.fit_features(g, "id")
    out = spec.transform(g)
    return rounded(out.select("id", *[F.col(f).alias(n) for f, n in zip(spec.f_cols, spec.names)]))


@query()
def pca_stage(spark, sf):
    from pyspark.ml.feature import PCA

    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    spec = feat.fit_features(p, "p_partkey", extra_stages=[PCA(k=2, inputCol="features", outputCol="reduced")])
    return spec.transform(p)


# -- categories of many values -----------------------------------------------


def keyed_orders(spark, sf):
    """Orders whose key is a category: as many values as rows."""
    return read(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_orderkey AS STRING) AS key_text")


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey::VARCHAR) - 1 AS index, 1.0::DOUBLE AS value FROM orders""")
def onehot_many_values(spark, sf):
    return feat.onehot_long(keyed_orders(spark, sf), "o_orderkey", ["key_text"])


@query("""SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey::VARCHAR) - 1)::DOUBLE AS key_text FROM orders""")
def ordinal_many_values(spark, sf):
    return feat.encode_ordinal(keyed_orders(spark, sf), ["key_text"])


@query("""WITH known AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT o_custkey::VARCHAR AS v FROM orders WHERE o_orderkey % 3 = 0))
SELECT o_orderkey, coalesce(code, -1)::DOUBLE AS cust FROM orders LEFT JOIN known ON v = o_custkey::VARCHAR""")
def ordinal_many_unseen(spark, sf):
    o = read(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_custkey AS STRING) AS cust")
    return feat.encode_ordinal(o, ["cust"], fit_on=o.filter("o_orderkey % 3 = 0"))


CUSTOMERS = [
    "o_orderkey AS id", "CAST(o_totalprice AS DOUBLE) AS price",
    "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR(20)) END AS cust",
]
CUSTOMERS_SQL = f"""o0 AS (SELECT {", ".join(CUSTOMERS)} FROM orders),
o AS MATERIALIZED (SELECT id, price, coalesce(cust, (SELECT cust FROM o0 WHERE cust IS NOT NULL GROUP BY cust ORDER BY count(*) DESC, cust LIMIT 1)) AS cust FROM o0),
p AS (SELECT cust, count(*) / (SELECT count(*) FROM o) AS p, row_number() OVER (ORDER BY cust) - 1 AS code FROM o GROUP BY cust),
f AS MATERIALIZED (SELECT id, (price - a) / s AS x, cust, code, p, 1 / sqrt(p * (1 - p)) AS v
FROM o JOIN p USING (cust), (SELECT avg(price) AS a, stddev_pop(price) AS s FROM o))"""


def customer_orders(spark, sf):
    return read(spark, sf, "orders").selectExpr(*CUSTOMERS)


@query(f"""WITH {CUSTOMERS_SQL} SELECT id, 0::BIGINT AS index, {R("x")} AS value FROM f
UNION ALL SELECT id, 1 + code, {R("(1 - p) / sqrt(p * (1 - p))")} FROM f""")
def onehot_many_scaled(spark, sf):
    o = customer_orders(spark, sf)
    return rounded(feat.fit_features(o, "id").transform_long(o))


@query(f"""WITH {CUSTOMERS_SQL} SELECT id, {R("x")} AS price, {R("(code - (SELECT avg(code) FROM f)) / (SELECT stddev_pop(code) FROM f)")} AS cust FROM f""")
def ordinal_many_scaled(spark, sf):
    o = customer_orders(spark, sf)
    spec = feat.fit_features(o, "id", cat_encoder="ordinal")
    return rounded(spec.transform(o).select("id", *[F.col(f).alias(n) for f, n in zip(spec.f_cols, spec.names)]))


WIDE_ROUNDS = 3


def wide_kmeans(spark, sf):
    o = customer_orders(spark, sf)
    first = [r["id"] for r in o.orderBy("id").select("id").limit(3).collect()]
    return km.kmeans(o, "id", n_clusters=3, init=first, max_iter=WIDE_ROUNDS, tol=0.0)


def _wide_sql() -> str:
    ctes = [CUSTOMERS_SQL, "r AS MATERIALIZED (SELECT row_number() OVER (ORDER BY id) - 1 AS c, * FROM f QUALIFY c < 3)",
            "d0 AS MATERIALIZED (SELECT c, x AS m FROM r)", "v0 AS MATERIALIZED (SELECT c, cust, v AS val FROM r)"]
    for t in range(WIDE_ROUNDS + 1):
        ctes += [
            f"q{t} AS MATERIALIZED (SELECT c, sum(val * val) AS sq FROM v{t} GROUP BY c)",
            f"g{t} AS (SELECT f.id, f.x, f.cust, f.v, d{t}.c, (f.x - m)**2 + f.v * f.v - 2 * f.v * coalesce(val, 0) + sq AS d2 "
            f"FROM f CROSS JOIN d{t} JOIN q{t} USING (c) LEFT JOIN v{t} ON v{t}.c = d{t}.c AND v{t}.cust = f.cust)",
            f"l{t} AS MATERIALIZED (SELECT id, x, cust, v, arg_min(c, d2) AS c, min(d2) AS d2 FROM g{t} GROUP BY id, x, cust, v)",
            f"n{t} AS (SELECT c, count(*) AS n FROM l{t} GROUP BY c)",
            f"d{t + 1} AS MATERIALIZED (SELECT c, avg(x) AS m FROM l{t} GROUP BY c)",
            f"v{t + 1} AS MATERIALIZED (SELECT c, cust, sum(v) / any_value(n) AS val FROM l{t} JOIN n{t} USING (c) GROUP BY c, cust)",
        ]
    return "WITH " + ", ".join(ctes)


@query(f"{_wide_sql()} SELECT id, c::INTEGER AS cluster_label FROM l{WIDE_ROUNDS}")
def kmeans_many_values(spark, sf):
    return wide_kmeans(spark, sf).labels


@query(f"{_wide_sql()} SELECT id, c::INTEGER AS cluster_label FROM l{WIDE_ROUNDS}")
def save_and_load_many_values(spark, sf):
    fitted = wide_kmeans(spark, sf)
    return store.load_model(spark, store.save_model(fitted, scratch(spark)), fitted.source).labels


@query(f"""{_wide_sql()}, w AS MATERIALIZED (SELECT id, c, x, cust, v, (x - m)**2 + v * v - 2 * v * val + (SELECT sum(val * val) FROM v{WIDE_ROUNDS + 1} z WHERE z.c = l.c) AS d2
    FROM l{WIDE_ROUNDS} l JOIN d{WIDE_ROUNDS + 1} USING (c) JOIN v{WIDE_ROUNDS + 1} USING (c, cust)),
cen AS (SELECT c, count(*) AS n, avg(sqrt(greatest(d2, 0))) AS s, sum(d2) AS w FROM w GROUP BY c),
whole AS (SELECT cust, sum(v) / (SELECT count(*) FROM w) AS val FROM w GROUP BY cust),
between_ AS (SELECT sum((v - coalesce(val, 0))**2 * n) AS b FROM (SELECT k.c, whole.cust, coalesce(z.val, 0) AS v, whole.val AS val, k.n
    FROM cen k CROSS JOIN whole LEFT JOIN v{WIDE_ROUNDS + 1} z ON z.c = k.c AND z.cust = whole.cust)),
dense AS (SELECT sum(n * (m - (SELECT avg(x) FROM w))**2) AS b FROM cen JOIN d{WIDE_ROUNDS + 1} USING (c)),
gap AS (SELECT a.c AS a, b.c AS b, sqrt((da.m - db.m)**2 + (SELECT sum((coalesce(x.val, 0) - coalesce(y.val, 0))**2) FROM (SELECT * FROM v{WIDE_ROUNDS + 1} WHERE c = a.c) x
    FULL JOIN (SELECT * FROM v{WIDE_ROUNDS + 1} WHERE c = b.c) y USING (cust))) AS d
    FROM cen a JOIN cen b ON a.c <> b.c JOIN d{WIDE_ROUNDS + 1} da ON da.c = a.c JOIN d{WIDE_ROUNDS + 1} db ON db.c = b.c),
worst AS (SELECT gap.a, max((ka.s + kb.s) / d) AS r FROM gap JOIN cen ka ON ka.c = gap.a JOIN cen kb ON kb.c = gap.b GROUP BY gap.a)
SELECT (SELECT count(*) FROM w) AS n_samples, 2::BIGINT AS n_original_features, (SELECT 1 + count(*) FROM p) AS n_features_after_transform,
(SELECT count(*) FROM cen) AS n_clusters_found, round((between_.b + dense.b) * ((SELECT count(*) FROM w) - (SELECT count(*) FROM cen)) / ((SELECT sum(w) FROM cen) * ((SELECT count(*) FROM cen) - 1)), 4) AS calinski_harabasz_score,
(SELECT round(avg(r), 4) FROM worst) AS davies_bouldin_score, (SELECT round(sum(d2), 2) FROM l{WIDE_ROUNDS}) AS inertia FROM between_, dense""")
def evaluate_many_values(spark, sf):
    found = ev.evaluate(wide_kmeans(spark, sf))
    return found.select(
        "n_samples", "n_original_features", "n_features_after_transform", "n_clusters_found",
        F.round("calinski_harabasz_score", 4).alias("calinski_harabasz_score"), F.round("davies_bouldin_score", 4).alias("davies_bouldin_score"),
        F.round("inertia", 2).alias("inertia"),
    )


# -- KMeans and the result tables -------------------------------------------


def fixed_kmeans(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    spec = feat.fit_features(c, "c_custkey", ["c_acctbal", "c_nationkey"])
    return km.kmeans(c, "c_custkey", n_clusters=3, init=CENTRES, max_iter=ROUNDS, tol=0.0, spec=spec)


def _fixed_sql() -> str:
    ctes = [scaled_sql("customer", "c_custkey", ["c_acctbal", "c_nationkey"])]
    rows = " UNION ALL ".join(f"SELECT {i} AS c, {x}::DOUBLE AS m_0, {y}::DOUBLE AS m_1" for i, (x, y) in enumerate(CENTRES))
    ctes.append(f"k0 AS ({rows})")
    for t in range(ROUNDS + 1):
        ctes.append(
            f"l{t} AS MATERIALIZED (SELECT f.id, f_0, f_1, arg_min(c, (f_0 - m_0)**2 + (f_1 - m_1)**2) AS c, "
            f"min((f_0 - m_0)**2 + (f_1 - m_1)**2) AS d2 FROM f, k{t} GROUP BY f.id, f_0, f_1)"
        )
        ctes.append(f"k{t + 1} AS MATERIALIZED (SELECT c, avg(f_0) AS m_0, avg(f_1) AS m_1 FROM l{t} GROUP BY c)")
    return "WITH " + ", ".join(ctes) + f", lab AS (SELECT id AS c_custkey, c::INTEGER AS cluster_label, f_0, f_1, d2 FROM l{ROUNDS})"


FIXED = _fixed_sql()


@query(f"{FIXED} SELECT c_custkey, cluster_label FROM lab")
def kmeans_fixed_labels(spark, sf):
    return fixed_kmeans(spark, sf).labels


@query(f"{FIXED} SELECT c::INTEGER AS cluster_label, {R('m_0')} AS f_0, {R('m_1')} AS f_1, "
       f"(SELECT round(sum(d2), 4) FROM lab) AS inertia FROM k{ROUNDS}")
def kmeans_fixed_centres(spark, sf):
    r = fixed_kmeans(spark, sf)
    return rounded(r.centre_table()).withColumn("inertia", F.round(F.lit(r.inertia), 4))


@query(f"{FIXED} SELECT cluster_label, count(*) AS count, {R('count(*) / sum(count(*)) OVER ()')} AS ratio FROM lab GROUP BY 1")
def cluster_sizes(spark, sf):
    return rounded(tab.cluster_sizes(fixed_kmeans(spark, sf)))


@query(f"{FIXED} SELECT cluster_label::VARCHAR AS cluster_label, count(*) AS count FROM lab GROUP BY 1")
def size_bars(spark, sf):
    return tab.size_bars(fixed_kmeans(spark, sf))


@query(f"{FIXED} SELECT cluster_label, {R('avg(c_acctbal)', 4)} AS c_acctbal, {R('avg(c_nationkey)', 4)} AS c_nationkey "
       "FROM lab JOIN customer USING (c_custkey) GROUP BY 1")
def cluster_profile(spark, sf):
    return rounded(tab.cluster_profile(fixed_kmeans(spark, sf)), 4)


@query(f"{FIXED} SELECT cluster_label, feature, {R('mean', 4)} AS mean FROM (SELECT cluster_label, avg(c_acctbal) AS c_acctbal, "
       "avg(c_nationkey) AS c_nationkey FROM lab JOIN customer USING (c_custkey) GROUP BY 1) "
       "UNPIVOT (mean FOR feature IN (c_acctbal, c_nationkey))")
def profile_heatmap(spark, sf):
    return rounded(tab.profile_heatmap_data(fixed_kmeans(spark, sf)), 4)


@query(f"{FIXED} SELECT c_custkey, c_acctbal, c_nationkey, cluster_label FROM lab JOIN customer USING (c_custkey)")
def labelled_data(spark, sf):
    return tab.labelled_data(fixed_kmeans(spark, sf))


_PREVIEW = ", ".join(f"max(CASE WHEN i = {i} THEN v END) AS r{i}" for i in range(10))


@query(f"{FIXED}, p AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS i, c_custkey::VARCHAR AS a, cluster_label::VARCHAR AS b "
       f"FROM (SELECT * FROM lab ORDER BY c_custkey LIMIT 10)) SELECT field, {_PREVIEW} FROM "
       "(SELECT 'index' AS field, i, a AS v FROM p UNION ALL SELECT 'cluster_label', i, b FROM p) GROUP BY field")
def label_preview(spark, sf):
    return tab.label_preview(fixed_kmeans(spark, sf))


@query(f"{FIXED} SELECT c_custkey, {R('f_0')} AS x, {R('f_1')} AS y, cluster_label FROM lab")
def scatter_data(spark, sf):
    return rounded(diag.scatter_data(fixed_kmeans(spark, sf), "c_acctbal", "c_nationkey"))


@query(f"{FIXED} SELECT c_custkey, {R('f_0')} AS pc1, {R('f_1')} AS pc2, cluster_label FROM lab")
def pca_direct_view(spark, sf):
    return rounded(diag.pca_projection(fixed_kmeans(spark, sf), 2))


@query()
def pca_projection(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    return diag.pca_projection(km.kmeans(p, "p_partkey", n_clusters=3, init=[[0.0] * 8, [1.0] * 8, [-1.0] * 8]), 3)


@query(f"{FIXED} SELECT c_custkey, cluster_label FROM lab")
def save_and_load(spark, sf):
    fitted = fixed_kmeans(spark, sf)
    path = store.save_model(fitted, scratch(spark))
    return store.load_model(spark, path, fitted.source).labels


_ROLES = [("c_custkey", "bigint", "numeric"), ("c_nationkey", "int", "numeric"), ("c_acctbal", "double", "numeric"), ("c_mktsegment", "string", "categorical")]


@query(" UNION ALL ".join(
    f"SELECT {i}::INTEGER AS position, '{c}' AS \"column\", '{t}' AS type, '{r}' AS role, count({c}) AS n FROM customer" for i, (c, t, r) in enumerate(_ROLES)
))
def column_roles(spark, sf):
    """Position, type and role of the columns, with the number of values each holds."""
    c = select_features(read(spark, sf, "customer"), "c_custkey", [c for c, _, _ in _ROLES[1:]])
    c = c.select(F.col("c_custkey").cast("bigint"), F.col("c_nationkey").cast("int"), F.col("c_acctbal").cast("double"), "c_mktsegment")
    held = c.agg(*[F.count(x).alias(x) for x in c.columns]).unpivot([], c.columns, "column", "n")
    return roles_of(c).join(F.broadcast(held), "column").select("position", "column", "type", "role", "n")


@query("SELECT 'KMeans' AS model_type, count(*) AS rows_labelled FROM customer")
def list_saved_models(spark, sf):
    fitted, root = fixed_kmeans(spark, sf), scratch(spark)
    store.save_model(fitted, root)
    n = fitted.labels.agg(F.count(F.lit(1)).alias("rows_labelled"))
    return store.list_models(spark, root, "KMeans").select("model_type").crossJoin(F.broadcast(n))


@query(f"{FIXED} SELECT cluster_label, {R('avg(c_acctbal)', 4)} AS c_acctbal, {R('avg(c_nationkey)', 4)} AS c_nationkey "
       "FROM lab JOIN customer USING (c_custkey) GROUP BY 1")
def profile_csv(spark, sf):
    path = store.write_profile(tab.cluster_profile(fixed_kmeans(spark, sf)), scratch(spark))
    schema = "cluster_label int, c_acctbal double, c_nationkey double"
    return rounded(load_table(spark, path, "csv", schema=schema), 4)


@query()
def kmeans_default(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    return cluster(p, "KMeans", "p_partkey").labels


@query()
def kmeans_restarts(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return cluster(c, "KMeans", "c_custkey", n_clusters=4, init="random", n_init=5).labels


@query()
def elbow(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return km.elbow(c, "c_custkey")


SEPARATED = ("SELECT c_custkey, c_nationkey % 5 * 1000 + c_acctbal / 1000 AS x, c_nationkey % 5 * c_nationkey % 5 * 700 + c_custkey % 7 AS y, "
             "c_nationkey % 5 AS g FROM customer")


@query(f"""WITH s AS ({SEPARATED}), f AS (SELECT g, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS a, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS b FROM s),
w AS (SELECT sum(n * v) AS cost FROM (SELECT count(*) AS n, var_pop(a) + var_pop(b) AS v FROM f GROUP BY g))
SELECT 1::INTEGER AS k, round(count(*) * (var_pop(a) + var_pop(b)), 4) AS inertia FROM f UNION ALL SELECT 5, round(cost, 4) FROM w""")
def elbow_separated(spark, sf):
    read(spark, sf, "customer").createOrReplaceTempView("customer")
    c = spark.sql(SEPARATED).select("c_custkey", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    return km.elbow(c, "c_custkey", k_range=[1, 5], n_init=3).withColumn("inertia", F.round("inertia", 4))


def _separated(spark, sf, **how):
    """Clusters named by their smallest id: seeded labels have no fixed order."""
    read(spark, sf, "customer").createOrReplaceTempView("customer")
    c = spark.sql(SEPARATED).select("c_custkey", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    labels = cluster(c, "KMeans", "c_custkey", n_clusters=5, **how).labels
    return labels.join(F.broadcast(labels.groupBy(LABEL).agg(F.min("c_custkey").alias("first_key"))), LABEL).select("c_custkey", "first_key")


_SEPARATED_SQL = f"SELECT c_custkey, min(c_custkey) OVER (PARTITION BY g) AS first_key FROM ({SEPARATED})"


@query(_SEPARATED_SQL)
def kmeans_separated(spark, sf):
    return _separated(spark, sf)


@query(_SEPARATED_SQL)
def kmeans_restarts_separated(spark, sf):
    return _separated(spark, sf, n_init=4)


@query("""SELECT count(*) AS n, true AS close FROM orders""")
def approximate_median(spark, sf):
    """The sketch's median is a value whose rank is within one per cent of the middle."""
    o = read(spark, sf, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_totalprice AS DOUBLE) END AS price")
    filled = feat.impute_median(o, ["price"], approx=True)
    # the fill is the one value that all gaps got
    fill = filled.filter("o_orderkey % 5 = 0").agg(F.min("price").alias("_a"), F.max("price").alias("_b"))
    rank = o.crossJoin(F.broadcast(fill)).agg(
        F.count(F.lit(1)).alias("n"), (F.count_if(F.col("price") <= F.col("_a")) / F.count("price")).alias("_r"), F.every(F.col("_a") == F.col("_b")).alias("_one")
    )
    return rank.select("n", ((F.abs(F.col("_r") - 0.5) < 0.01) & F.col("_one")).alias("close"))


PAIR_SLOTS = 32
PAIR_TASKS = 96  # given, since few rows in make very many pairs out and would be left to one task


def near_pairs(f, most):
    """``a, b, distance`` of rows ``id, f_0, f_1`` in neighbouring squares of side ``most``, a < b; one side of a square is dealt over slots."""
    squares = [F.floor(F.col(c) / most) for c in ("f_0", "f_1")]
    moves = F.array(*[F.struct((squares[0] + i).alias("x"), (squares[1] + j).alias("y")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    a = f.select(F.col("id").alias("a"), F.col("f_0").alias("a0"), F.col("f_1").alias("a1"),
                 F.pmod(F.xxhash64("id"), F.lit(PAIR_SLOTS)).alias("slot"), F.explode(moves).alias("at"))
    b = f.select(F.col("id").alias("b"), F.col("f_0").alias("b0"), F.col("f_1").alias("b1"),
                 F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PAIR_SLOTS - 1).cast("long"))).alias("slot"),
                 F.struct(squares[0].alias("x"), squares[1].alias("y")).alias("at"))
    gap = F.sqrt((F.col("a0") - F.col("b0")) ** 2 + (F.col("a1") - F.col("b1")) ** 2)
    a, b = (side.repartition(PAIR_TASKS, "at", "slot") for side in (a, b))
    return a.join(b, ["at", "slot"]).filter(F.col("a") < F.col("b")).select("a", "b", gap.alias("distance"))


# -- DBSCAN -----------------------------------------------------------------

SUPPLIERS = scaled_sql("supplier", "s_suppkey", ["s_acctbal", "s_nationkey"])


def _dbscan_sql(base: str, eps: float, min_samples: int, metric: str, gap: str | None = None, key: str = "s_suppkey") -> str:
    return f"""WITH RECURSIVE {base},
e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM f a, f b WHERE a.id = b.id OR {gap or dist('a', 'b', 2, metric)} <= {eps}),
core AS MATERIALIZED (SELECT a AS id FROM e GROUP BY a HAVING count(*) >= {min_samples}),
ce AS MATERIALIZED (SELECT a, b FROM e WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id, id AS root FROM core UNION SELECT ce.b, reach.root FROM reach JOIN ce ON ce.a = reach.id),
comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
num AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS n FROM (SELECT DISTINCT root FROM comp)),
lab AS (SELECT id, n FROM comp JOIN num USING (root)),
border AS (SELECT e.a AS id, min(lab.n) AS n FROM e JOIN lab ON lab.id = e.b WHERE e.a NOT IN (SELECT id FROM core) GROUP BY e.a),
final AS (SELECT f.id AS {key}, coalesce(lab.n, border.n, -1)::INTEGER AS cluster_label
FROM f LEFT JOIN lab ON lab.id = f.id LEFT JOIN border ON border.id = f.id)"""


def supplier_dbscan(spark, sf, eps=0.3, metric="euclidean"):
    s = read(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    return cluster(s, "DBSCAN", "s_suppkey", eps=eps, min_samples=4, metric=metric)


EUCLIDEAN = _dbscan_sql(SUPPLIERS, 0.3, 4, "euclidean")


@query(f"{EUCLIDEAN} SELECT * FROM final")
def dbscan_euclidean(spark, sf):
    return supplier_dbscan(spark, sf).labels


@query(f"{_dbscan_sql(SUPPLIERS, 0.35, 4, 'manhattan')} SELECT * FROM final")
def dbscan_manhattan(spark, sf):
    return supplier_dbscan(spark, sf, 0.35, "manhattan").labels


@query(f"{_dbscan_sql(SUPPLIERS, 0.0011, 4, 'cosine')} SELECT * FROM final")
def dbscan_cosine(spark, sf):
    return supplier_dbscan(spark, sf, 0.0011, "cosine").labels


@query(f"{EUCLIDEAN} SELECT count(*) FILTER (cluster_label = -1) AS noise_count, "
       f"{R('count(*) FILTER (cluster_label = -1) / count(*)')} AS noise_ratio, "
       "(SELECT count(DISTINCT cluster_label) FROM final WHERE cluster_label <> -1) AS n_clusters_found FROM final")
def dbscan_noise(spark, sf):
    labels = supplier_dbscan(spark, sf).labels
    return rounded(ev.noise_summary(labels)).crossJoin(F.broadcast(ev.n_clusters_found(labels)))


@query(f"{EUCLIDEAN} SELECT cluster_label, {R('avg(s_acctbal)', 4)} AS s_acctbal, {R('avg(s_nationkey)', 4)} AS s_nationkey "
       "FROM final JOIN supplier USING (s_suppkey) GROUP BY 1")
def dbscan_profile(spark, sf):
    return rounded(tab.cluster_profile(supplier_dbscan(spark, sf)), 4)


@query(f"{EUCLIDEAN} SELECT * FROM final")
def dbscan_precomputed(spark, sf):
    s = read(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    f = feat.fit_features(s, "s_suppkey").transform(s)
    pairs = near_pairs(f.withColumnRenamed("s_suppkey", "id"), 0.3).filter("distance <= 0.3")
    return db.dbscan_pairs(s.select(F.col("s_suppkey").alias("id")), pairs, 0.3, 4).withColumnRenamed("id", "s_suppkey")


@query(f"""{_dbscan_sql(scaled_sql("customer", "c_custkey", ["c_acctbal", "c_nationkey"]), 0.08, 5, "euclidean", key="c_custkey")} SELECT * FROM final""")
def dbscan_customers(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return cluster(c, "DBSCAN", "c_custkey", eps=0.08, min_samples=5).labels


# 25 one-hot columns beside two numbers: two brands differ in two columns
BRANDS = """t AS (SELECT avg(p_size) AS a0, stddev_pop(p_size) AS s0, avg(p_retailprice) AS a1, stddev_pop(p_retailprice) AS s1, count(*) AS n FROM part),
w AS (SELECT p_brand, 1 / (count(*) / max(n) * (1 - count(*) / max(n))) AS v FROM part, t GROUP BY p_brand),
f AS MATERIALIZED (SELECT p_partkey AS id, (p_size - a0) / s0 AS f_0, (p_retailprice - a1) / s1 AS f_1, p_brand, v FROM part JOIN w USING (p_brand), t)"""
BRAND_GAP = "sqrt((a.f_0 - b.f_0)**2 + (a.f_1 - b.f_1)**2 + CASE WHEN a.p_brand = b.p_brand THEN 0 ELSE a.v + b.v END)"


@query(f"{_dbscan_sql(BRANDS, 0.4, 4, '', BRAND_GAP, 'p_partkey')} SELECT * FROM final")
def dbscan_many_columns(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    return cluster(p, "DBSCAN", "p_partkey", eps=0.4, min_samples=4).labels


@query(f"{_dbscan_sql('f AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS x FROM embeddings)', 0.66, 3, '', 'list_cosine_distance(a.x, b.x)', 'vec_id')} SELECT * FROM final")
def dbscan_vectors(spark, sf):
    e = read(spark, sf, "embeddings").select("vec_id", "embedding")
    return cluster(e, "DBSCAN", "vec_id", eps=0.66, min_samples=3, metric="cosine", scaler=None).labels


PARTS = scaled_sql("part", "p_partkey", ["p_size", "p_retailprice"])


def _kdist_sql(base: str, k: int, keep_zero: bool) -> str:
    return f"""WITH {base}, d AS (SELECT a.id, {dist('a', 'b', 2)} AS d, row_number() OVER (PARTITION BY a.id ORDER BY {dist('a', 'b', 2)}, b.id) AS rn
FROM f a JOIN f b ON a.id <> b.id)
SELECT row_number() OVER (ORDER BY d, id) AS sample_rank, {R('d')} AS k_distance FROM d WHERE rn = {k}{'' if keep_zero else ' AND d > 0'}"""


@query(_kdist_sql(PARTS, 5, False))
def k_distance(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    spec = feat.fit_features(p, "p_partkey")
    return rounded(diag.k_distance(spec.transform(p), "p_partkey", spec.f_cols, 5, allow_empty=True))


@query(_kdist_sql(PARTS, 1, True))
def k_distance_with_zeros(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    spec = feat.fit_features(p, "p_partkey")
    return rounded(diag.k_distance(spec.transform(p), "p_partkey", spec.f_cols, 1, ignore_zero_distance=False))


# -- scores -----------------------------------------------------------------

VECTORS = "f AS (SELECT vec_id AS id, label AS c, embedding::DOUBLE[] AS x FROM embeddings)"


def vectors(spark, sf):
    e = read(spark, sf, "embeddings")
    labels = e.select("vec_id", F.col("label").alias(LABEL))
    e = e.select("vec_id", "embedding")
    return given_labels(e, feat.fit_features(e, "vec_id", scaler="none"), labels)


_SIL = """d AS (SELECT a.id, a.c, b.c AS o, sum(list_distance(a.x, b.x)) AS s, count(*) AS n FROM f a, f b GROUP BY ALL),
ab AS (SELECT id, c, max(CASE WHEN c = o THEN CASE WHEN n > 1 THEN s / (n - 1) ELSE 0 END END) AS a,
min(CASE WHEN c <> o THEN s / n END) AS b, max(CASE WHEN c = o THEN n END) AS own FROM d GROUP BY id, c),
sil AS (SELECT id, c, a, b, CASE WHEN own = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""


@query(f"WITH {VECTORS}, {_SIL} SELECT id AS vec_id, c AS cluster_label, {R('a')} AS a, {R('b')} AS b, {R('s')} AS s FROM sil")
def silhouette_samples(spark, sf):
    r = vectors(spark, sf)
    return rounded(ev.silhouette_samples(r.labelled_features, "vec_id", r.f_cols))


@query(f"""WITH all_f AS (SELECT vec_id AS id, label AS c, embedding::DOUBLE[] AS x FROM embeddings),
f AS (SELECT * FROM all_f ORDER BY md5('7:' || id) LIMIT 200), {_SIL} SELECT {R('avg(s)')} AS silhouette_score FROM sil""")
def silhouette_sampled(spark, sf):
    r = vectors(spark, sf)
    return rounded(ev.silhouette_score(r.labelled_features, "vec_id", r.f_cols, sample_size=200, random_state=7))


@query(f"""WITH {VECTORS}, {_SIL}, z AS (SELECT c, row_number() OVER (ORDER BY c) AS place FROM (SELECT DISTINCT c FROM f))
SELECT c AS cluster_label, 10 * place + row_number() OVER (ORDER BY c, s, id) - 1 AS y, {R('s')} AS s,
{R('avg(s) OVER ()')} AS mean_s FROM sil JOIN z USING (c)""")
def silhouette_plot(spark, sf):
    return rounded(diag.silhouette_plot_data(vectors(spark, sf)))


def _scores_sql(base: str, x: str, gap: str, n_orig: int, dims: int, noise: bool, inertia: str = "NULL::DOUBLE") -> str:
    """Scores of labelled rows ``f(id, c, x)``; ``all_rows`` also holds noise."""
    return f"""{base}, {_SIL},
cen AS (SELECT c, count(*) AS n, [{", ".join(f"avg({x.format(i)})" for i in range(dims))}] AS m FROM f GROUP BY c),
g AS (SELECT [{", ".join(f"avg({x.format(i)})" for i in range(dims))}] AS gm, count(*) AS gn FROM f),
w AS (SELECT c, avg(list_distance(x, m)) AS s, sum(list_distance(x, m) ** 2) AS w FROM f JOIN cen USING (c) GROUP BY c),
ch AS (SELECT sum(cen.n * list_distance(m, gm) ** 2) * (max(gn) - count(*)) / (sum(w) * (count(*) - 1)) AS ch FROM cen, g, w WHERE cen.c = w.c),
db AS (SELECT avg(r) AS db FROM (SELECT a.c, max((wa.s + wb.s) / list_distance(a.m, b.m)) AS r
FROM cen a JOIN w wa ON wa.c = a.c JOIN cen b ON b.c <> a.c JOIN w wb ON wb.c = b.c GROUP BY a.c)),
tot AS (SELECT count(*) AS n_samples, count(*) FILTER (c = -1) AS noise_count FROM all_rows),
score AS (SELECT n_samples, {n_orig}::BIGINT AS n_original_features, {dims}::BIGINT AS n_features_after_transform,
(SELECT count(*) FROM cen) AS n_clusters_found, noise_count, {R('noise_count / n_samples')} AS noise_ratio,
(SELECT {R('avg(s)')} FROM sil) AS silhouette_score, {R('ch', 4)} AS calinski_harabasz_score,
{R('db', 4)} AS davies_bouldin_score, {inertia} AS inertia, {str(not noise).upper() if inertia != "NULL::DOUBLE" else "FALSE"} AS has_cluster_centers FROM tot, ch, db)"""


def _score_rounds(df):
    for c, d in (("noise_ratio", 6), ("silhouette_score", 6), ("calinski_harabasz_score", 4), ("davies_bouldin_score", 4), ("inertia", 4)):
        df = df.withColumn(c, F.round(c, d) + 0.0)
    return df


EMB_SCORES = _scores_sql(
    f"WITH {VECTORS}, all_rows AS (SELECT id, c FROM f)", "x[{}+1]", "", 1, 64, False
)


@query(f"{EMB_SCORES} SELECT * FROM score")
def evaluate_vectors(spark, sf):
    return _score_rounds(ev.evaluate(vectors(spark, sf)))


NOISY = (
    "WITH " + scaled_sql("part", "p_partkey", ["p_size", "p_retailprice"]).replace("f AS (", "f0 AS (", 1)
    + ", t AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS r FROM (SELECT DISTINCT p_type FROM part))"
    + ", all_rows AS (SELECT f0.id, CASE WHEN f0.id % 7 = 0 THEN -1 ELSE r END::INTEGER AS c, [f_0, f_1] AS x "
    + "FROM f0 JOIN part ON p_partkey = f0.id JOIN t USING (p_type)), f AS (SELECT * FROM all_rows WHERE c <> -1)"
)


def noisy_parts(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    label = feat.encode_ordinal(p.select("p_partkey", "p_type"), ["p_type"])
    label = label.select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, -1).otherwise(F.col("p_type")).alias(LABEL))
    p = p.drop("p_type")
    return given_labels(p, feat.fit_features(p, "p_partkey"), label)


PART_SCORES = _scores_sql(NOISY, "x[{}+1]", "", 2, 2, True)


@query(f"{PART_SCORES} SELECT * FROM score")
def evaluate_without_noise(spark, sf):
    return _score_rounds(ev.evaluate(noisy_parts(spark, sf)))


@query(f"{PART_SCORES} SELECT 'given' AS model, 'clustering' AS task, 'standard' AS scaler, 2::BIGINT AS feature_names_len, * FROM score")
def summary(spark, sf):
    return _score_rounds(ev.summary(noisy_parts(spark, sf)))


@query(f"""{FIXED}, f AS (SELECT c_custkey AS id, cluster_label AS c, [f_0, f_1] AS x FROM lab), all_rows AS (SELECT id, c FROM f), """.replace("WITH f AS (", "WITH f00 AS (").replace("FROM f,", "FROM f00,").replace("f.id, f_0", "f00.id, f_0") .rstrip(", ") + ", " + _scores_sql("", "x[{}+1]", "", 2, 2, False, "(SELECT round(sum(d2), 4) FROM lab)").lstrip(", ") + " SELECT * FROM score")
def evaluate_kmeans(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    r = km.kmeans(c, "c_custkey", n_clusters=3, init=CENTRES, max_iter=ROUNDS, tol=0.0)
    return _score_rounds(ev.evaluate(r))


# -- agglomerative ----------------------------------------------------------


def _merge_sql(base: str, n: int, linkage: str, metric: str, stop: int = 1) -> str:
    """One merge per step, each the nearest pair of that moment."""
    ctes = [
        base,
        "r AS MATERIALIZED (SELECT row_number() OVER (ORDER BY id) - 1 AS num, * FROM f)",
        f"p AS MATERIALIZED (SELECT a.num AS i, b.num AS j, {dist('a', 'b', 2, metric)} AS d FROM r a, r b WHERE a.num <> b.num)",
        "l0 AS MATERIALIZED (SELECT num, num AS cid FROM r)",
    ]
    for t in range(n - stop):
        if linkage == "ward":
            step = (
                f"SELECT a.cid AS x, b.cid AS y, sqrt(2.0 * a.n * b.n / (a.n + b.n) * ((a.m0 - b.m0)**2 + (a.m1 - b.m1)**2)) AS d, a.n + b.n AS size "
                f"FROM s{t} a JOIN s{t} b ON a.cid < b.cid"
            )
            ctes.append(f"s{t} AS MATERIALIZED (SELECT cid, count(*) AS n, avg(f_0) AS m0, avg(f_1) AS m1 FROM l{t} JOIN r USING (num) GROUP BY cid)")
        else:
            fn = {"single": "min", "complete": "max", "average": "avg"}[linkage]
            step = (
                f"SELECT a.cid AS x, b.cid AS y, {fn}(p.d) AS d, count(DISTINCT a.num) + count(DISTINCT b.num) AS size "
                f"FROM p JOIN l{t} a ON a.num = p.i JOIN l{t} b ON b.num = p.j WHERE a.cid < b.cid GROUP BY 1, 2"
            )
        ctes.append(f"b{t} AS MATERIALIZED ({step} ORDER BY d, x, y LIMIT 1)")
        ctes.append(f"l{t + 1} AS MATERIALIZED (SELECT num, CASE WHEN cid IN (SELECT x FROM b{t} UNION ALL SELECT y FROM b{t}) THEN {n + t} ELSE cid END AS cid FROM l{t})")
    return "WITH RECURSIVE " + ", ".join(ctes)


def _labels_sql(base, n, linkage, metric, k, key):
    return (
        _merge_sql(base, n, linkage, metric, k)
        + f", z AS (SELECT cid, row_number() OVER (ORDER BY min(num)) - 1 AS c FROM l{n - k} GROUP BY cid) "
        + f"SELECT r.id AS {key}, c::INTEGER AS cluster_label FROM r JOIN l{n - k} USING (num) JOIN z USING (cid)"
    )


def _linkage_sql(base, n, linkage, metric="euclidean"):
    return _merge_sql(base, n, linkage, metric) + ", z AS (" + " UNION ALL ".join(
        f"SELECT {t}::BIGINT AS merge_id, x AS left_id, y AS right_id, d AS distance, size FROM b{t}" for t in range(n - 1)
    ) + ")"


NATION_F = f"nf AS ({NATIONS}), " + scaled_sql("nf", "id", ["n_customers", "avg_acctbal"])
N_NATIONS = 25


def _nation_labels(spark, sf, linkage, metric="euclidean", k=4):
    return cluster(nations(spark, sf), "AgglomerativeClustering", "id", n_clusters=k, linkage=linkage, metric=metric).labels


def _nation_tree(spark, sf, linkage, metric="euclidean"):
    n = nations(spark, sf)
    spec = feat.fit_features(n, "id")
    return agg.linkage_table(spec.transform(n), "id", spec.f_cols, linkage, metric)


@query(_labels_sql(NATION_F, N_NATIONS, "ward", "euclidean", 4, "id"))
def agglomerative_ward(spark, sf):
    return _nation_labels(spark, sf, "ward")


@query(_labels_sql(NATION_F, N_NATIONS, "complete", "manhattan", 4, "id"))
def agglomerative_complete(spark, sf):
    return _nation_labels(spark, sf, "complete", "manhattan")


@query(_labels_sql(NATION_F, N_NATIONS, "average", "cosine", 4, "id"))
def agglomerative_average(spark, sf):
    return _nation_labels(spark, sf, "average", "cosine")


@query(_labels_sql(NATION_F, N_NATIONS, "single", "euclidean", 4, "id"))
def agglomerative_single(spark, sf):
    return _nation_labels(spark, sf, "single")


def _choice_sql(k: int) -> str:
    names = (f"e{k} AS (SELECT num, cid FROM l WHERE step = (SELECT count(*) FROM r) - {k}), "
             f"n{k} AS (SELECT cid, row_number() OVER (ORDER BY min(num)) - 1 AS c, count(*) AS n FROM e{k} GROUP BY cid)")
    return names


# -- saved models without centres ---------------------------------------------


def reloaded(spark, sf, fitted):
    return store.load_model(spark, store.save_model(fitted, scratch(spark)), fitted.source)


# the labelled rows of the scores are ``f``, so the plain ones get another name
_NOISY_SUPPLIERS = (
    EUCLIDEAN.replace("WITH RECURSIVE f AS (", "WITH RECURSIVE f00 AS (", 1).replace("FROM f a, f b", "FROM f00 a, f00 b").replace("FROM f LEFT JOIN", "FROM f00 f LEFT JOIN")
    + ", all_rows AS (SELECT s_suppkey AS id, cluster_label AS c, [f_0, f_1] AS x FROM final JOIN f00 ON f00.id = s_suppkey), f AS (SELECT * FROM all_rows WHERE c <> -1)"
)


@query(f"{_scores_sql(_NOISY_SUPPLIERS, 'x[{}+1]', '', 2, 2, True)} SELECT * FROM score")
def evaluate_loaded_dbscan(spark, sf):
    return _score_rounds(ev.evaluate(reloaded(spark, sf, supplier_dbscan(spark, sf))))


@query(_labels_sql(NATION_F, N_NATIONS, "ward", "euclidean", 4, "id"))
def save_and_load_agglomerative(spark, sf):
    return reloaded(spark, sf, cluster(nations(spark, sf), "AgglomerativeClustering", "id", n_clusters=4)).labels


# -- more than a task's worth of clusters, and distances given as a table -----

USERS = "uf AS (SELECT user_id AS id, count(*) * 1.0 AS n_events, avg(value) AS avg_value FROM events GROUP BY user_id)"
USERS_F = f"{USERS}, " + scaled_sql("uf", "id", ["n_events", "avg_value"])


def users(spark, sf):
    """A row for each user: 150 at sf0.01, more than one task merges."""
    return read(spark, sf, "events").groupBy(F.col("user_id").alias("id")).agg(
        (F.count(F.lit(1)) * 1.0).cast("double").alias("n_events"), F.avg("value").alias("avg_value")
    )


def _steps_sql(base: str, linkage: str, metric: str = "euclidean", pairs: str | None = None) -> str:
    """One merge per step, the nearest pair of that moment, for any number of rows.

    ``l`` holds the cluster of each row after each step. With ``pairs`` only those are given and only
    clusters with all pairs between them (one, for single linkage) can merge.
    """
    if linkage == "ward" and pairs is None:
        side = "(SELECT cid, count(*) AS n, avg(f_0) AS m0, avg(f_1) AS m1 FROM l JOIN r USING (num) GROUP BY cid)"
        nearest = (f"SELECT a.cid AS x, b.cid AS y, sqrt(2.0 * a.n * b.n / (a.n + b.n) * ((a.m0 - b.m0)**2 + (a.m1 - b.m1)**2)) AS d, a.n + b.n AS size "
                   f"FROM {side} a JOIN {side} b ON a.cid < b.cid")
    else:
        # ward from distances: the mean squared distance between the clusters less their variances
        value = {"single": "min(d)", "complete": "max(d)", "average": "sum(d) / count(*)",
                 "ward": "sqrt(2.0 * na * nb / (na + nb) * greatest(sum(d * d) / count(*) - any_value(va) - any_value(vb), 0))"}[linkage]
        whole = "" if linkage == "single" else "HAVING count(*) = na * nb"
        size = "(SELECT cid, count(*) AS n, 0 AS v FROM l GROUP BY cid)" if linkage != "ward" else (
            "(SELECT sz.cid, sz.n, coalesce(vv.s, 0) / (2.0 * sz.n * sz.n) AS v FROM (SELECT cid, count(*) AS n FROM l GROUP BY cid) sz "
            "LEFT JOIN (SELECT c1.cid, sum(p.d * p.d) AS s FROM p JOIN l c1 ON c1.num = p.i JOIN l c2 ON c2.num = p.j WHERE c1.cid = c2.cid GROUP BY c1.cid) vv ON vv.cid = sz.cid)")
        nearest = (f"SELECT x, y, {value} AS d, na + nb AS size FROM (SELECT a.cid AS x, b.cid AS y, p.d, ka.n AS na, kb.n AS nb, ka.v AS va, kb.v AS vb "
                   f"FROM p JOIN l a ON a.num = p.i JOIN l b ON b.num = p.j JOIN {size} ka ON ka.cid = a.cid JOIN {size} kb ON kb.cid = b.cid WHERE a.cid < b.cid) "
                   f"GROUP BY x, y, na, nb {whole}")
    given = pairs or f"SELECT a.num AS i, b.num AS j, {dist('a', 'b', 2, metric)} AS d FROM r a, r b WHERE a.num <> b.num"
    return f"""WITH RECURSIVE {base},
r AS MATERIALIZED (SELECT row_number() OVER (ORDER BY id) - 1 AS num, * FROM f),
p AS MATERIALIZED ({given}),
l AS (SELECT 0::BIGINT AS step, num, num AS cid, NULL::BIGINT AS x, NULL::BIGINT AS y, NULL::DOUBLE AS d, NULL::BIGINT AS size FROM r
UNION ALL SELECT step + 1, num, CASE WHEN cid IN (m.x, m.y) THEN (SELECT count(*) FROM r) + step ELSE cid END, m.x, m.y, m.d, m.size
FROM l, ({nearest} ORDER BY 3, 1, 2 LIMIT 1) m),
z AS (SELECT DISTINCT step - 1 AS merge_id, x AS left_id, y AS right_id, d AS distance, size FROM l WHERE step > 0)"""


def _cut_sql(steps: str, k: int, key: str) -> str:
    return (f"{steps}, e AS (SELECT num, cid FROM l WHERE step = (SELECT count(*) FROM r) - {k}), "
            f"names AS (SELECT cid, row_number() OVER (ORDER BY min(num)) - 1 AS c FROM e GROUP BY cid) "
            f"SELECT r.id AS {key}, c::INTEGER AS cluster_label FROM r JOIN e USING (num) JOIN names USING (cid)")


_MERGES = f"SELECT merge_id, left_id, right_id, {R('distance')} AS distance, size FROM z"


def _user_tree(spark, sf, linkage, metric="euclidean"):
    u = users(spark, sf)
    spec = feat.fit_features(u, "id")
    return rounded(agg.linkage_table(spec.transform(u), "id", spec.f_cols, linkage, metric))


@query(f"{_steps_sql(USERS_F, 'ward')} {_MERGES}")
def linkage_users_ward(spark, sf):
    return _user_tree(spark, sf, "ward")


@query(f"{_steps_sql(USERS_F, 'complete', 'manhattan')} {_MERGES}")
def linkage_users_complete(spark, sf):
    return _user_tree(spark, sf, "complete", "manhattan")


@query(f"{_steps_sql(USERS_F, 'average', 'cosine')} {_MERGES}")
def linkage_users_average(spark, sf):
    return _user_tree(spark, sf, "average", "cosine")


@query(f"{_steps_sql(USERS_F, 'single')} {_MERGES}")
def linkage_users_single(spark, sf):
    return _user_tree(spark, sf, "single")


def user_pairs(spark, sf, most):
    """Users, and the pairs of them up to a distance, each once."""
    u = users(spark, sf)
    f = feat.fit_features(u, "id").transform(u)
    pairs = near_pairs(f, most).filter(F.col("distance") <= most)
    return u.select("id"), pairs


def _given(most: float) -> str:
    return f"SELECT a.num AS i, b.num AS j, {dist('a', 'b', 2)} AS d FROM r a, r b WHERE a.num <> b.num AND {dist('a', 'b', 2)} <= {most}"


def _pairs_query(linkage: str, most: float):
    def run(spark, sf):
        ids, pairs = user_pairs(spark, sf, most)
        return rounded(ap.linkage_pairs(ids, pairs, linkage, once=True))

    run.__name__ = f"linkage_pairs_{linkage}"
    return query(f"{_steps_sql(USERS_F, linkage, pairs=_given(most))} {_MERGES}")(run)


for _linkage in agg.LINKAGES:
    # far pairs are missing, so that the tree is a forest for all but single linkage
    _pairs_query(_linkage, 1.5)


@query(_cut_sql(_steps_sql(USERS_F, "average", pairs=_given(99.0)), 6, "id"))
def agglomerative_from_pairs(spark, sf):
    return ap.agglomerative_pairs(*user_pairs(spark, sf, 99.0), n_clusters=6, linkage="average", once=True)


@query(_cut_sql(_steps_sql(SUPPLIERS, "average"), 5, "s_suppkey"))
def agglomerative_suppliers(spark, sf):
    s = read(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    return cluster(s, "AgglomerativeClustering", "s_suppkey", n_clusters=5, linkage="average").labels


_Z = f"SELECT merge_id, left_id, right_id, {R('distance')} AS distance, size FROM z"


@query(f"{_linkage_sql(NATION_F, N_NATIONS, 'ward')} {_Z}")
def linkage_ward(spark, sf):
    return rounded(_nation_tree(spark, sf, "ward"))


@query(f"{_linkage_sql(NATION_F, N_NATIONS, 'complete')} {_Z}")
def linkage_complete(spark, sf):
    return rounded(_nation_tree(spark, sf, "complete"))


@query(f"{_linkage_sql(NATION_F, N_NATIONS, 'average')} {_Z}")
def linkage_average(spark, sf):
    return rounded(_nation_tree(spark, sf, "average"))


@query(f"{_linkage_sql(NATION_F, N_NATIONS, 'single')} {_Z}")
def linkage_single(spark, sf):
    return rounded(_nation_tree(spark, sf, "single"))


def _dendrogram_sql(drawn: str, steps: str = _linkage_sql(NATION_F, N_NATIONS, "ward"), n: int | str = N_NATIONS) -> str:
    return f"""{steps},
kid AS (SELECT merge_id + {n} AS parent, left_id AS node, 0 AS off FROM z
UNION ALL SELECT merge_id + {n}, right_id, coalesce((SELECT size FROM z y WHERE y.merge_id + {n} = z.left_id), 1) FROM z),
walk AS (SELECT 2 * {n} - 2 AS node, NULL::BIGINT AS parent, 0 AS depth, 0::BIGINT AS start
UNION ALL SELECT kid.node, kid.parent, walk.depth + 1, walk.start + kid.off FROM walk JOIN kid ON kid.parent = walk.node),
info AS (SELECT walk.*, coalesce(distance, 0) AS height, coalesce(size, 1) AS size, node >= {n} AND ({drawn}) AS drawn
FROM walk LEFT JOIN z ON z.merge_id + {n} = walk.node),
kept AS (SELECT info.* FROM info LEFT JOIN info up ON up.node = info.parent WHERE info.parent IS NULL OR up.drawn)
SELECT node::BIGINT AS node, parent, {R('height')} AS height, size::BIGINT AS size, depth::INTEGER AS depth, NOT drawn AS is_leaf,
CASE WHEN NOT drawn THEN row_number() OVER (PARTITION BY drawn ORDER BY start) - 1 END AS "order" FROM kept"""


def _nation_dendrogram(spark, sf, *args):
    return rounded(dendrogram(_nation_tree(spark, sf, "ward"), *args))


@query(_dendrogram_sql("TRUE"))
def dendrogram_full(spark, sf):
    return _nation_dendrogram(spark, sf)


@query(_dendrogram_sql(f"node >= {2 * N_NATIONS - 6}"))
def dendrogram_lastp(spark, sf):
    return _nation_dendrogram(spark, sf, "lastp", 6)


@query(_dendrogram_sql("depth <= 2"))
def dendrogram_level(spark, sf):
    return _nation_dendrogram(spark, sf, "level", 2)


_USER_ROWS = "(SELECT count(*) FROM r)"


_OFFERED = parameter_choices("AgglomerativeClustering", "ward")["n_clusters"]


@query(f"{_steps_sql(USERS_F, 'ward')}, " + ", ".join(map(_choice_sql, _OFFERED)) + " "
       + " UNION ALL ".join(f"SELECT {k}::INTEGER AS n_clusters, c::INTEGER AS cluster_label, n AS count FROM n{k}" for k in _OFFERED))
def offered_cuts(spark, sf):
    """Cluster sizes for every number of clusters that is offered, all from one tree."""
    u = users(spark, sf)
    tree = cluster(u, "AgglomerativeClustering", "id", n_clusters=2).tree
    found = [
        tree.cut_at(k).groupBy(LABEL).agg(F.count(F.lit(1)).alias("count")).select(F.lit(k).alias("n_clusters"), LABEL, "count") for k in _OFFERED
    ]
    return reduce(DataFrame.unionByName, found)


def _user_dendrogram(spark, sf, *args):
    return rounded(dendrogram(_user_tree(spark, sf, "ward"), *args))


@query(_dendrogram_sql(f"node >= 2 * {_USER_ROWS} - 12", _steps_sql(USERS_F, "ward"), _USER_ROWS))
def dendrogram_users_lastp(spark, sf):
    return _user_dendrogram(spark, sf, "lastp", 12)


@query(_dendrogram_sql("depth <= 3", _steps_sql(USERS_F, "ward"), _USER_ROWS))
def dendrogram_users_level(spark, sf):
    return _user_dendrogram(spark, sf, "level", 3)
