"""Connected components of a distributed edge list."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cut import cut, table
from .skew import BROADCAST_ROWS, attach


def connected_components(edges: DataFrame, at_once: int = 0) -> DataFrame:
    """``node, comp`` for every node of ``edges(a, b)``; comp is the smallest node.

    Up to ``at_once`` different edges are joined by one task.

    Alternates large-star and small-star steps (Kiveris et al., 2014): each
    links the neighbours of a node to the smallest of them, so paths shrink
    quickly and the edge list never grows. It ends when every edge points from
    a node straight to the root of a star.
    """
    e = cut(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    if at_once and e.count() <= at_once:
        return _joined(e)
    n, settled = _state(e)
    rounds = 0
    while not settled:
        rounds += 1
        # size estimates multiply from round to round; a table resets them
        e = (cut if rounds % 3 else table)(_round(e, 2 * n))
        n, settled = _state(e)
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return leaves.unionByName(roots)


def _joined(e: DataFrame) -> DataFrame:
    """Components of few edges, by one task."""

    def join(table):
        # structs come as dictionaries
        u, v = ([tuple(x.values()) if isinstance(x, dict) else x for x in table.column(c).to_pylist()] for c in "uv")
        root = {x: x for x in (*u, *v)}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x, y in zip(u, v):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
        kind = table.schema.field("u").type
        fields = [kind.field(i).name for i in range(kind.num_fields)]
        kind = pa.struct([(f, kind.field(f).type) for f in fields]) if fields else kind  # all may be null, as the schema says
        name = lambda x: dict(zip(fields, x)) if isinstance(x, tuple) else x
        return pa.table({"node": pa.array([name(x) for x in root], kind), "comp": pa.array([name(find(x)) for x in root], kind)})

    kind = e.schema["u"].dataType.simpleString()
    return e.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(join, f"node {kind}, comp {kind}")


def _round(e: DataFrame, bound: int) -> DataFrame:
    """One large-star and one small-star step; ``bound`` limits the node count."""
    both = _pairs(e, ("u", "v"), ("v", "u"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("_n"))
    large = (
        attach(both.filter("v > u"), low, ["u"], "_n", small_rows=bound)
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )
    if bound > BROADCAST_ROWS:
        large = cut(large)
    low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
    linked = attach(large, low, ["u"], "_n", small_rows=bound)
    return _pairs(linked, ("v", "m"), ("u", "m")).filter("u <> v").distinct()


def _pairs(df: DataFrame, *picks: tuple[str, str]) -> DataFrame:
    """Several column pairs of each row as rows ``u, v``, reading ``df`` once."""
    rows = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in picks])
    return df.select(F.explode(rows).alias("_p")).select("_p.u", "_p.v")


def _state(e: DataFrame) -> tuple[int, bool]:
    """Number of edges, and whether every node has one parent that is no child."""
    ends = F.explode(
        F.array(
            F.struct(F.col("u").alias("x"), F.lit(1).alias("c"), F.lit(0).alias("p")),
            F.struct(F.col("v").alias("x"), F.lit(0).alias("c"), F.lit(1).alias("p")),
        )
    )
    row = (
        e.select(ends.alias("_e")).select("_e.*").groupBy("x").agg(F.sum("c").alias("c"), F.max("p").alias("p"))
        .agg(F.sum("c").alias("n"), F.count_if(F.expr("c > 1 OR (c = 1 AND p = 1)")).alias("bad"))
        .first()
    )
    return row["n"] or 0, not row["bad"]
