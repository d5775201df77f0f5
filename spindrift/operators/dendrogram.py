"""The merge tree laid out for drawing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.cut import cut, table
from ..plans.numbering import number_rows
from ..plans.skew import attach


FRONTIER_LEVELS = 15  # levels that are looked up one by one


def dendrogram(
    merges: DataFrame,
    truncate_mode: str | None = None,
    p: int = 12,
    distance_sort: str | bool = False,
) -> DataFrame:
    """``node, parent, height, size, depth, is_leaf, order`` from a linkage table.

    ``order`` numbers the drawn leaves from left to right. ``"lastp"`` draws
    the last p - 1 merges, ``"level"`` merges at most p steps below the root;
    what lies below is drawn as one leaf, and only the drawn merges are laid out. With ``distance_sort`` the lower
    child goes left ("ascending" or True) or right ("descending").
    """
    if truncate_mode not in (None, "none", "lastp", "level"):
        raise ValueError("truncate_mode must be None, 'lastp' or 'level'")
    if distance_sort not in (False, True, "ascending", "descending"):
        raise ValueError("distance_sort must be False, 'ascending' or 'descending'")
    if truncate_mode in ("lastp", "level") and p < 1:
        raise ValueError("p must be at least 1")
    merges = cut(merges)
    n = merges.count() + 1
    root = 2 * n - 2
    top = merges
    if truncate_mode == "lastp":
        top = cut(merges.filter(F.col("merge_id") >= n - min(p, n)))
    elif truncate_mode == "level" and p <= FRONTIER_LEVELS:
        top = _frontier(merges, n, p)
    placed = _placed(top, merges, n, root, distance_sort)
    inner = F.col("node") >= n
    if truncate_mode == "lastp":
        drawn = inner & (F.col("node") >= 2 * n - min(p, n))
    elif truncate_mode == "level":
        drawn = inner & (F.col("depth") <= p)
    else:
        drawn = inner
    placed = placed.withColumn("drawn", drawn)
    shown = placed.select(F.col("node").alias("parent"), F.col("drawn").alias("_up"))
    kept = cut(
        placed.join(shown, "parent", "left").filter((F.col("node") == root) | F.col("_up"))
        .select("node", "parent", "height", "size", "depth", (~F.col("drawn")).alias("is_leaf"), "start")
    )
    # a leaf that stands for a subtree covers one stretch of the full order
    leaves = number_rows(kept.filter("is_leaf").select("node", "start"), [F.col("start")], "order")
    return kept.drop("start").join(leaves.select("node", "order"), "node", "left")


def _frontier(merges: DataFrame, n: int, p: int) -> DataFrame:
    """The merges at most ``p`` steps below the last one, level by level: no more than 2^(p + 1)."""
    found = level = cut(merges.filter(F.col("merge_id") == n - 2))
    for _ in range(p):
        below = level.select(F.explode(F.array("left_id", "right_id")).alias("_node")).filter(F.col("_node") >= n)
        # a level has at most twice as many nodes as the one above, whatever the table
        level = cut(merges.join(F.broadcast(below.select((F.col("_node") - n).alias("merge_id"))), "merge_id"))
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return cut(found)


def _placed(merges: DataFrame, whole: DataFrame, n: int, root: int, distance_sort) -> DataFrame:
    """Every node of ``merges`` and every child of theirs, with parent, height, size, depth and first leaf position.

    ``merges`` are the topmost ones of ``whole``, or all.
    """
    own = whole.select((F.col("merge_id") + n).alias("node"), F.col("distance").alias("height"), "size")
    if merges is not whole:
        ids = merges.select(F.explode(F.array(F.col("merge_id") + n, "left_id", "right_id")).alias("node")).distinct()
        own = cut(own.join(ids, "node", "left_semi"))
    child_facts = own.select("node", F.col("height").alias("h"), F.col("size").alias("s"))

    def side(c):
        return child_facts.select(F.col("node").alias(f"{c}_id"), F.col("h").alias(f"{c}_h"), F.col("s").alias(f"{c}_s"))

    m = merges.join(side("left"), "left_id", "left").join(side("right"), "right_id", "left")
    m = m.fillna(0.0, ["left_h", "right_h"]).fillna(1, ["left_s", "right_s"])
    if distance_sort in (True, "ascending"):
        swap = F.col("left_h") > F.col("right_h")
    elif distance_sort == "descending":
        swap = F.col("right_h") > F.col("left_h")
    else:
        swap = F.lit(False)
    zero = F.lit(0).cast("long")
    kids = F.array(
        F.struct(F.col("left_id").alias("node"), F.when(swap, F.col("right_s")).otherwise(zero).alias("off"),
                 F.col("left_s").alias("size")),
        F.struct(F.col("right_id").alias("node"), F.when(swap, zero).otherwise(F.col("left_s")).alias("off"),
                 F.col("right_s").alias("size")),
    )
    child = m.select((F.col("merge_id") + n).alias("parent"), F.explode(kids).alias("k")).select("parent", "k.*")
    links = cut(child.select("node", "parent", F.col("parent").alias("ptr"), "off", F.lit(1).alias("dep"), "size"))
    # pointer doubling: each round a node learns the sums of twice as many ancestors
    done = None
    while True:
        finished = links.filter(F.col("ptr") == root)
        done = finished if done is None else done.unionByName(finished)
        going = links.filter(F.col("ptr") != root)
        if going.isEmpty():
            break
        asked = going.groupBy("ptr").agg(F.count(F.lit(1)).alias("_n"))
        known = done.select("node", "ptr", "off", "dep").unionByName(going.select("node", "ptr", "off", "dep"))
        step = known.select(F.col("node").alias("ptr"), F.col("ptr").alias("_p"), F.col("off").alias("_o"), F.col("dep").alias("_d"))
        links = table(
            attach(going, asked.join(step, "ptr"), ["ptr"], "_n").select(
                "node", "parent", F.col("_p").alias("ptr"), (F.col("off") + F.col("_o")).alias("off"),
                (F.col("dep") + F.col("_d")).alias("dep"), "size",
            )
        )
    top = own.filter(F.col("node") == root).select(
        "node", F.lit(None).cast("long").alias("parent"), "size", F.lit(0).alias("depth"), zero.alias("start")
    )
    placed = done.select("node", "parent", "size", F.col("dep").alias("depth"), F.col("off").alias("start"))
    return placed.unionByName(top).join(own.select("node", "height"), "node", "left").fillna(0.0, ["height"])
