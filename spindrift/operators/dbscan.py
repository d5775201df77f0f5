"""Density-based clustering.

A row with at least ``min_samples`` rows (itself included) within ``eps`` is a
core row; core rows within ``eps`` of each other share a cluster; other rows
join the lowest cluster that has a core row within ``eps``; the rest is noise.
Clusters are numbered by their smallest core row id, from 0.

Rows are first grouped into cells so small that two rows of one cell are
always neighbours. A crowded cell is then core as a whole, whatever its size,
and counts, links and labels are decided between cells by their bounding
boxes. Only what boxes cannot decide goes down to rows, and of those there are
fewer than ``min_samples`` per cell on one side of each join.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import all_zero, box_gap, box_reach, check_metric, distance, num, unit_length
from ..plans.components import connected_components
from ..plans.cut import cut, table
from ..plans.numbering import number_rows
from ..plans.skew import attach
from .dense import block_components
from .features import FeatureSpec, fit_features
from .result import LABEL, NOISE, ClusterResult

GRID_DIMS = 3          # columns per level of the neighbour search
GRID_LEVELS = 3
PIVOTS = 6             # coordinates that are distances, if there are more columns than the levels hold
SLOT_ROWS = 10_000     # rows of one cell that may meet in one task's group
PAIR_ROWS = 4_096      # row pairs of two cells compared directly
FEW_LOOKS = 10_000_000  # row pairs not worth a components run to save
CROWD = 2              # rows of a cell, in the mean, below which cells of more columns than the levels hold are of no use
BOX_COLUMNS = 24       # columns beyond which boxes decide nothing, and plans over their corners outgrow the driver
SPLIT = 4              # a cell is cut into this many parts per column


@dataclass(frozen=True)
class _Plane:
    """The space distances are measured in."""

    dims: int
    eps: float
    metric: str

    @property
    def cols(self):
        return [f"x_{i}" for i in range(self.dims)]

    @property
    def side(self) -> float:
        share = self.dims if self.metric == "manhattan" else math.sqrt(self.dims)
        return self.eps / share * (1 - 1e-6)

    @property
    def steps(self) -> int:
        """Rows within eps are at most this many cells apart in a column."""
        return math.ceil(self.eps / self.side)

    def box(self):
        return [F.expr(f"min({c}) AS lo_{i}") for i, c in enumerate(self.cols)] + [
            F.expr(f"max({c}) AS hi_{i}") for i, c in enumerate(self.cols)
        ]

    @property
    def box_names(self):
        return [f"{s}_{i}" for s in ("lo", "hi") for i in range(self.dims)]

    def corners(self, prefix: str):
        return [[f"{prefix}{s}_{i}" for i in range(self.dims)] for s in ("lo", "hi")]

    def gap(self, a="a_", b="b_"):
        return box_gap(*self.corners(a), *self.corners(b), self.metric)

    def reach(self, a="a_", b="b_"):
        return box_reach(*self.corners(a), *self.corners(b), self.metric)

    def point_gap(self, b="b_"):
        return box_gap(self.cols, self.cols, *self.corners(b), self.metric)

    def point_reach(self, b="b_"):
        return box_reach(self.cols, self.cols, *self.corners(b), self.metric)

    def between(self, a: str, b: str):
        return distance([f"{a}{c}" for c in self.cols], [f"{b}{c}" for c in self.cols], self.metric)

    def boxed(self, df: DataFrame, side: str, *others: str) -> DataFrame:
        """Rename ``cell``, its box and ``others`` for one side of a join."""
        names = ["cell", *self.box_names, *others]
        return df.select(*[F.col(c).alias(side if c == "cell" else f"{side}_{c}") for c in names])


def dbscan(
    df: DataFrame,
    id_col: str,
    cols: list[str] | None = None,
    eps: float = 0.5,
    min_samples: int = 5,
    metric: str = "euclidean",
    scaler: str | None = "standard",
    cat_encoder: str = "ohe",
    extra_stages: list | None = None,
    spec: FeatureSpec | None = None,
) -> ClusterResult:
    _check(eps, min_samples)
    check_metric(metric)
    spec = spec or fit_features(df, id_col, cols, scaler, cat_encoder, extra_stages)
    features = spec.transform(df)
    if spec.sparse:
        labels = _with_blocks(features, spec, float(eps), min_samples, metric)
    else:
        features, f_cols = _folded(features, spec, float(eps), metric)
        labels = dbscan_labels(features, id_col, f_cols, eps, min_samples, metric)
    params = {"eps": eps, "min_samples": min_samples, "metric": metric}
    return ClusterResult("DBSCAN", params, spec, df, label_table=cut(labels))


def _folded(features: DataFrame, spec: FeatureSpec, eps: float, metric: str) -> tuple[DataFrame, list[str]]:
    """Features in which a category is one column instead of one-hot ones, where that leaves the same neighbours.

    Rows of different categories differ by at least the least step of the block's columns. If
    that is beyond ``eps``, so is the column that takes their place, and rows of one category differ by 0 in both.
    """
    if metric == "cosine" or spec.encoder != "ohe" or spec.stages is not None:
        return features, spec.f_cols
    at, folded = len(spec.numeric) + sum(spec.vectors.values()), []
    kept = spec.f_cols[:at]
    for c in spec.categorical:
        cols = spec.f_cols[at:at + len(spec.categories[c])]
        centre, width = (spec.centre[at:], spec.width[at:]) if spec.scaler != "none" else ([0.0] * len(cols), [1.0] * len(cols))
        at += len(cols)
        if len(cols) > 2 and min(1 / w for w in width[:len(cols)]) > eps:
            own = " ".join(f"WHEN {f} > {num((0.5 - m) / w)} THEN {k}" for k, (f, m, w) in enumerate(zip(cols, centre, width)))
            folded.append(F.expr(f"CASE {own} ELSE -1 END * {num(4 * eps)}"))
        else:
            kept += cols
    if not folded:
        return features, spec.f_cols
    names = [f"g_{i}" for i in range(len(kept) + len(folded))]
    return features.select(spec.id_col, *[x.alias(g) for x, g in zip([*map(F.col, kept), *folded], names)]), names


def _with_blocks(features: DataFrame, spec: FeatureSpec, eps: float, min_samples: int, metric: str) -> DataFrame:
    """Labels of rows with sparse one-hot blocks.

    Rows of different categories lie at least as far apart as the two categories that add least. If
    that is beyond ``eps``, as it is after standard scaling with the usual values of ``eps``, the category's number times a step beyond
    ``eps`` takes the block's place: the same rows are neighbours. Otherwise all pairs are measured.
    """
    if metric == "cosine":
        raise ValueError("one-hot blocks of many values have no cosine distance here; encode them as ordinal")
    id_col, n = spec.id_col, len(spec.sparse)
    features, apart = cut(features), True
    for i in range(n):
        # one row for each of the two categories
        low = [r["v"] for r in features.groupBy(f"w_{i}").agg(F.min(f"v_{i}").alias("v")).orderBy("v").limit(2).collect()]
        if len(low) == 2:
            apart &= (sum(low) if metric == "manhattan" else math.hypot(*low)) > eps
    if apart:
        steps = [(F.col(f"w_{i}") * F.lit(4 * eps)).alias(f"f_{len(spec.f_cols) + i}") for i in range(n)]
        cols = [f"f_{i}" for i in range(len(spec.f_cols) + n)]
        return dbscan_labels(features.select(id_col, *spec.f_cols, *steps), id_col, cols, eps, min_samples, metric)
    from .pairs import pair_table

    rows = cut(number_rows(features, [F.col(id_col)], "cid"))
    x_cols = [*spec.f_cols, *[f"{c}_{i}" for i in range(n) for c in "wv"]]
    pairs = pair_table(rows.select("cid", *x_cols), x_cols, metric, rows.count(), n).filter(F.col("d") <= eps)
    found = dbscan_pairs(rows.select(F.col("cid").alias("id")), pairs.withColumnRenamed("d", "distance"), eps, min_samples)
    return rows.select("cid", id_col).join(found.withColumnRenamed("id", "cid"), "cid").select(id_col, LABEL)


def _check(eps, min_samples):
    if not eps > 0:
        raise ValueError("eps must be above 0")
    if not isinstance(min_samples, int) or min_samples < 1:
        raise ValueError("min_samples must be a positive whole number")


def dbscan_labels(
    features: DataFrame, id_col: str, f_cols: list[str], eps: float, min_samples: int, metric: str = "euclidean"
) -> DataFrame:
    rows = features.select(
        F.col(id_col).alias("id"), *[F.col(f).alias(f"x_{i}") for i, f in enumerate(f_cols)]
    )
    plane = _Plane(len(f_cols), float(eps), metric)
    if metric != "cosine":
        return _labels(rows, plane, min_samples).withColumnRenamed("id", id_col)
    # on unit rows 1 - cos <= eps is a chord of at most sqrt(2 eps)
    rows = cut(unit_length(rows, plane.cols))
    empty = all_zero(plane.cols)
    zeros, others = rows.filter(empty), rows.filter(~empty)
    chord = _Plane(len(f_cols), math.sqrt(2 * eps), "euclidean")
    if zeros.isEmpty():
        return _labels(others, chord, min_samples).withColumnRenamed("id", id_col)
    # an all-zero row is exactly 1 away from every other row
    if eps >= 1:
        label = 0 if rows.count() >= min_samples else NOISE
        return rows.select(F.col("id").alias(id_col), F.lit(label).alias(LABEL))
    if min_samples > 1:
        found = _labels(others, chord, min_samples) if not others.isEmpty() else None
        alone = zeros.select("id", F.lit(NOISE).alias(LABEL))
        found = alone if found is None else found.unionByName(alone)
        return found.withColumnRenamed("id", id_col)
    # every row is core: zero rows are clusters of their own, numbered among the rest
    comps = zeros.select("id", F.col("id").alias("comp"))
    if not others.isEmpty():
        firsts = _labels(others, chord, 1)
        heads = firsts.groupBy(LABEL).agg(F.min("id").alias("comp"), F.count(F.lit(1)).alias("_n"))
        comps = comps.unionByName(attach(firsts, cut(heads), [LABEL], "_n").select("id", "comp"))
    return _numbered(comps).withColumnRenamed("id", id_col)


def _labels(rows: DataFrame, plane: _Plane, min_samples: int) -> DataFrame:
    if plane.dims > BOX_COLUMNS:
        return _numbered(block_components(rows, plane.cols, plane.eps, plane.metric, min_samples))
    if plane.dims > GRID_DIMS * GRID_LEVELS:
        shared = rows.select(_cell(plane, plane.side).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        seen = shared.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n")).first()
        if seen["cells"] and seen["n"] < CROWD * seen["cells"]:
            return _numbered(block_components(rows, plane.cols, plane.eps, plane.metric, min_samples))
    placed = rows.select("id", *plane.cols, _cell(plane, plane.side).alias("cell"))
    grid = [F.floor(F.min(c) / plane.side).cast("long").alias(f"k_{i}") for i, c in enumerate(plane.cols)]
    cells = cut(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *plane.box(), *grid))
    shape = cells.agg(
        F.count(F.lit(1)).alias("n"),
        *[(F.max(f"k_{i}") - F.min(f"k_{i}")).alias(f"s{i}") for i in range(plane.dims)],
    ).first()
    n_cells = shape["n"]
    pairs = cut(_near_cells(cells, plane, [shape[f"s{i}"] or 0 for i in range(plane.dims)]))

    # rows of every cell that lies wholly within eps of the whole cell
    near = pairs.groupBy(F.col("a").alias("cell")).agg(
        F.sum(F.when(F.col("whole"), F.col("b_n")).otherwise(0)).alias("_near")
    )
    status = cells.select("cell", "n").join(near, "cell").select(
        "cell", "n", (F.col("_near") >= min_samples).alias("sure")
    )
    placed = cut(attach(placed, status, ["cell"], "n", small_rows=n_cells))
    open_rows = placed.filter(~F.col("sure"))
    degrees = _degrees(open_rows, placed, pairs, plane)
    judged = cut(
        open_rows.join(degrees, "id").select("id", *plane.cols, "cell", "n", (F.col("degree") >= min_samples).alias("core"))
    )
    core = placed.filter("sure").drop("sure").unionByName(judged.filter("core").drop("core"))
    core_cells = cut(
        core.groupBy("cell").agg(
            F.min("id").alias("node"), F.count(F.lit(1)).alias("core_n"), F.first("n").alias("n"), *plane.box()
        )
    )
    comps = cut(_components(core, core_cells, pairs, plane))
    found = attach(
        core.select("id", "cell"), comps.select("cell", "comp", "core_n"), ["cell"], "core_n", small_rows=n_cells
    ).select("id", "comp")
    others = judged.filter(~F.col("core")).drop("core")
    border = _border(others, core, comps, pairs, plane)
    return _numbered(found.unionByName(others.select("id").join(border, "id", "left")), n_cells)


def _numbered(comps: DataFrame, bound: int | None = None) -> DataFrame:
    """Turn ``id, comp`` into ``id, cluster_label`` by the order of ``comp``.

    Rows without a component are noise; ``bound`` limits the component count.
    """
    comps = cut(comps)
    sizes = comps.filter("comp IS NOT NULL").groupBy("comp").agg(F.count(F.lit(1)).alias("_n"))
    names = number_rows(sizes, [F.col("comp")], LABEL)
    label = F.coalesce(F.col(LABEL), F.lit(NOISE)).cast("int")
    return attach(comps, names, ["comp"], "_n", "left", bound).select("id", label.alias(LABEL))


def _cell(plane: _Plane, side: float):
    # text, so that it is exact for any number of columns
    return F.expr("concat_ws(',', " + ", ".join(f"CAST(floor({c} / {num(side)}) AS STRING)" for c in plane.cols) + ")")


def _pivots(cells: DataFrame, plane: _Plane) -> list[list[float]]:
    """A few points far from each other, picked one by one among the middles of the cells."""
    mids = cells.selectExpr(*[f"(lo_{i} + hi_{i}) / 2 AS x_{i}" for i in range(plane.dims)])
    first = mids.agg(*[F.avg(c).alias(c) for c in plane.cols]).first()
    chosen, start = [], [first[c] for c in plane.cols]
    for _ in range(PIVOTS):
        gaps = [distance(plane.cols, [num(v) for v in p], plane.metric) for p in chosen or [start]]
        away = F.least(*gaps) if len(gaps) > 1 else gaps[0]
        far = mids.agg(F.max(F.struct(away.alias("_d"), *plane.cols)).alias("m")).first()["m"]
        if far is None or (chosen and far["_d"] == 0):
            break
        chosen.append([far[c] for c in plane.cols])
    return chosen


def _near_cells(cells: DataFrame, plane: _Plane, spans: list[int]) -> DataFrame:
    """Cell pairs ``a, b, b_n, whole`` with boxes at most eps apart, each way.

    Cells meet through a coarser grid whose squares are at least eps wide, on
    three coordinates at a time: pairs of neighbouring squares are found first and
    refined by the next ones, so no square is ever compared with all. The coordinates are the
    widest columns. If there are more columns than the levels hold, most of the coordinates are the boxes' least distances to
    pivots instead: they take part of every column, and by the triangle inequality
    those of cells with rows within eps differ by at most eps and the diameter of a cell, which is eps.
    """
    order, pivots = sorted(range(plane.dims), key=lambda i: -spans[i]), []
    if plane.dims > GRID_DIMS * GRID_LEVELS:
        pivots = _pivots(cells, plane)
    dims = order[: GRID_DIMS * GRID_LEVELS - len(pivots)] + [f"p{j}" for j in range(len(pivots))]
    levels = [dims[i:i + GRID_DIMS] for i in range(0, len(dims), GRID_DIMS)]
    near = plane.gap() <= plane.eps

    def square(i):
        if isinstance(i, int):
            return F.floor(F.col(f"k_{i}") / F.lit(plane.steps)).cast("long")
        at = [num(v) for v in pivots[int(i[1:])]]
        return F.floor(box_gap(at, at, *plane.corners(""), plane.metric) / F.lit(2 * plane.eps * (1 + 1e-9))).cast("long")

    leaf = cells.select("cell", "n", *plane.box_names, *[square(i).alias(f"q_{i}") for i in dims])
    if pivots:
        # as a table: the optimizer carries an expression of many columns along as a
        # constraint, and doubles it for each of the columns that is renamed
        leaf = table(leaf)
    pairs = None
    for at, level in enumerate(levels):
        last = at == len(levels) - 1
        up = [i for lv in levels[:at] for i in lv]
        here = up + level
        if last:
            nodes = leaf
        else:
            nodes = leaf.groupBy(*[f"q_{i}" for i in here]).agg(
                *[F.min(f"lo_{i}").alias(f"lo_{i}") for i in range(plane.dims)],
                *[F.max(f"hi_{i}").alias(f"hi_{i}") for i in range(plane.dims)],
            )
        kept = [*(["cell", "n"] if last else []), *[f"q_{i}" for i in here]]
        left = nodes.select(*[F.col(c).alias(f"a_{c}") for c in [*kept, *plane.box_names]])
        right = nodes.select(*[F.col(c).alias(f"b_{c}") for c in [*kept, *plane.box_names]])
        if pairs is not None:
            left = pairs.join(left, [f"a_q_{i}" for i in up])
        moves = list(itertools.product((-1, 0, 1), repeat=len(level)))
        shifts = F.explode(F.array(*[F.struct(*[F.lit(m).alias(f"m_{i}") for i, m in zip(level, mv)]) for mv in moves]))
        left = left.withColumn("_mv", shifts)
        for i in level:
            left = left.withColumn(f"_t_{i}", F.col(f"a_q_{i}") + F.col(f"_mv.m_{i}"))
        on = [F.col(f"_t_{i}") == F.col(f"b_q_{i}") for i in level]
        if pairs is not None:
            left = left.select(*[F.col(c).alias(f"_{c}" if c.startswith("b_q_") else c) for c in left.columns])
            on += [F.col(f"_b_q_{i}") == F.col(f"b_q_{i}") for i in up]
        met = left.join(right, on).filter(near)
        if last:
            return met.select(
                F.col("a_cell").alias("a"), F.col("b_cell").alias("b"), "b_n", (plane.reach() <= plane.eps).alias("whole")
            )
        pairs = met.select(*[f"{s}_q_{i}" for s in "ab" for i in here])
    raise AssertionError


def _slotted(rows: DataFrame) -> DataFrame:
    """Spread the rows of a crowded cell over ``slot`` values."""
    slots = F.ceil(F.col("n") / F.lit(SLOT_ROWS)).cast("long")
    return rows.withColumn("slot", F.pmod(F.xxhash64("id"), slots))


def _all_slots(n_col: str):
    last = F.ceil(F.col(n_col) / F.lit(SLOT_ROWS)).cast("long") - 1
    return F.explode(F.sequence(F.lit(0).cast("long"), last))


def _degrees(open_rows: DataFrame, placed: DataFrame, pairs: DataFrame, plane: _Plane) -> DataFrame:
    """``id, degree`` of rows whose cell is not core as a whole."""
    asked = open_rows.select("id", *plane.cols, F.col("cell").alias("a")).join(pairs, "a")
    whole = asked.filter("whole").groupBy("id").agg(F.sum("b_n").alias("m"))
    part = asked.filter(~F.col("whole")).select(
        F.col("id").alias("p_id"), *[F.col(c).alias(f"p_{c}") for c in plane.cols],
        F.col("b").alias("cell"), _all_slots("b_n").alias("slot"),
    )
    targets = _slotted(placed).select("cell", "slot", *[F.col(c).alias(f"t_{c}") for c in plane.cols])
    hits = part.join(targets, ["cell", "slot"]).filter(plane.between("p_", "t_") <= plane.eps)
    counted = hits.groupBy(F.col("p_id").alias("id")).agg(F.count(F.lit(1)).alias("m"))
    return whole.unionByName(counted).groupBy("id").agg(F.sum("m").alias("degree"))


def _components(core: DataFrame, core_cells: DataFrame, pairs: DataFrame, plane: _Plane) -> DataFrame:
    """``core_cells`` with ``comp``, the smallest core row id of the cluster."""
    left = plane.boxed(core_cells, "a", "node", "core_n")
    right = plane.boxed(core_cells, "b", "node", "core_n")
    met = cut(
        pairs.filter("a < b").select("a", "b").join(left, "a").join(right, "b")
        .withColumn("_gap", plane.gap()).filter(F.col("_gap") <= plane.eps)
        .select("a", "b", "a_node", "b_node", "a_core_n", "b_core_n", (plane.reach() <= plane.eps).alias("linked"))
    )
    sure = met.filter("linked").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    maybe = met.filter(~F.col("linked"))
    product = F.col("a_core_n").cast("double") * F.col("b_core_n")
    looks = maybe.agg(F.sum(product), F.max(product)).first()
    if looks[0]:
        if looks[0] > FEW_LOOKS:
            # a pair already joined through other cells needs no look at its rows
            first = cut(connected_components(sure))
            for s in "ab":
                maybe = maybe.join(
                    first.select(F.col("node").alias(f"{s}_node"), F.col("comp").alias(f"{s}_comp")),
                    f"{s}_node", "left",
                )
            maybe = cut(maybe.filter(F.coalesce("a_comp", "a_node") != F.coalesce("b_comp", "b_node")))
        found = _touching(core, maybe, plane, looks[1])
        sure = sure.unionByName(
            maybe.join(found, ["a", "b"]).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        )
    comps = connected_components(sure).select(F.col("node"), F.col("comp"))
    joined = core_cells.join(comps, "node", "left")
    return joined.withColumn("comp", F.coalesce("comp", "node"))


def _touching(core: DataFrame, open_pairs: DataFrame, plane: _Plane, largest: float) -> DataFrame:
    """Those cell pairs ``a, b`` with two core rows within eps."""
    product = F.col("a_core_n").cast("double") * F.col("b_core_n")
    few = open_pairs.filter(product <= PAIR_ROWS).select("a", "b")
    many = open_pairs.filter(product > PAIR_ROWS).select("a", "b")

    def side(s):
        return core.select(F.col("cell").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in plane.cols])

    direct = few.join(side("a"), "a").join(side("b"), "b").filter(plane.between("a_", "b_") <= plane.eps)
    direct = direct.select("a", "b").distinct()
    if largest <= PAIR_ROWS:
        return direct
    many = cut(many)
    if many.isEmpty():
        return direct
    return direct.unionByName(_refine(core, many, plane))


def _refine(core: DataFrame, pairs: DataFrame, plane: _Plane) -> DataFrame:
    """Decide crowded cell pairs by cutting both cells into ever smaller parts.

    A part pair whose boxes are wholly within eps settles its cells, one whose
    boxes are too far apart is dropped, the others are cut again. Parts shrink
    to single points, so the search ends with the exact answer.
    """
    wanted = pairs.select(F.col("a").alias("cell")).union(pairs.select("b")).distinct()
    rows = cut(core.join(wanted, "cell", "left_semi"))
    front = pairs.select("a", "b", F.col("a").alias("a_part"), F.col("b").alias("b_part"))
    side, hits = plane.side, None
    while True:
        finer = side / SPLIT
        parts = cut(
            rows.groupBy("cell", _cell(plane, side).alias("part"), _cell(plane, finer).alias("next")).agg(*plane.box())
        )

        def half(s):
            return parts.select(
                F.col("cell").alias(s), F.col("part").alias(f"{s}_part"), F.col("next").alias(f"{s}_next"),
                *[F.col(c).alias(f"{s}_{c}") for c in plane.box_names],
            )

        met = cut(
            front.join(half("a"), ["a", "a_part"]).join(half("b"), ["b", "b_part"])
            .filter(plane.gap() <= plane.eps)
            .select("a", "b", F.col("a_next").alias("a_part"), F.col("b_next").alias("b_part"),
                    (plane.reach() <= plane.eps).alias("hit"))
        )
        new = cut(met.filter("hit").select("a", "b").distinct())
        hits = new if hits is None else hits.unionByName(new)
        front = table(met.drop("hit").join(new, ["a", "b"], "left_anti"))
        if front.isEmpty():
            return hits
        side = finer


def _border(rows: DataFrame, core: DataFrame, comps: DataFrame, pairs: DataFrame, plane: _Plane) -> DataFrame:
    """``id, comp`` of non-core rows near a core row, the lowest cluster winning."""
    boxes = plane.boxed(comps, "b", "comp", "core_n", "n")
    asked = (
        rows.select("id", *plane.cols, F.col("cell").alias("a"))
        .join(pairs.select("a", "b"), "a").join(boxes, "b")
        .filter(plane.point_gap() <= plane.eps)
        .withColumn("_in", plane.point_reach() <= plane.eps)
    )
    inside = asked.filter("_in").select("id", F.col("b_comp").alias("comp"))
    part = asked.filter(~F.col("_in")).select(
        "id", F.col("b_comp").alias("comp"), *[F.col(c).alias(f"p_{c}") for c in plane.cols],
        F.col("b").alias("cell"), _all_slots("b_n").alias("slot"),
    )
    targets = _slotted(core).select("cell", "slot", *[F.col(c).alias(f"t_{c}") for c in plane.cols])
    met = part.join(targets, ["cell", "slot"]).filter(plane.between("p_", "t_") <= plane.eps)
    both = inside.unionByName(met.select("id", "comp"))
    return both.groupBy("id").agg(F.min("comp").alias("comp"))


def dbscan_pairs(ids: DataFrame, pairs: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """DBSCAN over distances the user has: ``ids(id)`` and ``pairs(a, b, distance)``.

    A pair may be given one way or both ways; every id is its own neighbour.
    """
    _check(eps, min_samples)
    near = pairs.filter((F.col("distance") <= eps) & (F.col("a") != F.col("b")))
    # each pair one way; the other way only where it is asked for
    near = cut(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    degree = near.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    nodes = cut(
        ids.select("id").join(degree, "id", "left")
        .select("id", F.coalesce("n", F.lit(0)).alias("n"))
        .withColumn("core", F.col("n") + 1 >= min_samples)
    )
    a_side = nodes.select(F.col("id").alias("a"), F.col("n").alias("a_n"), F.col("core").alias("a_core"))
    b_side = nodes.select(F.col("id").alias("b"), F.col("n").alias("b_n"), F.col("core").alias("b_core"))
    flagged = cut(attach(attach(near, a_side, ["a"], "a_n"), b_side, ["b"], "b_n"))
    linked = flagged.filter("a_core AND b_core").select("a", "b")
    comps = connected_components(linked)
    core = nodes.filter("core").join(comps.withColumnRenamed("node", "id"), "id", "left")
    core = cut(core.select("id", "n", F.coalesce("comp", "id").alias("comp")))
    reached = flagged.filter("a_core <> b_core").select(
        F.expr("if(a_core, b, a)").alias("id"), F.expr("if(a_core, a, b)").alias("b")
    )
    heads = core.select(F.col("id").alias("b"), "comp", "n")
    border = attach(reached, heads, ["b"], "n").groupBy("id").agg(F.min("comp").alias("comp"))
    rest = nodes.filter(~F.col("core")).select("id").join(border, "id", "left")
    return _numbered(core.select("id", "comp").unionByName(rest))
