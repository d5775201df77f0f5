"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed once for each cell of source, language and topic. The cell table is
raked: its weights are scaled to each marginal in turn until all marginals fit, and what a
value can't give is asked of the others. Documents
are then drawn with the cell's weight as probability. SQL expressions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.cut import table

MOST_SWEEPS = 40
TOLERANCE = 1e-12  # of the kept total, over all marginals
FEW_CELLS = 100_000  # up to which a task may hold all cells of a value
SWEEPS_AT_ONCE = 4  # of so few cells, between writes
KEEP_SHARE = 0.5
TEMPER = 0.7

# fixed values: cue words of the topics, the first that matches counts
TOPIC_CUES = [
    ("licence", r"(?i)licen[cs]e|copyright|all rights reserved"),
    ("secrets", r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{12}"),
    ("contact", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z]{2}"),
]


def topic_of(text: Column) -> Column:
    """A topic from the text: by cue words, else by its form (note, list or prose)."""
    text = F.coalesce(text, F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    found = F
    for name, cue in TOPIC_CUES:
        found = found.when(text.rlike(cue), name)
    return (
        found.when(F.length(text) < 200, "note")
        .when(F.length(text) / lines < 60, "list")
        .otherwise("prose")
    )


def count_tokens(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def tempered_targets(cells: DataFrame, dim: str, power: float = TEMPER) -> DataFrame:
    """``dim, share``: token shares raised to ``power``, adding up to 1; values without tokens have none."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("_t")).filter("_t > 0")
    sums = sums.select(dim, F.pow(F.col("_t").cast("double"), F.lit(power)).alias("_p"))
    return sums.crossJoin(sums.agg(F.sum("_p").alias("_all"))).select(dim, (F.col("_p") / F.col("_all")).alias("share"))


def _reachable(values: DataFrame, dim: str, keep: float) -> tuple[DataFrame, float]:
    """``dim, _goal`` and their sum: ``keep`` shared out in proportion to ``share``, none above ``_cap``.

    What a value can't hold is handed on to those with room. The driver sees two sums a round;
    each round fills at least one more value.
    """
    total = values.agg(F.sum("share")).first()[0] or 0.0
    scale = keep / total if total else 0.0
    while True:
        full = F.col("_cap") <= F.col("share") * scale
        sums = values.agg(F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("share")))).first()
        filled, room = sums[0] or 0.0, sums[1] or 0.0
        if not room or (keep - filled) / room <= scale * (1 + 1e-12):
            break
        scale = (keep - filled) / room
    goal = table(values.select(dim, F.least(F.col("_cap"), F.col("share") * scale).alias("_goal")))
    return goal, goal.agg(F.sum("_goal")).first()[0] or 0.0


def _scaled_to(state: DataFrame, dim: str, few: bool) -> DataFrame:
    """``state`` with ``_kept`` scaled so that its sums by ``dim`` are ``_goal_<dim>``, as far as ``_cap`` allows.

    Sums come by a window where the whole table is small, else by an aggregate joined to the cells.
    """
    full, columns = F.col("_kept") >= F.col("_cap") * (1 - 1e-12), state.columns
    held, free = F.sum(F.when(full, F.col("_kept")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("_kept")))
    if few:
        beside = Window.partitionBy(dim)
        state = state.select("*", held.over(beside).alias("_held"), free.over(beside).alias("_free"))
    else:
        state = state.join(state.groupBy(dim).agg(held.alias("_held"), free.alias("_free")), dim)
    goal = F.col(f"_goal_{dim}")
    hold, now = (goal >= F.col("_held")) & (F.col("_free") > 0), F.col("_held") + F.col("_free")
    factor = F.when(hold, (goal - F.col("_held")) / F.col("_free")).when(now > 0, F.least(F.lit(1.0), goal / now)).otherwise(0.0)
    kept = F.when(full & hold, F.col("_kept")).otherwise(F.least(F.col("_kept") * factor, F.col("_cap"))).alias("_kept")
    return state.select(*[kept if c == "_kept" else F.col(c) for c in columns])


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], weight: str = "tokens", keep_share: float = KEEP_SHARE,
) -> DataFrame:
    """``cells`` with ``probability``: the raked share of each cell's weight.

    ``targets[dim]`` holds ``dim, share``, taken in proportion to their sum; ``cells[dim]`` may not be null.
    First each marginal's goals are made reachable: a value too rare for its share keeps all
    it has, and its missing weight is shared out among the others in proportion. Values without
    a target get 0, and targets of values without cells are handed on too. If a marginal can't reach
    ``keep_share`` in this way, the smallest sum that one reaches is kept instead.

    A sweep then scales the kept weights to each marginal in turn. Cells that keep all they have are
    held while the value's other cells can make up the goal. It ends when the kept weights
    differ from all goals by no more than ``TOLERANCE`` of the total, or after ``MOST_SWEEPS``
    where caps and marginals contradict each other; ``reached`` tells what came of it.
    """
    total = cells.agg(F.sum(weight).cast("double").alias("_total"))
    part = F.coalesce(F.col(weight) / F.when(F.col("_total") > 0, F.col("_total")), F.lit(0.0))
    state = table(cells.crossJoin(total).withColumn("_cap", part).withColumn("_kept", part * keep_share).drop("_total"))
    values = {
        dim: table(state.groupBy(dim).agg(F.sum("_cap").alias("_cap")).join(t, dim, "left").select(dim, "_cap", F.coalesce("share", F.lit(0.0)).alias("share")))
        for dim, t in targets.items()
    }
    found = {dim: _reachable(v, dim, keep_share) for dim, v in values.items()}
    keep = min((reach for _, reach in found.values()), default=keep_share)
    if any(reach - keep > TOLERANCE for _, reach in found.values()):
        found = {dim: _reachable(v, dim, keep) for dim, v in values.items()}
    for dim, (goal, _) in found.items():
        state = state.join(goal.withColumnRenamed("_goal", f"_goal_{dim}"), dim)
    state = table(state)
    few = state.count() <= FEW_CELLS
    sweeps = 0
    while found and sweeps < MOST_SWEEPS:
        for _ in range(SWEEPS_AT_ONCE if few else 1):
            for dim in found:
                state = _scaled_to(state, dim, few)
                if not few:
                    # here a step reads the state twice
                    state = table(state)
            sweeps += 1
        if few:
            state = table(state)
        off = [state.groupBy(dim).agg(F.abs(F.sum("_kept") - F.first(f"_goal_{dim}")).alias("_off")).select("_off") for dim in found]
        if (reduce(DataFrame.unionByName, off).agg(F.sum("_off")).first()[0] or 0.0) <= TOLERANCE * keep:
            break
    probability = F.when(F.col("_cap") > 0, F.col("_kept") / F.col("_cap")).otherwise(0.0)
    return state.select(*cells.columns, probability.alias("probability"))


def reached(raked: DataFrame, targets: dict[str, DataFrame], weight: str = "tokens") -> DataFrame:
    """dim, value, target, share: the share asked for and that of the expected kept weight, for each value of each marginal.

    ``raked`` is what ``rake`` returns. Values without a target have 0 there; targets without cells a share of 0.
    """
    out = []
    for dim, t in targets.items():
        have = raked.groupBy(dim).agg(F.sum(F.col(weight) * F.col("probability")).alias("_kept"))
        asked = t.crossJoin(t.agg(F.sum("share").alias("_all"))).select(dim, (F.col("share") / F.col("_all")).alias("target"))
        whole = raked.agg(F.sum(F.col(weight) * F.col("probability")).alias("_whole"))
        share = F.coalesce(F.col("_kept") / F.when(F.col("_whole") > 0, F.col("_whole")), F.lit(0.0))
        out.append(have.join(asked, dim, "full").crossJoin(whole).select(
            F.lit(dim).alias("dim"), F.col(dim).cast("string").alias("value"), F.coalesce("target", F.lit(0.0)).alias("target"), share.alias("share")
        ))
    return reduce(DataFrame.unionByName, out)


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
    topic: Column | None = None, targets: dict[str, DataFrame] | None = None, seed: str = "mix",
) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept of each row of ``df``.

    A row's probability is that of its cell (see ``rake``), so the expected tokens of the kept rows
    have the target marginals. ``kept`` compares it with a number in [0, 1) made from the
    id by MD5: equal ids are kept or dropped together, in any run.

    Null sources, languages and ids form a value of their own, written as ''. Null and blank
    texts have no tokens and probability 1: they don't weigh on the mix. ``targets`` (``dim,
    share`` for source, lang, topic) defaults to tempered shares of the table itself.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    dims = ["source", "lang", "topic"]
    rows = df.select(
        F.col(id_col).alias("doc_id"), blank(source_col).alias("source"), blank(lang_col).alias("lang"),
        (topic_of(F.col(text_col)) if topic is None else F.coalesce(topic.cast("string"), F.lit(""))).alias("topic"),
        count_tokens(F.col(text_col)).alias("tokens"),
    )
    # texts are read and searched once
    rows = table(rows)
    cells = table(rows.groupBy(*dims).agg(F.sum("tokens").alias("tokens")))
    goals = targets or {d: tempered_targets(cells, d) for d in dims}
    odds = rake(cells, goals).select(*dims, F.col("probability").alias("_p"))
    at = F.conv(F.substring(F.md5(F.concat(F.lit(seed), blank("doc_id"))), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return rows.join(odds, dims).select(
        "doc_id", *dims, "tokens",
        F.when(F.col("tokens") > 0, F.col("_p")).otherwise(1.0).alias("probability"),
    ).withColumn("kept", at < F.col("probability"))


def keep_mixed(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df``, all columns, that ``mix`` keeps; equal ids stay or go together."""
    kept = mix(df, id_col, **options).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return df.join(kept, df[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")
