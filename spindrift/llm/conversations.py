"""Prefix trie of conversations, measured by an Euler tour.

Conversations that start alike share nodes. A node is known by its depth and the combined
hashes of the turns that lead to it. Each node gives two arcs, one entered and one left; the
arcs form one list, from the root's first to its last (Tarjan and Vishkin, 1985). Ranking that list
gives every arc its place in the tour, and what a subtree holds is then the difference of two
prefix sums.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.cut import cut, table
from ..plans.numbering import number_rows
from ..plans.skew import attach

BLOCK = 5         # conversations of one block share their first turns
MOST_SHARED = 8   # turns at most
RULERS = 16       # one arc in so many is a ruler
LAST_ARCS = 50_000  # a list of so few arcs is walked by one task


# -- scans over a sorted table ----------------------------------------------


def running(df: DataFrame, order: list[Column], key: str | None, xors: list[str], sums: list[str]) -> DataFrame:
    """``df`` with each column of ``xors`` and ``sums`` replaced by its running total up to the row.

    Rows are range-partitioned in ``order``; totals start anew where ``key`` (a column of whole numbers
    by which the order starts) changes. A group may span any number of partitions: only one row a
    partition, the total of its last group, is gathered.
    """
    ordered = cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    names, n_xor = [*xors, *sums], len(xors)

    def scan(batch, carry, last):
        """Running totals of a batch, and the totals and key to carry on."""
        n = batch.num_rows
        keys = np.zeros(n, np.int64) if key is None else batch.column(key).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[last is None or keys[0] != last, keys[1:] != keys[:-1]])
        out = []
        for i, name in enumerate(names):
            v = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
            op = np.bitwise_xor if i < n_xor else np.add
            total = op.accumulate(v)
            before = np.full(n, carry[i], np.int64)
            if i < n_xor:
                total ^= carry[i]
                if len(starts):
                    at = np.repeat(starts, np.diff(np.r_[starts, n]))
                    total[starts[0]:] ^= (total[at] ^ v[at])
            else:
                total += before
                if len(starts):
                    at = np.repeat(starts, np.diff(np.r_[starts, n]))
                    total[starts[0]:] -= (total[at] - v[at])
            out.append(total)
        return out, keys

    def tails(batches):
        carry, first, last, alone = [0] * len(names), None, None, True
        for batch in batches:
            if batch.num_rows:
                out, keys = scan(batch, carry, last)
                first = int(keys[0]) if first is None else first
                last, alone = int(keys[-1]), alone and bool((keys == first).all())
                carry = [int(t[-1]) for t in out]
        if first is not None:
            yield pa.RecordBatch.from_pylist([
                {"part": TaskContext.get().partitionId(), "first": first, "last": last, "alone": alone, "carry": carry}
            ], schema=pa.schema([("part", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("alone", pa.bool_()),
                                 ("carry", pa.list_(pa.int64()))]))

    used = ordered.select(*([key] if key else []), *names)
    rows = used.mapInArrow(tails, "part int, first long, last long, alone boolean, carry array<bigint>").collect()
    begin, carry, last = {}, [0] * len(names), None
    for r in sorted(rows, key=lambda r: r["part"]):
        begin[r["part"]] = (carry, last)
        goes_on = r["alone"] and r["first"] == last
        carry = [
            (a ^ b if i < n_xor else a + b) if goes_on else b for i, (a, b) in enumerate(zip(carry, r["carry"]))
        ]
        last = r["last"]

    def totals(batches):
        carry, last = begin.get(TaskContext.get().partitionId(), ([0] * len(names), None))
        for batch in batches:
            if not batch.num_rows:
                continue
            out, keys = scan(batch, carry, last)
            carry, last = [int(t[-1]) for t in out], int(keys[-1])
            columns = [
                pa.array(out[names.index(f.name)]) if f.name in names else batch.column(i)
                for i, f in enumerate(batch.schema)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return ordered.mapInArrow(totals, ordered.schema)


def list_ranks(links: DataFrame, level: int = 0) -> DataFrame:
    """arc, rank: the sum of ``dist`` from each arc to the end of the list ``links(arc, to, dist)``; the last arc's ``to`` is null.

    One arc in RULERS is drawn as a ruler. The others jump ahead, twice as far each round, until they
    stand before a ruler; the rulers are then a list of their own, a sixteenth as long, of which others are drawn (``level``).
    """
    links = table(links)
    if links.count() <= LAST_ARCS:
        return links.repartition(1).mapInArrow(_walk, "arc long, rank long")
    ruler = lambda c: F.pmod(F.xxhash64(c, F.lit(level)), F.lit(RULERS)) == 0
    # the end of the list is a ruler too
    end = links.filter("to IS NULL").first()["arc"]
    stops = lambda c: ruler(c) | (c == F.lit(end))
    inner = links.filter("to IS NOT NULL")
    state = inner.withColumn("open", ~stops(F.col("to")))
    while True:
        ahead = state.select(F.col("arc").alias("to"), F.col("to").alias("_to"), F.col("dist").alias("_dist"))
        jumped = state.filter("open").join(ahead, "to").select(
            "arc", F.col("_to").alias("to"), (F.col("dist") + F.col("_dist")).alias("dist"), (~stops(F.col("_to"))).alias("open")
        )
        state = table(state.filter("NOT open").unionByName(jumped))
        if state.filter("open").isEmpty():
            break
    last = links.filter("to IS NULL")
    of_rulers = list_ranks(state.filter(stops(F.col("arc"))).drop("open").unionByName(last), level + 1)
    ranked = state.join(of_rulers.select(F.col("arc").alias("to"), "rank"), "to")
    return ranked.select("arc", (F.col("dist") + F.col("rank")).alias("rank")).unionByName(
        last.select("arc", F.lit(0).cast("long").alias("rank"))
    )


def _walk(batches):
    """Ranks of a short list, from its end."""
    found = [b for b in batches if b.num_rows]
    if not found:
        return
    t = pa.Table.from_batches(found)
    arcs, to = t.column("arc").to_pylist(), t.column("to").to_pylist()
    before = {b: (a, d) for a, b, d in zip(arcs, to, t.column("dist").to_pylist())}
    arc, rank, out = None, 0, []
    while arc in before:
        arc, step = before[arc]
        rank += step if out else 0
        out.append((arc, rank))
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["arc", "rank"])


# -- conversations ----------------------------------------------------------


def turns_in_order(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, role, text) with d from 1, and (conv_id, n, first): the turns and the conversations.

    Turns are ordered by turn, null first, ties by role and text. A conversation of any length is
    numbered by one global order, not in one task.
    """
    rows = df.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = table(number_rows(rows, order, "pos").drop("turn"))
    convs = table(placed.groupBy("conv_id").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")))
    return placed, convs


def rebuilt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, length, role, text) of the rebuilt conversations, and (conv_id, length) of all."""
    placed, convs = turns_in_order(df)
    h = F.crc32(F.col("conv_id").cast("string")) % F.lit(MOST_SHARED + 1)
    base = F.col("conv_id") - F.col("conv_id") % F.lit(BLOCK)
    sized = convs.select("conv_id", "first", "n", h.alias("h"), base.alias("base"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"), F.col("first").alias("base_first"))
    sized = sized.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
    sized = table(sized.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    own = attach(placed, sized.select("conv_id", "first", "n", "h", "shared", "length"), ["conv_id"], "n")
    own = own.withColumn("d", F.col("pos") - F.col("first") + 1).filter("d > h").withColumn("depth", F.col("shared") + F.col("d") - F.col("h"))
    # at most eight turns of a base, each for the few conversations of its block
    spots = sized.filter("shared > 0").select(
        "conv_id", "length", F.explode(F.sequence(F.lit(1).cast("long"), F.col("shared").cast("long"))).alias("depth"), "base_first"
    ).withColumn("pos", F.col("base_first") + F.col("depth") - 1)
    heads = spots.join(placed.select("pos", "role", "text"), "pos")
    cols = ["conv_id", "depth", "length", "role", "text"]
    return own.select(*cols).unionByName(heads.select(*cols)), sized.select("conv_id", "length")


def ends_digests(ends: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ends_sha256: digest of the ids that end at a node, ascending, streamed through one sorted pass."""
    def run(batches):
        at, digest, rows = None, None, []

        def close():
            if at is not None:
                rows.append((*at, digest.hexdigest()))

        for batch in batches:
            ids = batch.column(len(keys)).to_pylist()
            for key, c in zip(zip(*(batch.column(i).to_pylist() for i in range(len(keys)))), ids):
                if key != at:
                    close()
                    at, digest = key, hashlib.sha256(str(c).encode())
                else:
                    digest.update(f",{c}".encode())
            if rows:
                yield made(rows)
                rows = []
        close()
        if rows:
            yield made(rows)

    def made(rows):
        *cols, sha = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in cols), pa.array(sha, pa.string())], names=[*keys, "ends_sha256"]
        )

    sorted_ = ends.select(*keys, "conv_id").repartition(*keys).sortWithinPartitions(*keys, "conv_id")
    return sorted_.mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", ends_sha256 string")


def prefix_trie(df: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations of ``df(conv_id, turn, role, text)``.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. A conversation c is rebuilt from the first h = crc32(c) % 9 turns of
    conversation c - c % 5 and its own turns after its first h.

    Null roles and texts are empty ones; rows with a null conv_id are left out. Turns of equal number are ordered by
    role and text, and repeated rows are turns of their own. Other columns are ignored. An empty table has no root.
    """
    turns, convs = rebuilt(df)
    part = lambda seed: F.xxhash64(F.lit(seed), F.col("depth"), F.col("role"), F.col("text"))
    hashed = turns.select(
        "conv_id", "depth", "length", F.octet_length("text").cast("long").alias("bytes"),
        part(1).alias("k1"), part(2).alias("k2"), part(1).alias("o1"), part(2).alias("o2"),
    )
    # the turns' hashes hold their depths, so that equal combinations mean equal sequences
    paths = table(running(hashed, [F.col("conv_id"), F.col("depth")], "conv_id", ["k1", "k2"], []))
    zero, xor = F.lit(0).cast("long"), lambda a, b: F.col(a).bitwiseXOR(F.col(b))
    root = convs.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("bytes")
    )
    nodes = paths.groupBy("depth", "k1", "k2", xor("k1", "o1").alias("p1"), xor("k2", "o2").alias("p2")).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes")
    )
    order = [F.col(c) for c in ("depth", "p1", "p2", "k1", "k2")]
    nodes = table(number_rows(root.unionByName(nodes), order, "node"))

    # brothers are neighbours in that order
    family = nodes.filter("depth > 0").groupBy("depth", "p1", "p2").agg(
        F.count(F.lit(1)).alias("n_children"), F.min("node").alias("first"), F.max("node").alias("last")
    )
    above = family.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children", "first", "last")
    nodes = table(nodes.join(above, ["depth", "k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", zero)))
    up = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("last").alias("last_brother"), F.col("n_children").alias("_n"),
    )
    nodes = table(
        attach(nodes.filter("depth > 0"), up, ["depth", "p1", "p2"], "_n").drop("_n")
        .unionByName(nodes.filter("depth = 0"), allowMissingColumns=True)
    )

    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    save = (F.col("n_convs") - 1) * F.col("bytes")
    after = F.when(F.col("parent").isNull(), F.lit(None)).when(F.col("node") == F.col("last_brother"), F.col("parent") * 2 + 1).otherwise((F.col("node") + 1) * 2)
    two = F.array(
        F.struct(enter.alias("arc"), F.coalesce(F.col("first") * 2, leave).alias("to"), (F.col("n_children") == 0).cast("long").alias("leaves"), save.alias("saved")),
        F.struct(leave.alias("arc"), after.alias("to"), zero.alias("leaves"), zero.alias("saved")),
    )
    arcs = table(nodes.select(F.inline(two)))
    ranks = list_ranks(arcs.select("arc", "to", F.lit(1).cast("long").alias("dist")))
    placed = arcs.select("arc", "leaves", "saved").join(ranks, "arc")
    tour = running(placed, [F.col("rank").desc()], None, [], ["leaves", "saved"])
    left = (F.col("arc") % 2) == 1
    signed = lambda c: F.sum(F.when(left, F.col(c)).otherwise(-F.col(c))).alias(f"_{c}")
    held = tour.groupBy(F.shiftright("arc", 1).alias("node")).agg(signed("leaves"), signed("saved"))

    keys = ["depth", "k1", "k2"]
    ends = paths.filter("depth = length").select(*keys, "conv_id").unionByName(
        convs.filter("length = 0").select(*[zero.alias(k) for k in keys], "conv_id")
    )
    digests = ends_digests(ends, keys)
    return nodes.join(held, "node").join(digests, keys, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        # the sums between entering and leaving lack the node itself
        (F.col("_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("_saved") + save).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
