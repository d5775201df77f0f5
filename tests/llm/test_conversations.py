import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spindrift.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string, depth long, k1 long, pos long, length int, part string"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    whole = {}
    for c in turns:
        own = [t[2:] for t in sorted(turns[c])]
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole[c] = [t[2:] for t in sorted(turns.get(base, []))][:h] + own[h:]
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    leaves, saved, kids = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path in members:
        cost = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += cost
    return sorted(
        (
            min(m), len(path), min(members[path[:-1]]) if path else -1, len(m), kids[path], leaves[path], saved[path],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(path)).encode()).hexdigest(),
        )
        for path, m in members.items()
    )


def trie(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "p") for r in rows], SCHEMA).repartition(5)
    found = conv.prefix_trie(df).fillna({"parent_conv_id": -1})
    return sorted(tuple(r) for r in found.collect())


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for c in [*range(60), -7, -1, 1000]:
        for t in range(rng.choice([0, 1, 3, 9, 12])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", ""])))
    rows += [
        (None, 0, "user", "no conversation"), (3, None, None, None), (3, 2, None, "x"), (3, 2, "user", "x"), (3, 2, "user", "x"),
        (2_000, 0, "user", "y" * 5_000), (70, 0, "ab", "c"), (75, 0, "a", "bc"),
    ]
    assert trie(spark, rows) == brute(rows)


def test_long_conversation_and_chains_of_rulers(spark, monkeypatch):
    monkeypatch.setattr(conv, "LAST_ARCS", 10)
    rows = [(5, t, "user", f"turn {t}") for t in range(300)] + [(c, t, "user", f"turn {t}") for c in (6, 7, 8) for t in range(20)]
    assert trie(spark, rows) == brute(rows)


def test_no_conversations(spark):
    assert trie(spark, []) == []


@pytest.mark.parametrize("n", [1, 5, 400])
def test_list_ranks(spark, monkeypatch, n):
    monkeypatch.setattr(conv, "LAST_ARCS", 20)
    arcs = list(range(n))
    random.Random(n).shuffle(arcs)
    links = [(a, b, i % 3) for i, (a, b) in enumerate(zip(arcs, [*arcs[1:], None]))]
    want, rank = {}, 0
    for a, b, d in reversed(links):
        rank += d if b is not None else 0
        want[a] = rank
    found = conv.list_ranks(spark.createDataFrame(links, "arc long, to long, dist long"))
    assert {r["arc"]: r["rank"] for r in found.collect()} == want


def test_running_totals_cross_partitions(spark):
    rows = [(i // 40, i, i * 7 + 1) for i in range(200)]
    df = spark.createDataFrame(rows, "g long, i long, v long").withColumn("w", F.col("v")).repartition(7)
    found = {r["i"]: (r["v"], r["w"]) for r in conv.running(df, [F.col("g"), F.col("i")], "g", ["v"], ["w"]).collect()}
    x = s = 0
    for g, i, v in rows:
        x, s = (v, v) if i % 40 == 0 else (x ^ v, s + v)
        assert found[i] == (x, s)
