import random
from collections import Counter

import numpy as np
import pytest

from spindrift.llm import induced, suffixdedup


def brute_places(parts, span):
    counts = Counter(p[i:i + span] for p in parts for i in range(len(p) - span + 1))
    return [[counts[p[i:i + span]] > 1 for i in range(len(p) - span + 1)] for p in parts]


def brute(texts, span):
    out = []
    for data, hit in zip(texts, brute_places(texts, span)):
        covered = bytearray(len(data))
        for i, h in enumerate(hit):
            if h:
                covered[i:i + span] = b"\1" * span
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((len(data), bytes(b for b, c in zip(data, covered) if not c), spans))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_induced_sorting_in_little_memory(tmp_path, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(induced, "PIECE", rng.choice([1, 3, 50]))
    for _ in range(25):
        letters, span = rng.choice([1, 2, 3, 5, 256]), rng.choice([1, 2, 3, 8, 20])
        parts = [bytes(rng.randrange(letters) for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 8))]
        parts += [p[rng.randrange(len(p)):] + parts[0][:9] for p in parts if p]
        stats = {}
        found = induced.repeated(parts, span, tmp_path.as_uri(), rng.choice([4, 10**6]), rng.choice([5, 10**6]), stats)
        assert [f.tolist() for f in found] == brute_places(parts, span)
    assert not list(tmp_path.rglob("*/*"))


def test_recursion_and_files_are_used(tmp_path):
    parts = [(b"abracadabra " * 20 + bytes([65 + i]) * 3) for i in range(12)]
    stats = {}
    found = induced.repeated(parts, 30, tmp_path.as_uri(), 4, 50, stats)
    assert [f.tolist() for f in found] == brute_places(parts, 30)
    assert stats["levels"] > 2 and stats["spilled"] > 0


def test_regions_partition_the_places():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 3, n).astype(np.uint8).tobytes() for n in (40, 41, 500, 3_000)] + [b"x" * 2_000]
    doc, _, start, places, _ = suffixdedup.regions(texts, 40, suffixdedup.Powers(10_000))
    for i, t in enumerate(texts):
        covered = [p for s, n in zip(start[doc == i], places[doc == i]) for p in range(s, s + n)]
        assert covered == list(range(len(t) - 39)) and places.max() <= 40


def removed(df, **how):
    return suffixdedup.remove_repeats(df, **how)


def test_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab é") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(30)) for _ in range(4)]
    texts = ["", None, "short", "x" * 5_000, passages[0], passages[0], passages[0] + "!"]
    texts += ["ab" * 500, "𝔘" * 300]
    for _ in range(60):
        texts.append(" ".join(rng.choice([word(), word(), rng.choice(passages)[rng.randrange(9):]]) for _ in range(rng.randrange(12))))
    df = spark.createDataFrame([(i % 50, t, 1, 2, "a") for i, t in enumerate(texts)], "doc_id long, text string, r1 long, spans int, anchor string")
    want = Counter((i % 50, *w) for i, w in enumerate(brute([(t or "").encode() for t in texts], 40)))
    for how in ({}, {"shard_bytes": 200, "in_memory": 10, "held": 100}):
        found = removed(df.repartition(4), span=40, **how).collect()
        assert Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in found) == want


def test_odd_tables(spark, odd_documents, no_documents):
    assert removed(no_documents).count() == 0
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in odd_documents.collect()]
    want = Counter((i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows], 400)))
    found = removed(odd_documents).collect()
    assert Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in found) == want


def test_repeated_rows_lose_all(spark):
    df = spark.createDataFrame([(1, "abc" * 20), (1, "abc" * 20), (None, "def ghi " * 3)], "doc_id long, text string")
    assert sorted(len(r["kept"]) for r in removed(df, span=30).collect()) == [0, 0, 24]
