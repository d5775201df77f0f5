import itertools
import random

import numpy as np
import pytest
from pyspark.sql import Row
from spindrift.llm import neardup as nd


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5_000)}" for _ in range(n)]


def classes(texts):
    shingle = nd.Shingler()
    sets = {i: shingle(t or "") for i, t in texts}
    root = {i: i for i, _ in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(texts, 2):
        if (a or "") == (b or "") or len(sets[i][0]) and nd.probability_jaccard(sets[i], sets[j]) >= nd.SIMILARITY:
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return {i: find(i) for i, _ in texts}


def test_registers_agree_with_the_similarity():
    shingle = nd.Shingler()
    a, b = words(300, 1), words(300, 2)
    for share in (0, 100, 200, 290):
        x, y = shingle(" ".join(a)), shingle(" ".join(a[:share] + b[share:]))
        s = nd.signatures([x, y], 4_000)
        assert abs((s[0] == s[1]).mean() - nd.probability_jaccard(x, y)) < 0.04
    # weights count
    x, y = (np.array([1, 2], np.uint64), np.array([9, 1])), (np.array([1, 2], np.uint64), np.array([1, 9]))
    s = nd.signatures([x, y], 4_000)
    assert abs((s[0] == s[1]).mean() - nd.probability_jaccard(x, y)) < 0.04


def test_probability_jaccard_by_its_formula():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.integers(0, 4, 12), rng.integers(0, 4, 12)
        want = sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in range(12)) for d in range(12) if a[d] and b[d])
        items = np.arange(12, dtype=np.uint64)
        got = nd.probability_jaccard((items[a > 0], a[a > 0]), (items[b > 0], b[b > 0]))
        assert abs(got - want) < 1e-9


@pytest.mark.parametrize("few", [20, 0])
def test_classes_equal_those_of_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(nd, "FEW", few)
    texts = []
    for family in range(6):
        text = words(120, family)
        for k in range(8):
            copy = list(text)
            rng = random.Random(100 * family + k)
            for _ in range(k % 4):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append((len(texts), " ".join(copy)))
    texts += [(100 + i, t) for i, t in enumerate(["", None, "!!", "!!", "a b", "a b", "a b c d e f g", "A, b c d e f g!"])]
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in texts], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(df).collect()}
    want = classes([(i, t) for i, t in texts])
    want[107] = 106  # the same words
    assert got == want


def test_texts_that_are_only_somewhat_alike_make_no_pairs(spark, monkeypatch):
    # copies at a similarity of about 0.76, most of them too far from each other for a link
    n, base, texts = 100, words(300, 1), []
    for k in range(n):
        copy, rng = list(base), random.Random(k)
        for at in rng.sample(range(10), 4):
            copy[30 * at + rng.randrange(5, 25)] = f"x{k}"
        texts.append((k, " ".join(copy)))
    made, similarities = [], nd._similarities

    def counted(pairs, *args):
        made.append(pairs.count())
        return similarities(pairs, *args)

    monkeypatch.setattr(nd, "_similarities", counted)
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in texts], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in nd.near_duplicates(df).collect()} == classes(texts)
    assert sum(made) < 20 * n, made


@pytest.mark.parametrize("tile", [512, 3])
def test_ids_with_different_texts(spark, monkeypatch, tile):
    monkeypatch.setattr(nd, "FEW", 10**6)
    monkeypatch.setattr(nd, "TILE", tile)
    texts = []
    for family in range(2):
        base = words(200, family)
        for k in range(9):
            copy, rng = list(base), random.Random(10 * family + k)
            for _ in range(3):
                copy[rng.randrange(200)] = f"x{k}"
            texts.append((10 * family + k, " ".join(copy)))
    # one id has a text of each family, so its class is the smaller one of theirs
    rows = texts + [(50, texts[0][1] + " end"), (50, texts[9][1] + " end")]
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(df).collect()}
    apart = classes(texts)
    joined = {apart[0], apart[10]} if 10 in apart else {apart[0]}
    assert got[50] == min(joined)
    assert all(got[i] == (min(joined) if apart[i] in joined else apart[i]) for i, _ in texts)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(df).collect()}
    assert got == classes([(r.doc_id, r.text) for r in df.collect()])
    kept = nd.drop_near_duplicates(df)
    assert {r.doc_id for r in kept.collect()} == set(got.values()) and kept.count() == len(set(got.values()))


def test_odd_rows(odd_documents, no_documents):
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(odd_documents).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8, 10: 1, 11: 11, 12: 12, 13: 3}
    kept = nd.drop_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == sorted(
        [(False, 0), *((True, i) for i in set(got.values()))]
    )
    assert nd.near_duplicates(no_documents).collect() == [] and nd.drop_near_duplicates(no_documents).collect() == []
