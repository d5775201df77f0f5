import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from spindrift.llm import mixing, sharding


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_bucket_is_the_published_function(spark):
    keys = [0, 1, 2, 17, 10**12, -1, -(2**63), 2**63 - 1, *range(1000, 1200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 16, 17, 1000, 2**31 - 1):
        got = df.select("k", sharding.jump_bucket(F.col("k"), n).alias("b")).collect()
        assert all(r.b == jump(r.k % 2**64, n) for r in got)


def test_shards_of_odd_rows(odd_documents, no_documents):
    rows = sharding.shard_rows(odd_documents, shards=3).collect()
    assert len(rows) == odd_documents.count()
    text = {r.doc_id: r.text for r in odd_documents.collect()}
    for r in rows:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert r.shard == jump(r.doc_id or 0, 3) and r.grown_shard in (r.shard, 3)
    for s in range(3):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard_rows(no_documents).collect() == []


def test_slots_have_no_gaps_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 10)
    df = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = sharding.shard_rows(df, shards=4).toPandas()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_rows_of_one_id_are_spread_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 10)
    monkeypatch.setattr(sharding, "COPIES", 7)
    df = spark.range(900).select(
        F.when(F.col("id") >= 300, F.col("id")).alias("doc_id"), F.when(F.col("id") < 500, F.concat(F.lit("x"), F.col("id") % 50)).alias("text")
    )
    got = sharding.shard_rows(df.unionByName(df), shards=4).toPandas()
    assert len(got) == 1_800
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_strings_as_keys(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "doc_id string, text string")
    assert {r.shard for r in sharding.shard_rows(df, shards=2).collect()} <= {0, 1}


def test_written_shards_hold_all_rows(spark, odd_documents, tmp_path):
    sharding.write_shards(odd_documents, f"{tmp_path}/s", shards=4)
    assert spark.read.parquet(f"{tmp_path}/s").count() == odd_documents.count()


def test_raking_meets_the_marginals(spark):
    rng = np.random.default_rng(3)
    cells = [(s, l, t, int(rng.integers(50, 500))) for s in "abc" for l in "xy" for t in "pq"]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    share = lambda name, d: spark.createDataFrame(list(d.items()), f"{name} string, share double")
    goals = {"source": {"a": 0.4, "b": 0.3, "c": 0.3}, "lang": {"x": 0.5, "y": 0.5}, "topic": {"p": 0.45, "q": 0.55}}
    got = mixing.rake(df, {k: share(k, v) for k, v in goals.items()}, keep_share=0.2).toPandas()
    assert got.probability.between(0, 1).all()
    kept = got.tokens * got.probability
    assert abs(kept.sum() / got.tokens.sum() - 0.2) < 1e-4
    for dim, goal in goals.items():
        for value, want in goal.items():
            assert abs(kept[got[dim] == value].sum() / kept.sum() - want) < 1e-3


def test_a_rare_value_keeps_all_it_has(spark):
    df = spark.createDataFrame([("a", "x", "p", 10), ("b", "x", "p", 990)], "source string, lang string, topic string, tokens long")
    goal = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, share double")
    got = {r.source: r.probability for r in mixing.rake(df, {"source": goal}, keep_share=0.5).collect()}
    assert got["a"] == 1.0 and abs(got["b"] - 490 / 990) < 1e-9


@pytest.mark.parametrize("few", [0, 100_000])
def test_what_a_rare_value_lacks_is_kept_of_the_others(spark, monkeypatch, few):
    """Topic q is too rare for its share: all of it stays, and the total and the other marginals are met."""
    monkeypatch.setattr(mixing, "FEW_CELLS", few)
    monkeypatch.setattr(mixing, "TOLERANCE", 1e-10)
    rng = np.random.default_rng(5)
    cells = [(s, l, t, int(rng.integers(50, 500)) // (30 if t == "q" else 1)) for s in "abcd" for l in "xyz" for t in "pqr"]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    share = lambda name, d: spark.createDataFrame(list(d.items()), f"{name} string, share double")
    goals = {"source": dict.fromkeys("abcd", 0.25), "lang": {"x": 2.0, "y": 1.0, "z": 1.0}, "topic": {"p": 0.4, "q": 0.2, "r": 0.4}}
    targets = {k: share(k, v) for k, v in goals.items()}
    raked = mixing.rake(df, targets, keep_share=0.4)
    got = raked.toPandas()
    kept = got.tokens * got.probability
    assert abs(kept.sum() / got.tokens.sum() - 0.4) < 1e-9
    assert (got[got.topic == "q"].probability > 1 - 1e-9).all()
    report = {(r.dim, r.value): r for r in mixing.reached(raked, targets).collect()}
    for (dim, value), r in report.items():
        assert abs(r.share - kept[got[dim] == value].sum() / kept.sum()) < 1e-9
        if dim != "topic":
            assert abs(r.share - goals[dim][value] / sum(goals[dim].values())) < 1e-9
    assert abs(report["topic", "p"].share - report["topic", "r"].share) < 1e-9 and report["topic", "q"].share < 0.2 == report["topic", "q"].target


def test_targets_that_cover_too_little_lower_the_total(spark):
    df = spark.createDataFrame([("a", "x", 10), ("b", "x", 90)], "source string, lang string, tokens long")
    source = spark.createDataFrame([("a", 1.0), ("gone", 1.0)], "source string, share double")
    lang = spark.createDataFrame([("x", 1.0)], "lang string, share double")
    got = {r.source: r.probability for r in mixing.rake(df, {"source": source, "lang": lang}, keep_share=0.5).collect()}
    assert abs(got["a"] - 1) < 1e-9 and got["b"] == 0


def test_mix_of_odd_rows(odd_documents, no_documents):
    got = mixing.mix(odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert all(0 <= r.probability <= 1 for r in got)
    assert all(r.probability == 1 and r.kept for r in got if r.tokens == 0)
    assert len({r.kept for r in got if r.doc_id == 1}) == 1
    kept = mixing.keep_mixed(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.count() == sum(r.kept for r in got)
    assert mixing.mix(no_documents).collect() == [] and mixing.keep_mixed(no_documents).collect() == []
