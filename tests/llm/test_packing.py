import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from spindrift.llm import packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def used(plan, full):
    out = np.zeros(full + 1, int)
    for parts, n in plan:
        assert n > 0 and sum(parts) <= full
        for p in parts:
            out[p] += n
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=41, max_size=41))
def test_a_plan_uses_up_the_histogram(counts):
    h = np.array(counts)
    h[0] = 0
    plan = packing.plan_patterns(h, 40)
    assert (used(plan, 40) == h).all()
    assert (used(packing.best_fit(h.copy(), 40), 40) == h).all()
    n, best = sum(n for _, n in plan), -(-(h * np.arange(41)).sum() // 40)
    assert best <= n <= best * 1.25 + 2


def test_best_fit_equals_the_plain_one():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 60, 500)
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        r = min(fits, default=64)
        if fits:
            rooms.remove(r)
        rooms.append(r - x)
    assert sum(n for _, n in packing.best_fit(np.bincount(lengths, minlength=65), 64)) == len(rooms)


def check(docs, rows, full):
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(
        (i is not None, i or 0, k, s, len(ids[s : s + full]), zlib.crc32(ids[s : s + full].tobytes()))
        for i, text in docs
        for ids in [np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")]
        for k, s in enumerate(range(0, len(ids), full))
    )
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= full
    return len(by)


def test_odd_rows(odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check(docs, packing.pack(odd_documents, PATH).collect(), 2048)
    check(docs, packing.pack(odd_documents, PATH, max_tokens=16).collect(), 16)
    assert packing.pack(no_documents, PATH).collect() == []


def test_documents_fill_few_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    n = check([(r.doc_id, r.text) for r in docs.collect()], rows, 2048)
    assert n <= -(-sum(r.length for r in rows) // 2048) * 1.03


def test_ids_can_be_kept(spark):
    df = spark.createDataFrame([(1, "a small text")], "doc_id long, text string")
    r = packing.cut_pieces(df, PATH, with_ids=True).first()
    assert len(r.ids) == r.length and r.ids[-1] == 0
