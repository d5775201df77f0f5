import hashlib
import random

import pytest
from spindrift.llm import fingerprints as fp


def text_of(n, seed):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefgh éñ𝔘 ") for _ in range(n))


def test_chunks_cover_the_text():
    for n in (0, 1, 15, 16, 17, 100, 5_000):
        data = text_of(n, n).encode()
        ends = fp.boundaries(data)
        assert ends == sorted(set(ends)) and (ends[-1:] == [len(data)] or not data)
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert all(fp.LEAST <= s <= fp.MOST for s in sizes[:-1])


def test_an_insertion_moves_few_chunks():
    a = text_of(4_000, 1)
    b = a[:100] + "inserted" + a[100:]
    x, y = fp.chunk_lengths(a), fp.chunk_lengths(b)
    assert fp.containment(x, y) > 0.93 and fp.containment(x, x) == 1.0
    assert fp.containment(x, fp.chunk_lengths(text_of(4_000, 2))) < 0.1
    # a part is contained in the whole, but not the other way round
    part = fp.chunk_lengths(a[1_000:2_000])
    assert fp.containment(part, x) > 0.9 > fp.containment(x, part)


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        n = len(text) // 4
        new = text[: len(text) - n] + after[:n]
        a, b, c = map(fp.chunk_lengths, (text, new, after))
        out.append((
            i, len(text), hashlib.sha256(new.encode()).hexdigest(), fp.written(a), fp.written(b), fp.containment(a, b), fp.containment(a, c)
        ))
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [1, 8])
def test_rows_equal_the_plain_way(spark, monkeypatch, blocks):
    monkeypatch.setattr(fp, "BLOCKS_A_PARTITION", blocks)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(map(tuple, fp.compare_edited(docs).collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark, odd_documents, no_documents):
    got = sorted(map(tuple, fp.compare_edited(odd_documents).collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert fp.compare_edited(no_documents).collect() == []
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    assert fp.compare_edited(one).first().edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    prints = {r.doc_id: r.fingerprint for r in fp.fingerprints(odd_documents).collect()}
    assert prints[8] == prints[9] and prints[3] == prints[4] == ""
