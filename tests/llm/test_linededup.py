from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from spindrift.llm import linededup as ld

LONG = [f"this is passage line {i} with a good many words in it to count" for i in range(6)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=12), st.lists(st.integers(0, 6), max_size=12))
def test_alignment_is_a_rising_match(a, b):
    got = ld.patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    assert len(ld.patience(a, a)) == len(a)


def docs(spark, texts):
    return spark.createDataFrame([Row(doc_id=i, text=t) for i, t in texts], "doc_id long, text string")


def deduped(df):
    return {r.doc_id: r.text for r in ld.dedup_lines(df).collect()}


def test_common_blocks_leave_the_later_document(spark):
    own = ["words of the first alone, they stay there", "short", "more words of the second alone, they stay too"]
    got = deduped(docs(spark, [
        (1, "\n".join([own[0], *LONG, own[1]])), (2, "\n".join(["short", *LONG, own[2]])), (3, "\n".join([own[2], "nothing else is here at all"])),
    ]))
    assert got[1] == "\n".join([own[0], *LONG, own[1]])
    assert got[2] == "\n".join(["short", own[2]])
    assert got[3] == "nothing else is here at all"


def test_frequent_lines_go_only_in_long_blocks(spark):
    notice = "Released under the terms of some licence"
    texts = [(i, f"{notice}\nown words of document number {i}\n" + "\n".join(LONG)) for i in range(60)]
    got = deduped(docs(spark, texts))
    assert got[0] == texts[0][1]
    for i in range(1, 60):
        assert got[i] == f"{notice}\nown words of document number {i}"


def test_lines_out_of_order_stay_once_moved(spark):
    a, b, c = LONG[:3]
    got = deduped(docs(spark, [(1, f"{a}\n{b}\n{c}"), (2, f"{b}\n{c}\n{a}")]))
    assert got[2] == a


def test_many_copies(spark):
    text = "\n".join(LONG)
    got = deduped(docs(spark, [(i, text) for i in range(300)]))
    assert got[0] == text and all(got[i] == "" for i in range(1, 300))


def test_deleted_lines_stay_in_an_earlier_document(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = {r.doc_id: r.text for r in df.collect()}
    first = {}
    for i in sorted(before):
        for line in before[i].split("\n"):
            first.setdefault(line.strip(" "), i)
    left = defaultdict(set)
    after = {r.doc_id: r for r in ld.dedup_lines(df).collect()}
    assert after.keys() == before.keys()
    for i, r in after.items():
        left[i] = {x.strip(" ") for x in r.text.split("\n")}
        assert r._removed_lines == (len(before[i].split("\n")) - len(r.text.split("\n")) if r.text else r._removed_lines)
    removed = 0
    for i in before:
        for line in before[i].split("\n"):
            line = line.strip(" ")
            if line and line not in left[i]:
                removed += 1
                assert first[line] < i and line in left[first[line]]
    assert removed


def test_odd_rows(odd_documents, no_documents):
    got = ld.dedup_lines(odd_documents)
    assert got.columns == [*odd_documents.columns, "_removed_lines"]
    rows = got.collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r.text for r in rows}
    assert by[3] is None and by[4] == "" and by[5] == " \n\n " and by[2] == ""
    assert [r.text for r in rows if r.doc_id == 1] == [r.text for r in odd_documents.collect() if r.doc_id == 1]
    assert ld.dedup_lines(no_documents).collect() == []


def test_short_blocks_go_whatever_the_count(spark):
    line = "the same nine words stand in all of these"
    short = "only six words are here now"
    texts = [(i, "\n".join([f"document {i} starts", line, f"and {i} goes on", *[short] * (i < 25), f"{i} ends"])) for i in range(60)]
    got = deduped(docs(spark, texts))
    assert got[0] == texts[0][1]
    for i in range(1, 60):
        assert got[i] == f"document {i} starts\nand {i} goes on\n{i} ends"


def test_moved_and_repeated_passages_go(spark):
    p, q = [[f"{name} passage line {i} with a good many words in it" for i in range(8)] for name in ("one", "two")]
    got = deduped(docs(spark, [
        (1, "\n".join([*p, "alone in the first document", *q])), (2, "\n".join(["own start of this", *q, "and own middle", *p, "own end"])),
        (3, "\n".join(["third start of it", *p, "third middle", *p, "third end"])),
    ]))
    assert got[2] == "own start of this\nand own middle\nown end"
    assert got[3] == "third start of it\nthird middle\nthird end"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=10), st.lists(st.integers(0, 3), max_size=10))
def test_moved_blocks_are_all_found(a, b):
    entry = lambda x: [{"n": i + i // 4, "pos": i, "hash": h, "words": 6} for i, h in enumerate(x)]
    runs = lambda x: [[*range(i, min(i + 4, len(x)))] for i in range(0, len(x), 4)]
    blocks = lambda x: [r[i : i + 3] for r in runs(x) for i in range(len(r) - 2)]
    have = {tuple(a[i] for i in r) for r in blocks(a)}
    want = {i for r in blocks(b) if tuple(b[i] for i in r) in have for i in r}
    assert {k for i, j in ld.moved_blocks(entry(a), entry(b)) for k in range(i, j + 1)} == want


def test_passages_of_short_lines_go(spark):
    verse = [f"{a} {b}" for a in ("red", "blue", "green", "old") for b in ("ship", "sail", "rope")]
    chinese = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"
    got = deduped(docs(spark, [
        (1, "\n".join(verse)), (2, "\n".join(["my own", *verse, "the end"])), (3, "\n".join([chinese, "x"])), (4, "\n".join(["y", chinese])),
    ]))
    assert got == {1: "\n".join(verse), 2: "my own\nthe end", 3: f"{chinese}\nx", 4: "y"}
