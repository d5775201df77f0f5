import pytest
from pyspark.sql import Row

BASE = (
    "the quick brown fox jumps over the lazy dog while seven wizards quietly brew "
    "another pot of strong black coffee near the old stone bridge tonight"
)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like internals."""
    lines = "\n".join(f"line {i} of a long text about nothing much at all" for i in range(3_000))
    rows = [
        (1, BASE, "en", "a"), (1, BASE, "en", "a"), (2, BASE, "en", None), (3, None, None, "a"), (4, "", "en", "b"),
        (5, " \n\n ", "en", "b"), (6, "!!! 123 ???", "en", "b"), (7, lines, "en", "c"), (8, "word", "en", "c"),
        (9, "word", "de", "c"), (None, "a text without an id that is told apart", "en", "c"), (10, BASE + " indeed", "en", "a"),
        (11, "İstanbul 𝔘𝔫𝔦 ñandú \x1c sep wide é́", "es", "a"), (12, "x" * 50_000, "en", "d"), (13, None, "en", "a"),
    ]
    return spark.createDataFrame(
        [
            Row(doc_id=i, text=t, lang=l, source=s, n_chars=len(t or ""), _key=1, _row="r", doc="d", hash=2, tokens=3, shard=4,
                _block=5, rejected="x", a=6, b=7, ids=[1], bands="q", topic="t", piece=8, _removed=9)
            for i, t, l, s in rows
        ],
        "doc_id long, text string, lang string, source string, n_chars long, _key long, _row string, doc string, hash long, "
        "tokens long, shard long, _block long, rejected string, a long, b long, ids array<long>, bands string, topic string, "
        "piece long, _removed long",
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
