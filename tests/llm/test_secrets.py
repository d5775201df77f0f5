import random
import re
import string

from spindrift.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


CASES = [
    "token=secret:abcdefgh12", "token=token=abcdefgh1", "PassWord : 'abc.def=ghi' and API_KEY=\"12345678\"", "token==aaaaaaaa",
    "AKIAAKIAAKIAAKIA AKIA1234 xAKIA123456789012", "é𝔘" * 5 + "0123456789abcdef" * 2 + "ff", "secret = short", "f" * 31 + " " + "a" * 32,
    "token=\n12345678", "ſecret=12345678", "api_key:abcdefgh" * 3, "password=12345678password=12345678", "",
]


def test_base_spans_are_those_of_the_patterns(spark):
    df = spark.createDataFrame(list(enumerate([*CASES, None])), "doc_id long, text string")
    for r in secrets.find_secrets(df).collect():
        got = [(s.start, s.kind, s.end) for s in r.spans if s.kind < 3]
        assert got == base(dict(enumerate(CASES)).get(r.doc_id)), r


def test_the_battery_tells_random_runs_from_words(spark):
    rng = random.Random(5)
    alphabet = string.ascii_letters + string.digits
    keys = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(40)]
    plain = ["thisisalongnameofathing2021andthenanother", "aaaaaaaaaaaaaaaaaaaaaaaa1111111111111111", "abcdefghijklmnopqrstuvwxyz0123456789abcdef"[:30] + "ghij1"]
    texts = [f"the key {k} lies here" for k in keys] + [f"some {p} text" for p in plain * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [s for s in r.spans if s.kind == 3] for r in secrets.find_secrets(df).collect()}
    assert sum(len(got[i]) for i in range(40)) >= 36
    assert sum(len(got[i]) for i in range(40, len(texts))) == 0
    i = next(i for i in range(40) if got[i])
    assert texts[i][got[i][0].start : got[i][0].end] == keys[i]


def test_benjamini_hochberg_over_bins():
    bins = secrets.BINS_A_DECADE
    counts = [("s", -10 * bins, 50), ("s", 0, 50), ("t", 0, 9)]
    assert secrets.ordinary_below(counts) == {"s": -10 * bins}
    # a p-value of 0.04 is rejected among many small ones, not alone
    b = -27
    assert secrets.ordinary_below([("s", -10 * bins, 99), ("s", b, 1)])["s"] == b
    assert secrets.ordinary_below([("s", b, 1), ("s", 0, 99)]) == {}


def test_odd_rows(odd_documents, no_documents):
    got = secrets.find_secrets(odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert all(r.spans == [] for r in got)
    assert secrets.find_secrets(no_documents).collect() == []
