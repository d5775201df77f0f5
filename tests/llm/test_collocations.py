import random
import re
from collections import Counter, defaultdict

from spindrift.llm import collocations as col


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = defaultdict(int)
    for (lang, w), a in cand.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    inside[lang, w[i:j]] = max(inside[lang, w[i:j]], a)
    out = defaultdict(list)
    for (lang, w), a in cand.items():
        if 100 * inside[lang, w] >= 80 * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, r, p.decode(), -a, x, y, n[lang], -s)
        for lang, found in out.items() for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)
    )


def mined(spark, rows, least, top):
    df = spark.createDataFrame([(i, t, l, 1, "w", 2) for i, (l, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, f long, phrase string, n int").repartition(3)
    return sorted(tuple(r) for r in col.collocations(df, least=least, top=top).collect())


def corpus(seed, words, texts, size):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "ñandú", "𝔘𝔫𝔦", "É", "x\x1cy", "a-b", "'t"][:words] + [f"w{i}" for i in range(words)]
    rows = []
    for _ in range(texts):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n", "\x0b"]) for _ in range(size))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text + rng.choice(["", " set in stone", " set in stone today."])))
    return rows


def test_against_brute_force(spark):
    rows = corpus(1, 6, 60, 40) + [("en", None), (None, ""), ("fr", " . \n"), ("fr", "one"), ("en", "again " * 3_000)]
    for least, top in ((3, 40), (8, 2_000)):
        want = brute(rows, least, top)
        assert want and mined(spark, rows, least, top) == want


def test_hot_prefixes_small_memory_and_a_full_filter(spark, monkeypatch):
    monkeypatch.setattr(col, "HOT", 20)
    monkeypatch.setattr(col, "HELD", 5)
    monkeypatch.setattr(col, "MERGED", 7)
    monkeypatch.setattr(col, "FILTER_BITS", 64)
    rows = corpus(2, 9, 40, 60)
    assert mined(spark, rows, 3, 100) == brute(rows, 3, 100)


def test_odd_tables(spark, odd_documents, no_documents):
    assert col.collocations(no_documents).count() == 0
    rows = [(r["lang"], r["text"]) for r in odd_documents.collect()]
    found = sorted(tuple(r) for r in col.collocations(odd_documents, least=2).collect())
    assert found == brute(rows, 2, 2_000)


def test_scores_beyond_64_bits(spark):
    # the arithmetic alone, with counts no test can write out
    row = spark.sql("SELECT CAST((CAST(a AS DECIMAL(20, 0)) * 2000000BD) div (l + r) AS BIGINT) AS s FROM VALUES (9000000000000000001L, 4500000000000000000L, 4500000000000000003L) AS t(a, l, r)")
    assert row.first()["s"] == 2_000_000 * 9000000000000000001 // 9000000000000000003
