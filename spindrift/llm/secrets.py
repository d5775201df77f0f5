"""Secrets in texts: patterns, and a battery of randomness tests over what looks encoded.

Runs of at least ``MIN_RUN`` characters of an encoding, with letters and digits, are tested against
the hypothesis that they are random: chi-squared uniformity over the alphabet of the
encoding inferred from the run, runs above and below the middle of the alphabet, and
serial correlation of neighbours. The three are combined by Fisher's method. Within each
stratum of encoding and length, Benjamini-Hochberg decides which runs are ordinary (not
random): at most ``FALSE_SHARE`` of those are expected to be secrets. What isn't rejected, and is long
enough for its encoding to tell, is a secret. SQL expressions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.cut import table
from .common import ids_and_texts

# fixed values: the kinds of spans in their order, and the patterns of the first three
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a shorter run of these holds no longer one, so filtering by length is the same
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8

MIN_RUN = 20
RUN = f"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"
FALSE_SHARE = 0.05
MIN_BITS = 100  # length times bits a character: below that the tests can't tell
BINS_A_DECADE = 20
LEAST_P = 1e-15

# fixed values: encodings, the first that fits a run counts
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("lower", "^[0-9a-z]+$", DIGITS + LOWER),
    ("upper", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64", "^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[0-9A-Za-z+/_-]+$", UPPER + LOWER + DIGITS + "-_+/"),
]
LENGTHS = [32, 48, 64, 128]  # the strata of length begin here

# fixed values: tail of the normal distribution, Abramowitz and Stegun 26.2.17
TAIL_AT = 0.2316419
TAIL = [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def find_spans(text: Column, pattern: str, guard: Column, value_group: int = 0, least: int = 0) -> Column:
    """array<struct<start, end>> of the leftmost non-overlapping matches, in code points, end exclusive.

    What lies between the matches comes from ``split``, so one pass of lengths gives all places.
    Matches whose ``value_group`` has under ``least`` characters are dropped; ``guard`` may be
    false only where there is no match.
    """
    hits = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(at, h):
        start = at.pos + F.length(h.gap)
        end = start + F.length(h.hit)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        keep = h.hit.isNotNull() & (F.length(h.value) >= least)
        return F.struct(
            F.coalesce(end, start).alias("pos"), F.when(keep, F.concat(at.spans, span)).otherwise(at.spans).alias("spans")
        )

    start = F.struct(F.lit(0).alias("pos"), none.alias("spans"))
    return F.when(guard, F.aggregate(hits, start, step, lambda at: at.spans)).otherwise(none)


def _tail(z: Column) -> Column:
    """Probability that a standard normal value exceeds z."""

    def upper(x):
        t = F.lit(1.0) / (F.lit(1.0) + F.lit(TAIL_AT) * x)
        sum_ = F.lit(0.0)
        for c in reversed(TAIL):
            sum_ = (sum_ + F.lit(c)) * t
        return F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * sum_

    p = let(F.abs(z), upper)
    return F.greatest(F.lit(LEAST_P), F.when(z >= 0, p).otherwise(F.lit(1.0) - p))


def _both_tails(z: Column) -> Column:
    return F.least(F.lit(1.0), F.lit(2.0) * _tail(F.abs(z)))


def randomness(run: Column, alphabet: str) -> Column:
    """Combined p-value of the battery for a run over an alphabet; small where it isn't random."""
    size = len(alphabet)
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double") - 1)

    def tests(x):
        n = F.size(x).cast("double")
        squares = F.aggregate(
            F.array_distinct(x), F.lit(0.0), lambda s, v: s + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0))
        )
        df = size - 1
        # Wilson-Hilferty
        chi = (F.pow(F.greatest(squares * size / n - n, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
        bits = F.transform(x, lambda v: (v >= size / 2).cast("int"))
        high = F.size(F.filter(x, lambda v: v >= size / 2)).cast("double")
        changes = F.aggregate(
            F.zip_with(F.slice(bits, 2, F.size(bits)), bits, lambda a, b: F.abs(a - b)), F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0))
        )
        pairs = 2 * high * (n - high)
        spread = pairs * (pairs - n) / (n * n * (n - 1))
        runs = F.when(spread > 0, (changes - pairs / n) / F.sqrt(spread)).otherwise(F.sqrt(n))
        mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / n

        def correlation(m):
            var = F.aggregate(x, F.lit(0.0), lambda s, v: s + (v - m) * (v - m))
            next_ = F.zip_with(F.slice(x, 2, F.size(x)), x, lambda a, b: (a - m) * (b - m))
            cov = F.aggregate(next_, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
            return F.when(var > 0, (cov / var + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))

        half = -(F.log(_tail(chi)) + F.log(_both_tails(runs)) + F.log(_both_tails(let(mean, correlation))))
        return let(half, lambda h: F.greatest(F.lit(LEAST_P), F.exp(-h) * (1 + h + h * h / 2)))

    return let(codes, tests)


def _candidates(text: Column, base: Column) -> Column:
    """array<struct<start, end, stratum, p>> of the runs outside the base spans that the battery can judge."""
    spans = F.filter(
        find_spans(text, RUN, F.lit(True)),
        lambda s: ~F.exists(base, lambda b: (b.start < s.end) & (s.start < b.end)),
    )

    def judge(s):
        # padding is no part of the code
        run = F.rtrim(F.substr(text, s.start + 1, s.end - s.start), F.lit("="))
        out = F
        for name, form, alphabet in ENCODINGS:
            need = max(MIN_RUN, math.ceil(MIN_BITS / math.log2(len(alphabet))))
            fits = run.rlike(form) & run.rlike("[0-9]") & run.rlike("[A-Za-z]")
            length = F.length(run)
            band = F.lit(0)
            for i, n in enumerate(LENGTHS):
                band = F.when(length >= n, i + 1).otherwise(band)
            p = F.when(length >= need, randomness(run, alphabet))
            out = out.when(fits, F.struct(s.start.alias("start"), s.end.alias("end"), F.concat(F.lit(f"{name} "), band).alias("stratum"), p.alias("p")))
        return out

    return F.filter(F.transform(spans, judge), lambda c: c.p.isNotNull())


def _bin(p: Column) -> Column:
    """Number of the bin of a p-value, in steps of the logarithm; a bin's upper edge is 10^(bin / steps)."""
    return F.ceil(F.log10(p) * BINS_A_DECADE).cast("int")


def ordinary_below(counts: list[tuple[str, int, int]], false_share: float = FALSE_SHARE) -> dict[str, int]:
    """Benjamini-Hochberg over binned p-values: of each stratum the last bin that is rejected.

    ``counts`` holds (stratum, bin, number). A bin counts with its upper edge, which errs towards
    not rejecting. Strata without rejections are missing.
    """
    out = {}
    for stratum in {c[0] for c in counts}:
        bins = sorted((b, n) for s, b, n in counts if s == stratum)
        total, seen = sum(n for _, n in bins), 0
        for b, n in bins:
            seen += n
            if 10 ** (b / BINS_A_DECADE) <= false_share * seen / total:
                out[stratum] = b
    return out


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``spans``, array<struct<start, kind, end>>, of each row; kind is a place in ``KINDS``.

    Sorted by start, then kind. The base kinds (assign, access, hex) follow their patterns
    alone; `random` spans come from the battery and never overlap them. Null texts count as
    empty and have none; repeated rows get equal answers. The p-values of all rows enter
    the false-discovery control; what the driver gets is their counts by stratum and bin.
    """
    rows = ids_and_texts(df, id_col, text_col)
    text = F.col("text")
    low = F.lower(text)
    guard = F.lit(False)
    for word in ("passw", "secret", "token", "api_key", "apikey"):
        guard |= F.contains(low, F.lit(word))
    kinds = [
        find_spans(text, ASSIGN, guard, 2, ASSIGN_VALUE),
        find_spans(text, ACCESS, F.contains(text, F.lit("AKIA"))),
        find_spans(text, HEX, text.rlike(HEX)),
    ]
    tag = lambda k: lambda s: F.struct(s.start.alias("start"), F.lit(k).alias("kind"), s.end.alias("end"))
    tagged = [F.transform(spans, tag(k)) for k, spans in enumerate(kinds)]
    found = rows.withColumn("base", F.concat(*tagged)).select(
        "doc_id", "base", F.when(text.rlike(RUN), _candidates(text, F.col("base"))).alias("runs")
    )
    found = table(found)
    counts = (
        found.select(F.explode("runs").alias("r")).groupBy(F.col("r.stratum").alias("stratum"), _bin(F.col("r.p")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n")).collect()
    )
    limits = ordinary_below([(r["stratum"], r["bin"], r["n"]) for r in counts])
    secret = lambda r: F.lit(True)
    if limits:
        known = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])
        secret = lambda r: _bin(r.p) > F.coalesce(known[r.stratum], F.lit(-(10**6)))
    more = F.transform(
        F.filter(F.coalesce("runs", F.array().cast(found.schema["runs"].dataType)), secret),
        lambda r: F.struct(r.start.alias("start"), F.lit(KINDS.index("random")).alias("kind"), r.end.alias("end")),
    )
    return found.select("doc_id", F.array_sort(F.concat("base", more)).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of the spans in their order, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ","
    )
