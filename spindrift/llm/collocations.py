"""Phrase collocations from stripes.

Stripes (Lin and Dyer, "Data-Intensive Text Processing with MapReduce", 2010): a prefix of words keys a
counter of the words that follow it. Tasks build stripes of the texts they read, stripes of equal
prefix are added elementwise, and one stripe then answers three questions: how often each extension
of the prefix occurs, how often the prefix itself does (the sum of its counters, ``rest`` included, or
its own counter in the stripe one word shorter), and which extension subsumes it (the largest counter).
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.cut import table
from ..plans.skew import attach

LEAST = 30           # occurrences of a candidate
WORDS = 4            # words of a phrase at most
SUBSUMED = 80        # per cent of a phrase's occurrences inside one longer phrase
TOP = 2_000          # phrases of a language
FILTER_BITS = 1 << 26  # of the filter of frequent parts: 8 MiB whatever the table
CHUNK_BYTES = 2 << 20  # of text that are counted at once
HELD = 1_500_000     # counters a task holds before it hands its stripes on
MERGED = 1_000_000   # counters that are added up at once
KNOWN = 500_000      # words a task remembers
WORD_BITS = 21       # of a remembered word's number
HOT = 1_000          # a prefix of more than a thousandth of all words has its stripe cut into slots
SALTS = 256

# fixed values: what ends a piece, and what ends a word inside it
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b" \t"
_FORM = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ").translate(bytes(range(256)).lower())
BREAK = b"\xff"  # stands for the end of a piece; no UTF-8 text holds it

_STEP = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of all texts in order, with BREAK between pieces; only A-Z are lowered."""
    return b"\n".join(texts).translate(_FORM).replace(b"\n", b" " + BREAK + b" ").split()


def _chunks(batches):
    """lang and tokens of some texts of that language at a time."""
    for batch in batches:
        waiting, size = defaultdict(list), Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            waiting[lang].append(text)
            size[lang] += len(text)
            if size[lang] > CHUNK_BYTES:
                yield lang, tokens(waiting.pop(lang))
                size[lang] = 0
        for lang, texts in waiting.items():
            yield lang, tokens(texts)


def _texts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text")
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, f: the stripe of the empty prefix, kept as rows."""
    def run(batches):
        held = defaultdict(Counter)

        def out():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
                    names=["lang", "word", "f"],
                )
            held.clear()

        for lang, found in _chunks(batches):
            counts = held[lang]
            counts.update(found)
            counts.pop(BREAK, None)
            if len(counts) > KNOWN:
                yield from out()
        yield from out()

    return texts.mapInArrow(run, "lang string, word binary, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


# -- which parts can be in a candidate --------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\n" + word)


def _spots(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the filter for each phrase, given as the hashes of its first words, of its second words ..."""
    h = np.zeros(len(words[0]), np.uint64)
    for w in words:
        h = _mix(h * _STEP + w)
    return h % np.uint64(FILTER_BITS), _mix(h + _STEP) % np.uint64(FILTER_BITS)


def frequent_filter(frequent: DataFrame) -> np.ndarray:
    """Bloom filter of the phrases (lang, phrase) of ``frequent``, all of equally many words.

    Its size is fixed; it lets all of them pass, and few others as long as it is not too full. What it lets pass is
    counted exactly later.
    """
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                hashes = [[_word_hash(lang, w) for w in p.split(b" ")] for lang, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                at = np.concatenate(_spots(list(np.array(hashes, np.uint64).T)))
                bits = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bits)], names=["at", "bits"])

    rows = frequent.select("lang", "phrase").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    bits = np.zeros(FILTER_BITS >> 6, np.int64)
    # no more rows than the filter has words
    found = rows.toPandas()
    bits[found["at"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return bits.view(np.uint64)


def _passes(bits: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    ok = np.ones(len(words[0]), bool)
    for at in _spots(words):
        ok &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return ok


class Vocabulary:
    """Numbers of a language's words, from 1; 0 for the end of a piece and for words the filter stops."""

    def __init__(self, lang: str, bits: np.ndarray):
        self.lang, self.bits, self.at = lang, bits, {BREAK: 0}
        self.words, self.hashes = [b""], [0]

    def __call__(self, found: list[bytes]) -> np.ndarray:
        new = list(set(found).difference(self.at))
        if new:
            hashes = [_word_hash(self.lang, w) for w in new]
            for w, h, ok in zip(new, hashes, _passes(self.bits, [np.array(hashes, np.uint64)])):
                self.at[w] = len(self.words) if ok else 0
                if ok:
                    self.words.append(w), self.hashes.append(h)
        return np.fromiter(map(self.at.__getitem__, found), np.int64, len(found))


# -- stripes ----------------------------------------------------------------

STRIPES = "lang string, prefix binary, slot int, words array<binary>, counts array<bigint>, rest long"


_NAMES = [c.split()[0] for c in STRIPES.split(", ")]
_LOW = (1 << WORD_BITS) - 1


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)])


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their ``n``."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n[order], first)


class Counters:
    """The counters a task holds for one language: prefix and next word (0: rest), packed into one number, and a count.

    A prefix of one or two words is packed word by word; one of three goes by a number of its own.
    """

    def __init__(self, vocabulary: Vocabulary, words: int):
        self.vocabulary, self.words, self.parts, self.size = vocabulary, words, [], 0
        self.triples, self.number = [], {}

    def add(self, prefix: list[np.ndarray], word: np.ndarray) -> None:
        if self.words == 3:
            # few are left of these
            numbered = []
            for t in zip(*(p.tolist() for p in prefix)):
                if t not in self.number:
                    self.number[t] = len(self.triples)
                    self.triples.append(t)
                numbered.append(self.number[t])
            key = np.array(numbered, np.int64)
        else:
            key = prefix[0]
            for p in prefix[1:]:
                key = key << WORD_BITS | p
        self.parts.append(_counted(key << WORD_BITS | word))
        self.size += len(self.parts[-1][0])

    def merge(self) -> None:
        if len(self.parts) > 1:
            self.parts = [_summed(*(np.concatenate(c) for c in zip(*self.parts)))]
        self.size = len(self.parts[0][0])

    def stripes(self, hot: dict[tuple[str, bytes], int]):
        """A stripe for each prefix, or for each slot of a hot one."""
        if not self.size:
            return
        self.merge()
        key, n = self.parts[0]
        key, word = key >> WORD_BITS, key & _LOW
        v, vocabulary = self.vocabulary, pa.array(self.vocabulary.words, pa.binary())
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        prefix, at = key[first], np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(key)]))
        if self.words == 3:
            parts = list(np.array(self.triples, np.int64)[prefix].T)
        else:
            parts = [prefix >> (WORD_BITS * i) & _LOW for i in reversed(range(self.words))]
        names = [vocabulary.take(pa.array(p)) for p in parts]
        names = names[0] if len(names) == 1 else pc.binary_join_element_wise(*names, pa.scalar(b" ", pa.binary()))
        slot = np.zeros(len(key), np.int64)
        if any(lang == v.lang for lang, _ in hot):
            slots = np.array([hot.get((v.lang, p), 1) for p in names.to_pylist()], np.uint64)[at]
            slot = np.where(word > 0, np.array(v.hashes, np.uint64)[word] % slots, 0).astype(np.int64)
            order = np.lexsort((word, slot, at))
            at, slot, word, n = at[order], slot[order], word[order], n[order]
            first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (slot[1:] != slot[:-1])])
        rest = np.where(word[first] == 0, n[first], 0)
        inside = word > 0
        ends = np.r_[0, np.cumsum(np.add.reduceat(inside.astype(np.int32), first))].astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, c) for c in (vocabulary.take(pa.array(word[inside])), pa.array(n[inside]))]
        whole = pa.RecordBatch.from_arrays(
            [pa.array([v.lang] * len(first), pa.string()), names.take(pa.array(at[first])), pa.array(slot[first].astype(np.int32)), *lists, pa.array(rest)],
            names=_NAMES,
        )
        for i in range(0, whole.num_rows, 20_000):
            yield whole.slice(i, 20_000)


def _merged(t: pa.Table) -> pa.RecordBatch:
    """Stripes of equal key, which are neighbours, added elementwise."""
    t = t.combine_chunks()
    lang, prefix, slot = (t.column(c).chunk(0) for c in _NAMES[:3])
    new = np.zeros(len(lang), bool)
    new[0] = True
    for c in (lang, prefix, slot):
        new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    words, counts = t.column("words").chunk(0), t.column("counts").chunk(0)
    length = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.repeat(np.cumsum(new) - 1, length)
    coded = words.flatten().dictionary_encode()
    n = counts.flatten().to_numpy(zero_copy_only=False)
    size = max(1, len(coded.dictionary))
    if len(group):
        key, n = _summed(group * size + coded.indices.to_numpy(zero_copy_only=False), n)
    else:
        key = group
    ends = np.searchsorted(key // size, np.arange(len(first) + 1), "left").astype(np.int32)
    at = pa.array(first)
    out = pa.RecordBatch.from_arrays([
        lang.take(at), prefix.take(at), slot.take(at), pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(key % size))),
        pa.ListArray.from_arrays(ends, pa.array(n)),
        pa.array(np.add.reduceat(t.column("rest").chunk(0).to_numpy(zero_copy_only=False), first)),
    ], names=_NAMES)
    return out


def stripes(texts: DataFrame, words: int, frequent_words, frequent, hot: dict[tuple[str, bytes], int]) -> DataFrame:
    """Merged stripes of the prefixes of so many words that can lead to a candidate.

    ``frequent_words`` and ``frequent`` (broadcast bits of filters) tell which words are frequent, and which phrases
    of as many words as the prefix. Whatever follows a single word and can't be part of a candidate, the end of a piece
    included, counts as ``rest``; the total of a longer prefix is a counter of the stripes one word shorter, so
    there it is left out. The stripe of a prefix in ``hot`` is cut into so many slots by a hash of the
    following word.
    """
    def build(batches):
        held: dict[str, Counters] = {}
        for lang, found in _chunks(batches):
            if lang not in held:
                held[lang] = Counters(Vocabulary(lang, frequent_words.value), words)
            c = held[lang]
            x = np.r_[c.vocabulary(found), np.zeros(words, np.int64)]
            n = len(found)
            window = [x[i:i + n] for i in range(words)]
            ok = np.logical_and.reduce([w > 0 for w in window])
            if words > 1:
                hashes = np.array(c.vocabulary.hashes, np.uint64)
                here = np.flatnonzero(ok)
                ok[here] = _passes(frequent.value, [hashes[w[here]] for w in window])
            if words > 1:
                # the phrase that starts one word later, too, must be frequent
                ok &= np.r_[ok[1:], False]
            here = np.flatnonzero(ok)
            after = x[here + words]
            c.add([w[here] for w in window], after)
            if c.size > HELD:
                c.merge()
            if c.size > HELD or len(c.vocabulary.at) > KNOWN:
                yield from held.pop(lang).stripes(hot)
        for c in held.values():
            yield from c.stripes(hot)

    def merge(batches):
        waiting, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            size += len(batch.column(3).flatten()) + batch.num_rows
            if size > MERGED:
                done = _merged(pa.Table.from_batches(waiting))
                if done.num_rows > 1:
                    yield done.slice(0, done.num_rows - 1)
                # the last stripe may go on
                waiting = [done.slice(done.num_rows - 1)]
                size = len(waiting[0].column(3).flatten())
        if waiting:
            yield _merged(pa.Table.from_batches(waiting))

    key = ["lang", "prefix", "slot"]
    return texts.mapInArrow(build, STRIPES).repartition(*key).sortWithinPartitions(*key).mapInArrow(merge, STRIPES)


def extensions(found: DataFrame, least: int) -> DataFrame:
    """lang, prefix, word, a of the counters of ``least`` or more."""
    pair = F.filter(F.arrays_zip("words", "counts"), lambda x: x.counts >= least)
    return found.select("lang", "prefix", F.explode(pair).alias("_x")).select(
        "lang", "prefix", F.col("_x.words").alias("word"), F.col("_x.counts").alias("a")
    )


def totals(found: DataFrame) -> DataFrame:
    """lang, phrase, f: how often each prefix occurs."""
    own = F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y) + F.col("rest")
    return found.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum(own).alias("f"))


def _hot(phrases: DataFrame, words: int) -> dict[tuple[str, bytes], int]:
    """Slots of the phrases with more than a thousandth of all occurrences, fewer than a thousand of each length."""
    most = max(1, words // HOT)
    return {(r["lang"], bytes(r["phrase"])): 1 + r["f"] // most for r in phrases.filter(F.col("f") > most).collect()}


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A text is lowered (A-Z only), split into pieces at . , ; : ! ? and line ends, and those into words at
    blanks and tabs. Phrases of 2 to 4 words that occur ``least`` times in a language are candidates. A
    cut after k words has l and r, the occurrences of the parts; the score is 2,000,000 a / (l + r),
    rounded down, at the cut that gives the least (ties: the smallest k). A candidate goes if 80 % of its
    occurrences lie inside one longer candidate. It is enough to look one word further: a longer phrase
    occurs no more often than the one between.

    A null text is empty, a null language is ``und``; rows count as often as they are repeated, ids
    and other columns are ignored. An empty table gives no rows.
    """
    texts, context = _texts(df, text_col, lang_col), df.sparkSession.sparkContext
    words = table(word_counts(texts))
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    ones = table(words.filter(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), "f"))
    all_words = words.agg(F.sum("f")).first()[0] or 0

    # phrases grow by a word in each turn; the stripes of a length are built from what was frequent in the one before
    join = F.concat(F.col("prefix"), F.encode(F.lit(" "), "UTF-8"), F.col("word"))
    frequent_words = context.broadcast(frequent_filter(ones))
    found, known, last = None, ones, ones
    for size in range(1, WORDS):
        frequent = frequent_words if size == 1 else context.broadcast(frequent_filter(last))
        of_size = table(stripes(texts, size, frequent_words, frequent, _hot(last, all_words)))
        last = table(extensions(of_size, least).withColumn("phrase", join).withColumnRenamed("a", "f"))
        found = last if found is None else found.unionByName(last)
        known = totals(of_size).filter(F.col("f") >= least) if size == 1 else known
    # every part of a candidate is a word or an extension of some stripe
    known = table(known.unionByName(found.select("lang", "phrase", "f")))
    candidates = table(found.select("lang", F.decode("phrase", "UTF-8").alias("phrase"), F.col("f").alias("a")))
    known = known.select("lang", F.decode("phrase", "UTF-8").alias("part"), "f")

    w = F.split("phrase", " ", -1)
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("_w") - 1),
        lambda k: F.struct(
            k.alias("k"), F.array_join(F.slice("_w", F.lit(1), k), " ").alias("left"),
            F.array_join(F.slice("_w", k + 1, F.size("_w") - k), " ").alias("right"),
        ),
    )
    cut = candidates.withColumn("_w", w).select("lang", "phrase", "a", F.explode(cuts).alias("_c"))
    halves = F.array(F.struct(F.lit("l").alias("side"), F.col("_c.left").alias("part")), F.struct(F.lit("r").alias("side"), F.col("_c.right").alias("part")))
    asked = table(cut.select("lang", "phrase", "a", F.col("_c.k").alias("k"), F.inline(halves)))
    uses = asked.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("_n"))
    sides = attach(asked, known.join(uses, ["lang", "part"]), ["lang", "part"], "_n")
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("f"))).alias(s)
    scored = sides.groupBy("lang", "phrase", "a", "k").agg(side("l"), side("r")).withColumn(
        # the product may pass 64 bits
        "score", F.expr("CAST((CAST(a AS DECIMAL(20, 0)) * 2000000BD) div (l + r) AS BIGINT)")
    )
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_b"))

    inner = F.array(
        F.array_join(F.slice("_w", F.lit(1), F.size("_w") - 1), " "), F.array_join(F.slice("_w", F.lit(2), F.size("_w") - 1), " ")
    )
    subsuming = (
        candidates.withColumn("_w", w).filter(F.size("_w") > 2).select("lang", "a", F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
    )
    kept = best.join(subsuming, ["lang", "phrase"], "left").filter(
        F.col("_most").isNull() | F.expr("CAST(_most AS DECIMAL(20, 0)) * 100BD < CAST(a AS DECIMAL(20, 0)) * " + f"{SUBSUMED}BD")
    ).select("lang", "phrase", "a", F.col("_b.l").alias("l"), F.col("_b.r").alias("r"), F.col("_b.score").alias("score"))
    # a language's best are among the best of each of its parts, so no task ranks a whole language
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = kept.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_at") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
