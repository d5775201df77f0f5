"""Near duplicates by ProbMinHash over weighted word shingles.

Ertl, "ProbMinHash" (2020): each shingle sends a Poisson process of arrivals at a rate of its weight
to the registers, and each register keeps the first to arrive. A shingle stops once its next
arrival comes after the last register's. Registers agree with the probability Jaccard
similarity, so bands of them find candidates, and each candidate is verified exactly.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.components import connected_components
from ..plans.cut import table
from .common import hash_order, ids_and_texts

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5  # a pair at 0.8 is missed with probability (1 - 0.8^5)^32, 3 in a million
AGREE = 0.66  # share of agreeing registers below which a pair isn't verified: over 4 standard deviations under 0.8
STARS = 4  # rounds at most in which a bucket's texts are compared with one of them
FEW = 20  # comparisons a text in a bucket from which all the rest are made at once
TILE = 512  # texts of a bucket that are held against as many others at once
TILE_CHARS = 4_000_000  # of them, unless one text alone is longer
TASK_TEXTS = 10_000  # registers and bands that a task of such comparisons reads, about 4 MB
TASK_CHARS = 16_000_000  # of texts that a task of exact comparisons reads
LINKS_AT_ONCE = 100_000  # between texts, up to which one task joins the classes
WORDS_AT_ONCE = 200_000
CACHED_WORDS = 300_000
CACHED_SETS = 1_000

_WORD = re.compile(r"\w+")
_ODD = np.frombuffer(hashlib.shake_256(b"shingle").digest(8 * 64), "<u8") | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes and counts of a text's word shingles; words are hashed once as long as the cache holds them."""

    def __init__(self, words: int = SHINGLE_WORDS):
        self.size = words
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingle hashes and their counts; a text of fewer words is one shingle, one of none has none."""
        words = _WORD.findall(text.lower())
        if not words:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        for w in set(words).difference(self.known):
            self.known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        k = min(self.size, len(words))
        n = len(words) - k + 1
        mixed = np.zeros(n, np.uint64)
        for i in range(k):
            mixed += _mix(h[i : i + n] + _STEP) * _ODD[i]
        return np.unique(_mix(mixed), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """A row of registers for each set of (hashes, weights), none empty: the hash that arrived first."""
    sizes = np.array([len(h) for h, _ in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    item = np.concatenate([h for h, _ in sets])
    rate = np.concatenate([w for _, w in sets]).astype(float)
    first = np.full(len(sets) * registers, np.inf)
    who = np.zeros(len(sets) * registers, np.uint64)
    time = np.zeros(len(item))
    state = _mix(item)
    while len(doc):
        state = _mix(state + _STEP)
        time = time - np.log(((state >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)) / rate
        at = doc * registers + (_mix(state ^ _ODD[7]) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        who[at[won]] = item[won]
        # a shingle whose next arrival is later than all registers changes nothing any more
        docs, place = np.unique(doc, return_inverse=True)
        last = first.reshape(-1, registers)[docs].max(axis=1)[place]
        on = time < last
        doc, item, rate, time, state = doc[on], item[on], rate[on], time[on], state[on]
    return who.reshape(-1, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common items d of 1 / sum over all items e of max(a_e / a_d, b_e / b_d); 1 for two empty sets."""
    if not len(a[0]) and not len(b[0]):
        return 1.0
    common, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if len(a[0]) == a[1].sum() and len(b[0]) == b[1].sum():
        return len(common) / (len(a[0]) + len(b[0]) - len(common))
    # items with equal weights on both sides count alike
    wa = np.concatenate([a[1][ia], np.delete(a[1], ia), np.zeros(len(b[0]) - len(common), np.int64)])
    wb = np.concatenate([b[1][ib], np.zeros(len(a[0]) - len(common), np.int64), np.delete(b[1], ib)])
    width = int(wb.max()) + 1
    kinds, counts = np.unique(wa * width + wb, return_counts=True)
    xs, ys = kinds // width, kinds % width
    both = (xs > 0) & (ys > 0)
    return float(sum(n / (np.maximum(xs / x, ys / y) * counts).sum() for x, y, n in zip(xs[both], ys[both], counts[both])))


def _sketch(df: DataFrame) -> DataFrame:
    """doc_id, content (digest of the shingles and counts), bands, marks (a byte of each register), size of each row of (doc_id, text)."""
    registers = BANDS * ROWS

    def bands_of(found):
        rows = found.reshape(-1, BANDS, ROWS)
        out = np.zeros(rows.shape[:2], np.uint64)
        for r in range(ROWS):
            out = _mix(out + rows[:, :, r] * _ODD[r])
        return _mix(out + np.arange(BANDS, dtype=np.uint64) * _STEP).view(np.int64)

    def run(batches):
        shingle = Shingler()
        for batch in batches:
            texts, n = batch.column(1), batch.num_rows
            content, bands, marks, chars, waiting, size = [None] * n, [None] * n, [None] * n, [0] * n, [], 0

            def flush(waiting):
                if waiting:
                    found = signatures([s for _, s in waiting], registers)
                    for (i, _), b, m in zip(waiting, bands_of(found), found.astype(np.uint8)):
                        bands[i], marks[i] = b, m.tobytes()

            for i in range(n):
                text = texts[i].as_py()
                s = shingle(text)
                data = s[0].tobytes() + s[1].tobytes() if len(s[0]) else b"text" + text.encode("utf-8", "replace")
                content[i] = hashlib.blake2b(data, digest_size=16).digest()
                chars[i] = len(text)
                if len(s[0]):
                    waiting.append((i, s))
                    size += len(s[0])
                    if size > WORDS_AT_ONCE:
                        flush(waiting)
                        waiting, size = [], 0
            flush(waiting)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(content, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary()), pa.array(chars, pa.int64())],
                names=["doc_id", "content", "bands", "marks", "size"],
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(run, f"doc_id {kind}, content binary, bands array<bigint>, marks binary, size bigint")


def _agreeing(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (a, b) of which so many registers agree that they may be similar enough."""
    both = (
        pairs.join(marks.select(F.col("doc_id").alias("a"), F.col("marks").alias("ma")), "a")
        .join(marks.select(F.col("doc_id").alias("b"), F.col("marks").alias("mb")), "b").select("a", "b", "ma", "mb")
    )

    def run(batches):
        for batch in batches:
            ma, mb = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, BANDS * ROWS) for i in (2, 3)
            )
            at = pa.array(np.flatnonzero((ma == mb).sum(axis=1) >= AGREE * BANDS * ROWS))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def _similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similarity of the pairs, from their texts. A text travels once for each of its pairs."""
    both = (
        pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        .select("a", "b", "ta", "tb")
    )

    def run(batches):
        shingle = Shingler()
        sets: dict = {}

        def of(text):
            if len(sets) >= CACHED_SETS:
                sets.clear()
            if text not in sets:
                sets[text] = shingle(text)
            return sets[text]

        for batch in batches:
            found = [probability_jaccard(of(ta.as_py()), of(tb.as_py())) for ta, tb in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["a", "b", "similarity"]
            )

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}, similarity double")


def _agree(bucket: int, a: tuple, b: tuple, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places i, j of the pairs in ``ok`` that may be similar enough, and how many registers agree.

    ``a`` and ``b`` are marks and bands. A pair counts in the first bucket that it shares.
    """
    (marks_a, bands_a), (marks_b, bands_b) = a, b
    for j in range(int(np.flatnonzero((bands_a == bucket).any(axis=0))[0])):
        ok &= bands_a[:, j, None] != bands_b[None, :, j]
    i, j = np.nonzero(ok)
    agree = np.zeros(len(i), np.int64)
    for lo in range(0, len(i), 1 << 15):
        cut = slice(lo, lo + (1 << 15))
        agree[cut] = (marks_a[i[cut]] == marks_b[j[cut]]).sum(axis=1)
    enough = agree >= AGREE * BANDS * ROWS
    return i[enough], j[enough], agree[enough]


def _sketches(marks: pa.Array, bands: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.frombuffer(b"".join(marks.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS),
        bands.flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS),
    )


def _links(rest: DataFrame, sketch: DataFrame, texts: DataFrame, step: float, least: float) -> DataFrame:
    """Links (a, b) between the classes of ``rest(bucket, doc_id, comp, _d)``, enough to connect all that are linked.

    Buckets are cut into tiles of neighbouring distances ``_d`` to the first centre, and tiles are held against
    each other. A pair counts in the first bucket that it shares, if its distances differ by ``step`` at most
    and so many registers agree that it may be similar enough. Such pairs never become rows: a text of one goes to the
    task of its two tiles, once, and there pairs are verified until their classes are connected.
    """
    binned = rest.withColumn("_bin", F.floor(F.col("_d") / F.lit(step)))
    of_text = sketch.select("doc_id", "marks", "bands", "size")
    # of an id with different texts only those that fall into the bucket
    binned = binned.join(of_text, "doc_id").filter(F.array_contains("bands", F.col("bucket")))
    sizes = binned.groupBy("bucket", "_bin").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(TILE)), F.ceil(F.sum("size") / F.lit(TILE_CHARS)), F.lit(1)).alias("_tiles")
    )
    placed = binned.join(sizes, ["bucket", "_bin"]).withColumn("_tile", F.pmod(F.xxhash64("doc_id"), F.col("_tiles")))
    member = F.struct("doc_id", "comp", "_d", "marks", "bands", "size")
    tiles = table(placed.groupBy("bucket", "_bin", "_tile").agg(F.array_sort(F.collect_list(member)).alias("m")))
    key = F.struct(F.col("_bin"), F.col("_tile"))
    at = tiles.select("bucket", key.alias("ka"), F.size("m").alias("na"), F.explode(F.array(F.col("_bin"), F.col("_bin") + 1)).alias("_next"))
    other = tiles.select("bucket", F.col("_bin").alias("_next"), key.alias("kb"), F.size("m").alias("nb"))
    pairs = table(at.join(other, ["bucket", "_next"]).filter("ka <= kb").select("bucket", "ka", "kb", "na", "nb"))
    size = pairs.agg(F.sum(F.col("na") + F.col("nb"))).first()[0] or 0
    pairs = pairs.drop("na", "nb")
    both = pairs.join(tiles.select("bucket", key.alias("ka"), F.col("m").alias("a")), ["bucket", "ka"]).join(
        tiles.select("bucket", key.alias("kb"), F.col("m").alias("b")), ["bucket", "kb"]
    )

    def parts(m):
        f = {name: m.field(name) for name in ("comp", "_d", "marks", "bands")}
        return np.array(f["comp"].to_pylist()), f["_d"].to_numpy(zero_copy_only=False), _sketches(f["marks"], f["bands"])

    def meet(batches):
        for batch in batches:
            rows, a, b = [], [], []
            at = (batch.column(c).to_pylist() for c in ("bucket", "ka", "kb"))
            for row, (bucket, ka, kb, one, two) in enumerate(zip(*at, batch.column("a"), batch.column("b"))):
                comp_a, d_a, marks_a = parts(one.values)
                comp_b, d_b, marks_b = parts(two.values)
                ok = (comp_a[:, None] != comp_b[None, :]) & (np.abs(d_a[:, None] - d_b[None, :]) <= step)
                # members are in the order of their ids
                i, j, _ = _agree(bucket, marks_a, marks_b, np.triu(ok, 1) if ka == kb else ok)
                if len(i):
                    rows.append(row)
                    for found, k, m in ((a, i, one.values), (b, j, two.values)):
                        found.append(m.take(pa.array(np.unique(k))).to_pylist())
            if rows:
                of_row = batch.select(["bucket", "ka", "kb"]).take(pa.array(rows))
                kind = batch.schema.field("a").type
                yield pa.RecordBatch.from_arrays([*of_row.columns, pa.array(a, kind), pa.array(b, kind)], names=["bucket", "ka", "kb", "a", "b"])

    kind = {c.name: c.dataType.simpleString() for c in both.schema.fields}
    # rows are large here, so tasks are given few
    both = both.select("bucket", "ka", "kb", "a", "b").repartition(max(1, size // TASK_TEXTS))
    met = table(both.mapInArrow(meet, ", ".join(f"{c} {kind[c]}" for c in ("bucket", "ka", "kb", "a", "b"))))
    side = lambda s: F.transform(s, lambda m: F.struct(F.lit(s).alias("side"), *[m[c].alias(c) for c in ("doc_id", "comp", "marks", "bands", "size")]))
    asked = table(met.select("bucket", "ka", "kb", F.inline(F.concat(side("a"), side("b")))))
    chars = asked.agg(F.sum("size")).first()[0] or 0
    asked_texts = texts.join(asked.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    tile_pair = ["bucket", "ka", "kb"]
    whole = asked.drop("size").join(asked_texts, "doc_id").repartition(1 + chars // TASK_CHARS, *tile_pair)

    def verify(key, rows):
        t = rows.combine_chunks()
        sides = [t.filter(pc.equal(t.column("side"), s)) for s in "ab"]
        (ids_a, comp_a, texts_a), (ids_b, comp_b, texts_b) = ([t.column(c).to_pylist() for c in ("doc_id", "comp", "text")] for t in sides)
        marks_a, marks_b = (_sketches(t.column("marks").combine_chunks(), t.column("bands").combine_chunks()) for t in sides)
        ok = np.array(comp_a)[:, None] != np.array(comp_b)[None, :]
        if key[1] == key[2]:
            ok &= np.array(ids_a)[:, None] < np.array(ids_b)[None, :]
        i, j, agree = _agree(key[0].as_py(), marks_a, marks_b, ok)
        root = {c: c for c in {*comp_a, *comp_b}}

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        shingle, known_a, known_b = Shingler(), {}, {}

        def of(known, texts, k):
            if k not in known:
                known[k] = shingle(texts[k])
            return known[k]

        a, b = [], []
        # the likeliest first, since connected classes need no more links
        for k in np.argsort(-agree, kind="stable"):
            x, y = int(i[k]), int(j[k])
            u, v = find(comp_a[x]), find(comp_b[y])
            if u != v and probability_jaccard(of(known_a, texts_a, x), of(known_b, texts_b, y)) >= least:
                root[u] = v
                a.append(min(ids_a[x], ids_b[y])), b.append(max(ids_a[x], ids_b[y]))
        kind = t.schema.field("doc_id").type
        return pa.table({"a": pa.array(a, kind), "b": pa.array(b, kind)})

    id_kind = rest.schema["doc_id"].dataType.simpleString()
    return whole.groupBy(*tile_pair).applyInArrow(verify, f"a {id_kind}, b {id_kind}")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """doc_id, content_id, class_id of each different id: its class of near duplicates, named by the smallest id.

    ``content_id`` is the smallest id with the same shingles; such copies are never compared. The
    others meet in buckets of equal bands. There all are first compared with the one that meets
    most others, in later rounds with one drawn anew, until few comparisons between classes
    are left. Those are then all made, tile against tile, but for two kinds that can't be links: the
    distance 1 - similarity obeys the triangle inequality, so texts whose distances to the first
    centre differ by more than 1 - ``least`` are apart; and so are those of which far
    too few registers agree. Texts with a probability Jaccard of ``least`` or more on shingles
    of five words are linked, and classes are the connected components.

    Null and empty texts, and others without words, are copies where the text is equal, and
    near nothing else. Rows with a null id are left out. Of rows with equal ids but different
    texts all are compared, and the id gets the smallest class of theirs.
    """
    rows = ids_and_texts(df, id_col, text_col).filter("doc_id IS NOT NULL")
    sketch = table(_sketch(rows))
    contents = table(sketch.groupBy("content").agg(F.min("doc_id").alias("content_id")))
    one = table(
        sketch.filter("bands IS NOT NULL").join(contents.select("content", F.col("content_id").alias("doc_id")), ["content", "doc_id"])
        .select("doc_id", F.explode("bands").alias("bucket")).distinct()
    )
    shared = one.groupBy("bucket").agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi")).filter("_lo <> _hi")
    members = table(one.join(shared.select("bucket"), "bucket"))
    texts = table(rows.join(members.select("doc_id").distinct(), "doc_id", "left_semi"))

    marks = table(sketch.filter("bands IS NOT NULL").join(texts.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "content"]).drop("content"))
    links, labels, far = None, table(members.select("doc_id").distinct().withColumn("comp", F.col("doc_id"))), None
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    for turn in range(STARS + 1):
        classed = members.join(labels, "doc_id")
        in_class = classed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("_n"))
        open_ = table(
            in_class.groupBy("bucket").agg(
                F.sum("_n").cast("double").alias("_all"), F.sum(F.col("_n").cast("double") * F.col("_n")).alias("_sq"), F.count(F.lit(1)).alias("_k")
            ).filter("_k > 1").select("bucket", "_all", ((F.col("_all") * F.col("_all") - F.col("_sq")) / 2).alias("_pairs"))
        )
        left = open_.agg(F.sum("_pairs").alias("p"), F.sum("_all").alias("m")).first()
        if not left["m"]:
            break
        rest = classed.join(open_.select("bucket", "_all"), "bucket")
        last = turn > 0 and (turn == STARS or left["p"] <= FEW * left["m"])
        if last:
            found = table(_links(rest.join(far, ["bucket", "doc_id"]).select("bucket", "doc_id", "comp", "_d"), marks, texts, 1.0 - least + 1e-9, least))
            links = links.unionByName(found)
            break
        order = hash_order(F.col("doc_id"), turn)
        if turn == 0:
            met = rest.groupBy("doc_id").agg(F.sum("_all").alias("_met"))
            rest, order = rest.join(met, "doc_id"), -F.col("_met")
        drawn = F.min(F.struct(order.alias("_at"), F.col("doc_id").alias("c"), F.col("comp").alias("_cc")))
        centre = table(rest.groupBy("bucket").agg(drawn.alias("_c")).select("bucket", "_c.c", "_c._cc"))
        beside = rest.join(centre, "bucket")
        pairs = beside.filter("comp <> _cc").select(*pair("doc_id", "c"))
        pairs = table(pairs.distinct())
        found = table(_similarities(_agreeing(pairs, marks) if turn else pairs, texts))
        if turn == 0:
            known = found.select("a", "b", (1 - F.col("similarity")).alias("_d"))
            far = table(
                beside.select("bucket", "doc_id", "c", *pair("doc_id", "c")).join(known, ["a", "b"], "left")
                .select("bucket", "doc_id", F.when(F.col("doc_id") == F.col("c"), 0.0).otherwise(F.col("_d")).alias("_d"))
            )
        found = found.filter(F.col("similarity") >= least).select("a", "b")
        links = found if links is None else links.unionByName(found)
        # a cheap step towards classes, enough to see what need not be compared; the exact classes come at the end
        ends = found.join(labels.select(F.col("doc_id").alias("a"), F.col("comp").alias("la")), "a").join(
            labels.select(F.col("doc_id").alias("b"), F.col("comp").alias("lb")), "b"
        )
        ways = F.explode(F.array(F.struct(F.col("la").alias("u"), F.col("lb").alias("v")), F.struct(F.col("lb").alias("u"), F.col("la").alias("v"))))
        near = table(ends.filter("la <> lb").select(ways.alias("_w")).select("_w.*").distinct())
        # all that a class touches goes to the lowest of them
        least_near = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("_to"))
        moved = near.join(least_near.withColumnRenamed("u", "v"), "v").groupBy(F.col("u").alias("comp")).agg(F.min("_to").alias("_to"))
        labels = table(labels.join(moved, "comp", "left").select("doc_id", F.coalesce(F.least("_to", "comp"), "comp").alias("comp")))

    of_content = contents.withColumn("comp", F.col("content_id"))
    if links is not None:
        comp = connected_components(links, LINKS_AT_ONCE)
        of_content = contents.join(comp, F.col("content_id") == F.col("node"), "left").select("content", "content_id", "comp")
    return (
        sketch.select("doc_id", "content").join(of_content, "content")
        .groupBy("doc_id").agg(F.min("content_id").alias("content_id"), F.min(F.coalesce("comp", "content_id")).alias("class_id"))
    )


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose id names its class; one of each id. Rows with a null id stay."""
    found = near_duplicates(df, id_col, text_col).filter("doc_id = class_id").select(F.col("doc_id").alias("_first_id"))
    kept = df.join(found, df[id_col] == found["_first_id"], "left_semi")
    repeats = kept.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if not repeats.isEmpty():
        kept = kept.dropDuplicates([id_col])
    return kept.unionByName(df.filter(df[id_col].isNull()))
