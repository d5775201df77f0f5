"""Line dedup by pairwise alignment.

Documents overlap where they share lines. Each window, a few consecutive lines that reach some words,
leads every document that holds it to the first document with it (smallest id), so links grow with
the lines and not with pairs of holders. Linked documents are aligned by patience diff over the lines they
share, and aligned common blocks leave the later document. Every deleted line stays in the
first document that holds it.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.cut import table

LINE_WORDS = 5  # lines with so many words together make a link, a block with fewer stays
WORD_CHARS = 8  # a line counts as a word for so many characters at least
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"  # two letters count as a word
MOVED_WORDS = 15  # a block out of order or repeated needs so many words
NOTICE_SHARE = 0.5  # a line in more than so much of the documents is a notice
NOTICE_WORDS = 8  # a block of notices needs so many words


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned equal entries (i, j) of two lists, both ascending.

    Common ends are matched first, then entries that occur once on either side, as far as they keep
    their order; the stretches between those are treated alike. Where no entry is unique, each
    time it occurs counts as an entry of its own.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_b = _once(b, b0, b1)
        pairs = sorted((i, once_b[x]) for x, i in _once(a, a0, a1).items() if x in once_b)
        if not pairs:
            times_b = _times(b, b0, b1)
            pairs = sorted((i, times_b[x]) for x, i in _times(a, a0, a1).items() if x in times_b)
        for i, j in _rising(pairs):
            todo.append((a0, i, b0, j))
            out.append((i, j))
            a0, b0 = i + 1, j + 1
        if len(pairs):
            todo.append((a0, a1, b0, b1))
    return sorted(out)


def _once(x: list, start: int, end: int) -> dict:
    seen: dict = {}
    for i in range(start, end):
        seen[x[i]] = -1 if x[i] in seen else i
    return {v: i for v, i in seen.items() if i >= 0}


def _times(x: list, start: int, end: int) -> dict:
    counts: dict = {}
    out = {}
    for i in range(start, end):
        k = counts[x[i]] = counts.get(x[i], 0) + 1
        out[x[i], k] = i
    return out


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain in which the second number rises as well."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(last[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j), last.append(k)
        else:
            tops[at], last[at] = j, k
    k = last[-1] if last else -1
    chain = []
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def _runs(x: list[dict]) -> list[tuple[int, int]]:
    """Stretches (from, to) of entries whose lines follow one another."""
    cuts = [0, *[k for k in range(1, len(x)) if x[k]["n"] != x[k - 1]["n"] + 1], len(x)]
    return list(zip(cuts, cuts[1:]))


def moved_blocks(first: list[dict], later: list[dict]) -> list[tuple[int, int]]:
    """Ranges of entries of ``later`` (both included) in common blocks of MOVED_WORDS, wherever in ``first`` they are.

    A suffix automaton of ``first`` gives for each entry of ``later`` the longest common block that
    ends there, so all of them are found, in any order and however often, in linear time.
    """
    shared = {x["hash"] for x in later}
    first = [x for x in first if x["hash"] in shared]
    follow: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for k, (start, end) in enumerate(_runs(first)):
        for key in [*(x["hash"] for x in first[start:end]), ("gap", k)]:
            new = len(follow)
            follow.append({}), link.append(0), length.append(length[last] + 1)
            at, last = last, new
            while at >= 0 and key not in follow[at]:
                follow[at][key] = new
                at = link[at]
            if at >= 0:
                to = follow[at][key]
                if length[to] == length[at] + 1:
                    link[new] = to
                else:
                    twin = len(follow)
                    follow.append(dict(follow[to])), link.append(link[to]), length.append(length[at] + 1)
                    link[to] = link[new] = twin
                    while at >= 0 and follow[at].get(key) == to:
                        follow[at][key] = twin
                        at = link[at]
    sums = [0]
    for x in later:
        sums.append(sums[-1] + x["words"])
    out: list[tuple[int, int]] = []
    for start, end in _runs(later):
        at = size = 0
        for j in range(start, end):
            key = later[j]["hash"]
            while at and key not in follow[at]:
                at = link[at]
                size = length[at]
            if key in follow[at]:
                at, size = follow[at][key], size + 1
            begin = j + 1 - size
            if size and sums[j + 1] - sums[begin] >= MOVED_WORDS:
                if out and out[-1][0] >= start and begin <= out[-1][1] + 1:
                    out[-1] = (out[-1][0], j)
                else:
                    out.append((begin, j))
    return out


def _enough(lines: list[dict]) -> bool:
    return sum(x["words"] for x in lines if not x["notice"]) >= LINE_WORDS or sum(x["words"] for x in lines) >= NOTICE_WORDS


def common_blocks(first: list[dict], later: list[dict]) -> list[tuple[int, int]]:
    """Ranges of lines of ``later`` to delete: aligned blocks of enough words, and moved or repeated ones.

    An entry has ``n`` (its number among lines that aren't blank), ``pos``, ``hash``, ``words``, ``notice``.
    """
    matched = patience([x["hash"] for x in first], [x["hash"] for x in later])
    blocks: list[list[tuple[int, int]]] = []
    for i, j in matched:
        if blocks:
            pi, pj = blocks[-1][-1]
            if first[i]["n"] == first[pi]["n"] + 1 and later[j]["n"] == later[pj]["n"] + 1:
                blocks[-1].append((i, j))
                continue
        blocks.append([(i, j)])
    out, gone = [], set()
    for block in blocks:
        lines = [later[j] for _, j in block]
        if _enough(lines):
            out.append((lines[0]["pos"], lines[-1]["pos"]))
            gone.update(j for _, j in block)
    left = {x["hash"] for j, x in enumerate(later) if j not in gone}
    if any(x["hash"] in left for x in first):
        out += [(later[i]["pos"], later[j]["pos"]) for i, j in moved_blocks(first, later)]
    return out


def windows(entries: list[dict]) -> list[int]:
    """A hash for each entry of the lines from it on that first reach LINE_WORDS, if that many follow one another."""
    out = []
    for k, x in enumerate(entries):
        h, words, n = x["hash"], x["words"], x["n"]
        while words < LINE_WORDS:
            k, n = k + 1, n + 1
            if k == len(entries) or entries[k]["n"] != n:
                break
            h = (h * 0x9E3779B97F4A7C15 ^ entries[k]["hash"]) & (1 << 64) - 1
            words += entries[k]["words"]
        else:
            out.append(h - (1 << 64) if h >= 1 << 63 else h)
    return out


def _key(id_col: str, text_col: str) -> Column:
    """Rows of equal id and text are one document; the id comes first in the order."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))


def document_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, pos, n, hash, words of each line that isn't blank; lines are compared without outer blanks."""
    lines = F.transform(
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1),
        lambda x, i: F.struct(i.alias("pos"), F.trim(x).alias("line")),
    )
    rows = df.select(_key(id_col, text_col).alias("doc"), F.filter(lines, lambda x: x.line != "").alias("_l"))
    rows = rows.select("doc", F.posexplode("_l").alias("n", "_x"))
    line = F.col("_x.line")
    return rows.select(
        "doc", F.col("_x.pos").alias("pos"), "n",
        # a second hash in the top bits would be no wider; the length tells most collisions apart
        F.struct(F.xxhash64(line).alias("x"), F.length(line).alias("c")).alias("hash"),
        F.greatest(
            F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1, (F.length(line) / WORD_CHARS).cast("int"),
            F.when(F.octet_length(line) > F.length(line), (F.regexp_count(line, F.lit(UNSPACED)) / 2).cast("int")),
        ).alias("words"),
    )


def notice_lines(lines: DataFrame, documents: int) -> DataFrame:
    """hash of the lines of few words in more than NOTICE_SHARE of the documents, repeats inside one counted once."""
    least = NOTICE_SHARE * documents
    few = lines.filter(F.col("words") < NOTICE_WORDS)
    # at most 1 / NOTICE_SHARE times the lines of an average document
    often = table(few.groupBy("hash").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > least).select("hash"))
    found = few.join(F.broadcast(often), "hash").select("hash", "doc").distinct()
    return table(found.groupBy("hash").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > least).select("hash"))


def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, ranges: the line ranges (array<struct<start, stop>>, both included) each document loses."""
    lines = table(document_lines(df, id_col, text_col))
    shared = (
        lines.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("_last"))
        .filter("first <> _last").select("hash", "first")
    )
    notices = F.broadcast(notice_lines(lines, df.count()).withColumn("_notice", F.lit(True)))
    held = lines.join(shared, "hash").join(notices, "hash", "left").withColumn("notice", F.col("_notice").isNotNull())
    held = table(held.drop("_notice"))
    entry = F.struct("n", "pos", F.xxhash64("hash").alias("hash"), "words", "notice")
    by_doc = table(held.groupBy("doc").agg(F.array_sort(F.collect_set(entry)).alias("entries")))
    kind = by_doc.schema["doc"].dataType.simpleString()

    def window(batches):
        for batch in batches:
            at, found = [], []
            for i, entries in enumerate(batch.column(1)):
                new = set(windows(entries.as_py()))
                at += [i] * len(new)
                found += new
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.int64())], names=["doc", "window"]
            )

    held_windows = table(by_doc.select("doc", "entries").mapInArrow(window, f"doc {kind}, window long"))
    leads = (
        held_windows.groupBy("window").agg(F.min("doc").alias("first"), F.max("doc").alias("_last"))
        .filter("first <> _last").select("window", "first")
    )
    links = held_windows.join(leads, "window").filter(F.col("doc") != F.col("first")).select("first", "doc").distinct()
    pairs = (
        links.join(by_doc.select(F.col("doc").alias("first"), F.col("entries").alias("a")), "first")
        .join(by_doc.withColumnRenamed("entries", "b"), "doc").select("doc", "a", "b")
    )

    def align(batches):
        for batch in batches:
            docs, starts, stops = [], [], []
            for i, (a, b) in enumerate(zip(batch.column(1), batch.column(2))):
                for start, stop in common_blocks(a.as_py(), b.as_py()):
                    docs.append(i), starts.append(start), stops.append(stop)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(docs, pa.int64())), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())],
                names=["doc", "start", "stop"],
            )

    found = pairs.mapInArrow(align, f"doc {kind}, start int, stop int")
    return found.groupBy("doc").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df``, all columns, with what repeats earlier documents deleted from ``text_col``, and ``_removed_lines``.

    Earlier means a smaller id. Texts that lose nothing are unchanged (null stays null); one that
    loses all its lines becomes empty. Repeated rows (equal id and text) are one document and
    both stay; rows of equal id with different texts are different documents. Blank lines
    never match; those inside a deleted block go with it. No rows are dropped.
    """
    ranges = repeated_ranges(df, id_col, text_col)
    whole = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), _key(id_col, text_col).alias("doc"))
    text = F.col(f"_row.`{text_col}`")
    joined = whole.join(ranges, "doc", "left")
    kept = F.filter(
        F.split(text, "\n", -1), lambda x, i: ~F.exists("ranges", lambda r: (r.start <= i) & (i <= r.stop))
    )
    lines = F.size(F.split(text, "\n", -1))
    joined = joined.withColumn("_kept", F.when(F.col("ranges").isNotNull(), kept))
    new = F.when(F.col("_kept").isNotNull(), F.array_join("_kept", "\n")).otherwise(text)
    return joined.select(
        *[new.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in df.columns],
        F.when(F.col("_kept").isNotNull(), lines - F.size("_kept")).otherwise(0).alias("_removed_lines"),
    )
