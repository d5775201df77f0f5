"""Removal of byte strings that occur more than once, by suffix sorting in shards.

A place is repeated if the ``span`` bytes from it on start anywhere else too. Two equal strings of that
length have equal hashes of all the shorter strings inside them, so they have the same least one. Each run of
places that share their least hash becomes a region, regions of one hash go to one shard,
and there the suffixes of all different regions are sorted by external induction
(``induced``), whose common prefixes tell the repeated places. Equal regions are found before, by their
digests, and only one of them is sorted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.cut import ensure_checkpoint_dir, table
from ..plans.skew import attach
from . import induced

SPAN = 400
CHUNK = 1 << 20        # places looked at once
SHARD_BYTES = 1 << 20  # of regions that are sorted together, at about 70 bytes of memory for each byte; a hash with more has a shard of its own

_STEP = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.frombuffer(hashlib.shake_256(b"bytes").digest(8 * 256), "<u8")
_BASE = 0xD6E8FEB86659FD93
_BACK = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2^64."""

    def __init__(self, n: int):
        self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE, np.uint64)])
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, _BACK, np.uint64)])


def least_hashes(text: np.ndarray, span: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """For each place the least hash of the strings of span / 2 bytes inside its ``span`` bytes, and where that is."""
    part = span // 2
    total = np.r_[np.uint64(0), np.cumsum(_TABLE[text] * powers.up[:len(text)])]
    hashes = _mix((total[part:] - total[:-part]) * powers.down[:len(text) - part + 1])
    # the top bits of the hash, and the place: equal hashes go by the place
    bits = np.uint64(len(hashes).bit_length())
    least = hashes >> bits << bits | np.arange(len(hashes), dtype=np.uint64)
    width, wanted = 1, span - part + 1
    while width * 2 <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[:len(least) - (wanted - width)], least[wanted - width:])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return hashes[at], at


def regions(texts: list[bytes], span: int, powers: Powers):
    """(text, anchor, start, places, more) of the regions of some texts.

    A region is a run of ``places`` from ``start`` with one least hash, ``anchor``; it spans places + span - 1 bytes. ``more``: the
    hash occurs several times inside, so that the region may repeat itself. No region has more than span places.
    """
    sizes = np.array([len(t) for t in texts])
    begin = np.r_[0, np.cumsum(sizes)]
    text = np.frombuffer(b"".join(texts), np.uint8)
    if len(text) < span:
        return (np.zeros(0, np.int64),) * 5
    anchor, at = least_hashes(text, span, powers)
    # places whose span ends inside their text
    places = np.maximum(sizes - span + 1, 0)
    doc = np.repeat(np.arange(len(texts)), places)
    own = np.arange(len(doc)) - np.repeat(np.r_[0, np.cumsum(places)[:-1]], places)
    place = begin[doc] + own
    anchor, at = anchor[place], at[place]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])] if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(doc)])
    more = at[first] != at[first + count - 1] if len(first) else np.zeros(0, bool)
    # long runs are cut
    cuts = -(-count // span)
    run = np.repeat(np.arange(len(first)), cuts)
    step = (np.arange(len(run)) - np.repeat(np.r_[0, np.cumsum(cuts)[:-1]], cuts)) * span if len(run) else np.zeros(0, np.int64)
    start = first[run] + step
    count = np.minimum(count[run] - step, span)
    return doc[start], anchor[start].view(np.int64), own[start], count, more[run]


def _digest(data: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(data)
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


REGIONS = "r1 long, r2 long, anchor long, h1 long, h2 long, start long, places int, more boolean"


def document_regions(docs: DataFrame, span: int) -> DataFrame:
    """The regions of ``docs(r1, r2, text)``, texts binary, with a digest (h1, h2) of their bytes."""
    def run(batches):
        powers = Powers(CHUNK + 2 * span)

        def made(waiting):
            """Regions of (r1, r2, offset, text) pieces."""
            which, anchor, start, places, more = regions([w[3] for w in waiting], span, powers)
            digests = [
                _digest(waiting[i][3][s:s + n + span - 1]) for i, s, n in zip(which.tolist(), start.tolist(), places.tolist())
            ]
            r1, r2, offset = (np.array(c, np.int64) for c in list(zip(*waiting))[:3])
            h1, h2 = zip(*digests) if digests else ((), ())
            columns = [r1[which], r2[which], anchor, np.array(h1, np.int64), np.array(h2, np.int64), start + offset[which],
                       places.astype(np.int32), np.asarray(more, bool)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in REGIONS.split(", ")])

        waiting, size = [], 0
        for batch in batches:
            for r1, r2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py()
                if len(text) < span:
                    continue
                # a long text is looked at in pieces that share span - 1 bytes
                for i in range(0, len(text) - span + 1, CHUNK):
                    piece = text[i:i + CHUNK + span - 1]
                    if size + len(piece) > CHUNK + span and waiting:
                        yield made(waiting)
                        waiting, size = [], 0
                    waiting.append((r1, r2, i, piece))
                    size += len(piece)
        if waiting:
            yield made(waiting)

    return docs.mapInArrow(run, REGIONS)


FOUND = "anchor long, h1 long, h2 long, ranges array<struct<lo: int, hi: int>>"


def repeated_places(parts: DataFrame, span: int, folder: str, shard_bytes: int, in_memory: int, held: int) -> DataFrame:
    """anchor, h1, h2 and ranges of repeated places of the regions ``parts(anchor, h1, h2, data)``, one shard after the other."""
    def run(batches):
        group, size = [], 0

        def sort():
            found = induced.repeated([g[3] for g in group], span, folder, in_memory, held)
            rows = []
            for (anchor, h1, h2, _), hit in zip(group, found):
                edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
                if len(edge):
                    rows.append((anchor, h1, h2, [{"lo": int(a), "hi": int(b)} for a, b in zip(edge[::2], edge[1::2] - 1)]))
            kinds = [pa.int64()] * 3 + [pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))]
            columns = list(zip(*rows)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "h1", "h2", "ranges"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if group and size > shard_bytes and row[0] != group[-1][0]:
                    yield sort()
                    group, size = [], 0
                group.append(row)
                size += len(row[3])
        if group:
            yield sort()

    return parts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, FOUND)


def repeated_spans(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, shard_bytes: int = SHARD_BYTES,
    in_memory: int = induced.IN_MEMORY, held: int = induced.HELD_ENTRIES,
) -> DataFrame:
    """r1, r2, spans: for each document (see ``_keyed``) the byte ranges that some repeated string of ``span`` bytes covers."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir()
    docs = _keyed(df, id_col, text_col).select("r1", "r2", "text")
    found = table(document_regions(docs, span))
    one = F.when(F.col("more"), 2).otherwise(1)
    shared = found.groupBy("anchor").agg(F.sum(one).alias("_one"), F.count(F.lit(1)).alias("_n")).filter("_one > 1").select("anchor", "_n")
    kept = table(attach(found, shared, ["anchor"], "_n").drop("_n"))

    key = ["anchor", "h1", "h2"]
    spot = F.min(F.struct("r1", "r2", "start", "places")).alias("spot")
    different = table(kept.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("more").alias("more"), spot))
    beside = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("_k"), F.max("more").alias("_more")).filter("_k > 1 OR _more")
    asked = attach(different, beside, ["anchor"], "_k").select(*key, "spot.*")
    wanted = F.collect_list(F.struct(*key, "start", "places")).alias("wanted")
    texts = docs.join(asked.groupBy("r1", "r2").agg(wanted), ["r1", "r2"])

    def cut(batches):
        for batch in batches:
            rows = [
                (w["anchor"], w["h1"], w["h2"], text[w["start"]:w["start"] + w["places"] + span - 1])
                for text, ws in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in ws
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 3 + [pa.binary()])], names=[*key, "data"]
                )

    parts = texts.select("text", "wanted").mapInArrow(cut, "anchor long, h1 long, h2 long, data binary")
    sorted_ = repeated_places(parts, span, folder, shard_bytes, in_memory, held)
    # all places of a region that occurs twice are repeated
    whole = F.array(F.struct(F.lit(0).alias("lo"), (F.col("spot.places") - 1).alias("hi")))
    ranges = different.filter("n > 1").select(*key, "n", whole.alias("ranges")).unionByName(
        table(sorted_).join(different.filter("n = 1").select(*key, "n"), key).select(*key, "n", "ranges").dropDuplicates(key)
    )
    hits = attach(kept.select(*key, "r1", "r2", "start"), ranges, key, "n").select("r1", "r2", "start", F.explode("ranges").alias("x"))
    spans = hits.select(
        "r1", "r2", F.struct((F.col("start") + F.col("x.lo")).alias("start"), (F.col("start") + F.col("x.hi") + span).alias("stop")).alias("s")
    )
    return spans.groupBy("r1", "r2").agg(F.array_sort(F.collect_set("s")).alias("spans"))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text (UTF-8 bytes) and a key of 128 bits of both; repeated rows have one key."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    key = lambda seed: F.xxhash64(F.lit(seed), F.col(id_col).isNull(), F.col(id_col), text)
    return df.select(F.col(id_col).alias("doc_id"), text.alias("text"), key(1).alias("r1"), key(2).alias("r2"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in spans:
        if out and s["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["stop"]))
        else:
            out.append((s["start"], s["stop"]))
    return out


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, n_bytes, kept (binary), spans (array of start, stop) of each row.

    ``kept`` is the text's UTF-8 bytes without those that are covered by a string of ``span`` bytes which starts anywhere
    else too, in the same text or another; ``spans`` are the maximal runs removed. All copies lose it, and strings are
    judged on the input. No string crosses from one text into another.

    A null text is empty. Repeated rows, and rows of equal id, are documents of their own; a null id is kept. Texts
    shorter than ``span`` bytes stay whole. Other columns are ignored. An empty table gives no rows.
    """
    docs = _keyed(df, id_col, text_col).join(repeated_spans(df, id_col, text_col, **how), ["r1", "r2"], "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            kept, gone, sizes = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                merged = _merged(spans or [])
                bounds = [0, *(x for s in merged for x in s), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
                gone.append([{"start": a, "stop": b} for a, b in merged])
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(gone, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                names=["doc_id", "n_bytes", "kept", "spans"],
            )

    return docs.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, kept binary, spans array<struct<start: bigint, stop: bigint>>"
    )
