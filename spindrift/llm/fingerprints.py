"""Document fingerprints from content-defined chunks.

Normalised chunking (Xia et al., FastCDC, 2016) cuts a text's UTF-8 bytes where a gear hash of
the last bytes has zero bits, stricter before the usual size and laxer beyond, so an
edit moves only the boundaries near it. A fingerprint is the set of chunk digests with
their lengths; the length held in common measures containment.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ids_and_texts, partitions

LEAST, USUAL, MOST = 16, 32, 128  # bytes of a chunk
WINDOW = 16  # bytes that a boundary depends on
STRICT, LAX = 6, 4  # zero bits wanted before and beyond the usual size
BLOCKS_A_PARTITION = 8

# one 32-bit number a byte, made from a rule
GEAR = np.frombuffer(hashlib.shake_256(b"gear").digest(1024), "<u4").copy()


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; the last is its length. Empty data has none."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW:  # sums of 2, 4, 8, 16 shifted bytes
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    # bytes that leave the window have been shifted by WINDOW bits: the top 16 bits hold the window's
    top = h >> np.uint32(32 - STRICT)
    lax = np.flatnonzero((top & np.uint32((1 << LAX) - 1)) == 0) + 1
    strict = (top[lax - 1] == 0).tolist()
    lax = lax.tolist()
    ends, start, i, m = [], 0, 0, len(lax)
    while n - start > LEAST:
        low, mid, high = start + LEAST, start + USUAL, min(start + MOST, n)
        while i < m and lax[i] < low:
            i += 1
        end = high
        while i < m and lax[i] < high:
            if lax[i] >= mid or strict[i]:
                end = lax[i]
                break
            i += 1
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunk_lengths(text: str) -> dict[str, int]:
    """Length in bytes by digest of the different chunks of a text."""
    data = text.encode("utf-8", "replace")
    out, start = {}, 0
    for end in boundaries(data):
        part = data[start:end]
        out[xxhash.xxh3_64_hexdigest(part)[:12]] = end - start
        start = end
    return out


def written(chunks: dict[str, int]) -> str:
    """``digest:length`` of the chunks, sorted, joined by commas."""
    return ",".join([f"{d}:{n}" for d, n in sorted(chunks.items())])


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of the length of ``a`` whose chunks ``b`` has too; an empty ``a`` is contained in an empty ``b`` alone."""
    total = sum(a.values())
    if not total:
        return 0.0 if b else 1.0
    if len(a) > len(b):
        return sum(a[d] for d in b if d in a) / total
    return sum(n for d, n in a.items() if d in b) / total


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``fingerprint`` of each row; a null text counts as empty and has the empty fingerprint."""
    rows = ids_and_texts(df, id_col, text_col)

    def run(batches):
        for batch in batches:
            prints = [written(chunk_lengths(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _block_of(key: Column, limits: list[int]) -> Column:
    """Place of the last limit up to the key; found in two steps of about the root of their number."""
    width = math.isqrt(len(limits)) + 1
    groups = [limits[i : i + width] for i in range(0, len(limits), width)]
    number = lambda x: f"CAST('{x}' AS BIGINT)"
    heads = F.expr(f"array({', '.join(number(g[0]) for g in groups)})")
    parts = F.expr(f"array({', '.join('array(' + ', '.join(map(number, g)) + ')' for g in groups)})")
    group = F.size(F.filter(heads, lambda x: x <= key)) - 1
    return group * width + F.size(F.filter(F.get(parts, group), lambda x: x <= key)) - 1


def with_following(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, _block, _guest, _key``: blocks of neighbouring ids, each with the next block's first row as guest.

    The limits of the blocks are quantiles of the ids, a few for each shuffle partition, so
    each block starts at its limit and the row of that id goes to the block before it
    too. The smallest id is the guest of the last block, where it follows the largest.
    """
    rows = ids_and_texts(df, id_col, text_col)
    rows = rows.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")))
    n = BLOCKS_A_PARTITION * partitions(df)
    at = F.expr(f"array({', '.join(f'{i / n}D' for i in range(n))})")
    found = rows.agg(F.percentile_approx("_key", at, F.lit(max(10_000, 10 * n))).alias("at"), F.min("_key").alias("least")).first()
    if found["least"] is None:
        return rows.select("doc_id", "text", F.lit(0).alias("_block"), F.lit(False).alias("_guest"), "_key")
    limits = sorted({found["least"], *found["at"]})
    home = F.col("_home")
    before = F.when(F.col("_key") == limits[0], len(limits) - 1).when(F.col("_starts"), home - 1)
    places = F.array_compact(F.array(
        F.struct(home.alias("_block"), F.lit(False).alias("_guest")),
        F.when(before.isNotNull(), F.struct(before.alias("_block"), F.lit(True).alias("_guest"))),
    ))
    starts = F.expr(f"_key IN ({', '.join(f"CAST('{x}' AS BIGINT)" for x in limits)})")
    return (
        rows.withColumn("_home", _block_of(F.col("_key"), limits)).withColumn("_starts", starts)
        .select("doc_id", "text", F.explode(places).alias("_p"), "_key")
        .select("doc_id", "text", "_p._block", "_p._guest", "_key")
    )


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and how much of the first the others contain.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited
    text has its last quarter replaced from the row of the next id (the last row from the first); near_edited
    and near_next are the containment of the row's fingerprint in the edited text's and the next
    row's. Ids are whole numbers; null counts as the smallest. Null texts count as
    empty, and an empty text is contained in an empty one alone. Rows of equal id follow each
    other in the order of their texts. An empty table gives no rows. A text crosses the network once.
    """
    rows = with_following(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt = rows.repartition(partitions(df), "_block").sortWithinPartitions("_block", "_guest", "_key", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches):
        waiting = None
        for batch in batches:
            out = [[] for _ in names]
            ids, texts, blocks, guests = (batch.column(i) for i in range(4))
            for doc, text, block, guest in zip(ids.to_pylist(), texts, blocks.to_pylist(), guests.to_pylist()):
                text = text.as_py()
                if guest and waiting is None:
                    continue
                own = chunk_lengths(text)
                if waiting is not None:
                    was_id, was, was_chunks = waiting
                    new = edited(was, text)
                    new_chunks = chunk_lengths(new)
                    row = (
                        was_id, len(was), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), written(was_chunks),
                        written(new_chunks), containment(was_chunks, new_chunks), containment(was_chunks, own),
                    )
                    for column, value in zip(out, row):
                        column.append(value)
                waiting = None if guest else (doc, text, own)
            arrays = [pa.array(v, k or ids.type) for v, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return dealt.mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
