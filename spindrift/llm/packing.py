"""Packing documents into sequences of fixed length by patterns of lengths.

Krell et al., "Efficient Sequence Packing without Cross-contamination" (2021): patterns of few
lengths that fill a sequence are enumerated, non-negative least squares fits how often each
is repeated so that the histogram of lengths is used up, the counts are rounded, and what
is left is packed by best fit. Only the histogram (one row per length) reaches the driver;
documents are sorted by length on Spark, and a document's rank among all says which
place of which pattern is its own.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.cut import table
from ..plans.numbering import number_rows
from .common import ids_and_texts

MAX_TOKENS = 2_048
END_ID = 0
FIT_STEPS = 300
CACHED_WORDS = 400_000  # of a generation

# fixed values: the white space that the tokenizer drops
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # str.split takes these for white space, the tokenizer doesn't


class _Words:
    """Token ids of words as little-endian bytes, each worked out once as long as it is held.

    The tokenizer never joins what white space parts, so words are encoded one by one. It also
    splits a run of letters from what follows, so commas and stops behind a plain word are looked up on
    their own, and plain words new to a text are encoded in one call. Words wait in one of
    two generations: when the younger is full, the older one goes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _encode_plain(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of lower-case letters, each of which is one piece to the tokenizer."""
        if not words:
            return {}
        e = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        piece = np.array(e.word_ids)
        ends = [*(4 * (np.flatnonzero(piece[1:] != piece[:-1]) + 1)).tolist(), 4 * len(piece)]
        if len(ends) != len(words):
            return {w: self._encode(w) for w in words}
        data = array("I", e.ids).tobytes()
        return {w: data[i:j] for w, i, j in zip(words, [0, *ends], ends)}

    def _learn(self, words: set[str]) -> None:
        young, old = self.young, self.old
        parts, new = {}, {}
        for w in words:
            if w in old:
                young[w] = old[w]
                continue
            stem = w.rstrip(".,")
            # letters up to this one have lower case as the tokenizer's
            if stem.isalpha() and max(stem) <= "\xff":
                low, tail = stem.lower(), w[len(stem) :]
                parts[w] = low, tail
                if tail and tail not in young:
                    young[tail] = self._encode(tail)
                if low not in young:
                    if low in old:
                        young[low] = old[low]
                    else:
                        new[low] = None
            else:
                young[w] = self._encode(w)
        young.update(self._encode_plain(list(new)))
        for w, (low, tail) in parts.items():
            young[w] = young[low] + young[tail] if tail else young[low]

    def ids(self, text: str) -> bytes:
        words = [w for w in _SPACE.split(text) if w] if _SEPARATORS.search(text) else text.split()
        found = list(map(self.young.get, words))
        if None in found:
            if len(self.young) > CACHED_WORDS:
                self.young, self.old = {}, self.young
            self._learn({w for w, f in zip(words, found) if f is None} if self.young else set(words))
            found = map(self.young.__getitem__, words)
        return b"".join(found)


@lru_cache(maxsize=1)
def _words_of(path: str) -> _Words:
    """One for all tasks that a worker runs."""
    return _Words(path)


def cut_pieces(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    max_tokens: int = MAX_TOKENS, with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each document's pieces.

    A document's ids end with ``END_ID``; those beyond ``max_tokens`` are cut into pieces of
    that length, the last of which may be shorter. A null or empty text is the end id alone.
    ``tokenizer`` is the path of a tokenizer file that parts words at white space.
    """
    rows = ids_and_texts(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        words = _words_of(tokenizer)
        for batch in batches:
            at, pieces, starts, lengths, crcs, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                data = words.ids(text.as_py()) + end
                for k, start in enumerate(range(0, len(data) // 4, max_tokens)):
                    part = data[4 * start : 4 * (start + max_tokens)]
                    at.append(i), pieces.append(k), starts.append(start)
                    lengths.append(len(part) // 4), crcs.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            columns = [
                batch.column(0).take(pa.array(at, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def few_length_patterns(lengths: np.ndarray, full: int) -> np.ndarray:
    """All (a, b, c), a <= b <= c, of given lengths that add up to ``full``; a is 0 for pairs."""
    there = np.zeros(full + 1, bool)
    there[lengths] = True
    there[[0, full]] = False
    found = []
    for a in [0, *lengths[(lengths > 0) & (lengths <= full // 3)]]:
        b = np.arange(max(a, 1), (full - a) // 2 + 1)
        b = b[there[b] & there[full - a - b]]
        found.append(np.column_stack([np.full(len(b), a), b, full - a - b]))
    return np.concatenate(found)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative repeats of the patterns whose lengths come nearest to the histogram in least squares.

    Accelerated projected gradient steps; length 0, the blank of a pair, carries no weight.
    """
    if not len(patterns):
        return np.zeros(0)
    size = len(histogram)
    weight = np.ones(size)
    weight[0] = 0.0
    flat = patterns.ravel()
    # the largest eigenvalue is at most the largest row sum times the largest column sum
    bound = max(1.0, np.bincount(flat, minlength=size)[1:].max() * 3.0)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        rest = (np.bincount(flat, np.repeat(y, 3), size) - histogram) * weight
        new = np.maximum(0.0, y - rest[patterns].sum(axis=1) / bound)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def _round(patterns: np.ndarray, repeats: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeats, carrying fractions on to the next pattern; takes what they use from ``left``."""
    whole = np.diff(np.floor(np.concatenate([[0.0], np.cumsum(repeats)]) + 0.5)).astype(int)
    out = []
    for i in np.flatnonzero(whole):
        parts = [int(p) for p in patterns[i] if p]
        n = min(int(whole[i]), *(int(left[p]) // parts.count(p) for p in parts))
        if n > 0:
            out.append((tuple(parts), n))
            for p in parts:
                left[p] -= n
    return out


def best_fit(left: np.ndarray, full: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the fullest sequence that holds it; equal sequences are kept as one with a count."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {full: []}
    spaces = np.zeros(full + 1, bool)  # which amounts of room some open sequence has
    for length in range(full, 0, -1):
        todo = int(left[length])
        while todo:
            fits = np.flatnonzero(spaces[length:])
            space = int(fits[0]) + length if len(fits) else full
            each = space // length
            if space == full and not room.get(full):
                parts, count = (), -(-todo // each)
            else:
                parts, count = room[space].pop()
                spaces[space] = bool(room[space])
            many = min(count, todo // each)
            placed = [(each, many)] if many else []
            if many < count and todo - many * each and todo // each == many:
                placed.append((todo - many * each, 1))
            for k, n in placed:
                rest = space - k * length
                room.setdefault(rest, []).append((parts + (length,) * k, n))
                spaces[rest] = rest > 0
                todo -= k * n
                count -= n
            if count and parts:
                room[space].append((parts, count))
                spaces[space] = True
    return [p for groups in room.values() for p in groups]


def plan_patterns(histogram: np.ndarray, full: int = MAX_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of the sequences that hold exactly ``histogram[length]`` pieces of each length."""
    left = histogram.astype(np.int64).copy()
    out = [((full,), int(left[full]))] if left[full] else []
    left[full] = 0
    patterns = few_length_patterns(np.flatnonzero(left), full)
    out += _round(patterns, fit_repeats(patterns, left), left)
    return out + best_fit(left, full)


def _places(plan) -> tuple[np.ndarray, ...]:
    """The places of all patterns, shortest length first: first rank, first sequence, offset."""
    lengths, counts, firsts, offsets = [], [], [], []
    sequence = 0
    for parts, n in plan:
        offset = 0
        for p in parts:
            lengths.append(p), counts.append(n), firsts.append(sequence), offsets.append(offset)
            offset += p
        sequence += n
    lengths, counts, firsts, offsets = (np.array(x, np.int64) for x in (lengths, counts, firsts, offsets))
    order = np.argsort(lengths, kind="stable")
    counts = counts[order]
    return np.cumsum(counts) - counts, firsts[order], offsets[order]


def pack(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of each document.

    Pieces of a sequence lie one behind the other from offset 0. Equal lengths, repeated rows and ties
    are told apart by their place in the order (length, id, piece, checksum). The
    plan sent to the tasks has at most one row for each place of a pattern: its size is bounded by
    the number of patterns (some max_tokens^2 / 12), whatever the table. No rows, no sequences.
    """
    pieces = table(cut_pieces(df, tokenizer, id_col, text_col, max_tokens))
    histogram = np.zeros(max_tokens + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        histogram[row["length"]] = row["n"]
    places = pieces.sparkSession.sparkContext.broadcast(_places(plan_patterns(histogram, max_tokens)))
    order = [F.col(c) for c in ("length", "doc_id", "piece", "ids_crc32")]
    ranked = number_rows(pieces, order, "_rank")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def put(batches):
        rank, first, offset = places.value
        for batch in batches:
            at = batch.column("_rank").to_numpy()
            i = np.searchsorted(rank, at, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(first[i] + at - rank[i]), pa.array(offset[i])],
                names=[*names, "sequence_id", "offset"],
            )

    return ranked.select(*names, "_rank").mapInArrow(
        put, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
