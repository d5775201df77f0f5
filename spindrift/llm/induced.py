"""Suffix order and common prefixes of a shard by external induced sorting.

Bingmann, Fischer and Osipov, "Inducing Suffix and LCP Arrays in External Memory" (2013). The suffixes that
start a rise (S*) are sorted first: their substrings are named, and the string of names is sorted
recursively, or in memory once it is short. All others follow by induction in two
scans: a scanned suffix puts the one before it into a queue, keyed by its first symbol, with the common prefix it
has with the one put there last. The queues hold (position, common prefix) and go to files
beyond a bound. Each queue is drained in large pieces, so the work is done on arrays.

Common prefixes are counted in bytes up to a cap, and the order is that of the first ``cap`` bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyarrow import fs

PIECE = 1 << 16        # entries scanned at once
IN_MEMORY = 4_000_000  # names that are sorted in memory
HELD_ENTRIES = 8_000_000  # entries of all queues held before some go to files


class Queues:
    """First-in, first-out queues of (position, common prefix), which share one bound of memory.

    When more than ``held`` entries are in memory, the longest queues go to files in ``folder`` (any file
    system that pyarrow opens by address).
    """

    def __init__(self, folder: str, held: int = HELD_ENTRIES):
        self.folder, self.bound, self.held, self.spilled = folder, held, 0, 0
        self.parts: dict = {}    # queue -> arrays or (path, entries), oldest first
        self.loose: dict = {}    # queue -> entries in memory
        self.files = None

    def put(self, queue, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts.setdefault(queue, []).append((pos, lcp))
        self.loose[queue] = self.loose.get(queue, 0) + len(pos)
        self.held += len(pos)
        if self.held > self.bound:
            for q in sorted(self.loose, key=self.loose.get, reverse=True):
                self._spill(q)
                if self.held <= self.bound // 2:
                    break

    def _spill(self, queue) -> None:
        parts = self.parts[queue]
        first = next((i for i, p in enumerate(parts) if not isinstance(p[0], str)), len(parts))
        if first == len(parts):
            return
        pos, lcp = (np.concatenate(c) for c in zip(*parts[first:]))
        if self.files is None:
            self.files, root = fs.FileSystem.from_uri(self.folder)
            self.root = f"{root}/queues-{uuid.uuid4().hex}"
            self.files.create_dir(self.root)
        for i in range(0, len(pos), PIECE):
            path = f"{self.root}/{uuid.uuid4().hex}"
            with self.files.open_output_stream(path) as out:
                out.write(pos[i:i + PIECE].tobytes())
                out.write(lcp[i:i + PIECE].tobytes())
            parts.insert(first, (path, len(pos[i:i + PIECE])))
            first += 1
        del parts[first:]
        self.spilled += len(pos)
        self.held -= self.loose.pop(queue, 0)

    def take(self, queue, last: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        """The oldest entries of a queue, about PIECE of them; with ``last`` the latest, still in order."""
        parts = self.parts.get(queue)
        if not parts:
            self.parts.pop(queue, None)
            return None
        at = -1 if last else 0
        if isinstance(parts[at][0], str):
            path, n = parts.pop(at)
            with self.files.open_input_stream(path) as f:
                data = f.read()
            self.files.delete_file(path)
            return np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int32, n, 8 * n)
        got, n = [], 0
        while parts and not isinstance(parts[at][0], str) and (not got or n + len(parts[at][0]) <= PIECE):
            got.append(parts.pop(at))
            n += len(got[-1][0])
        self.held -= n
        self.loose[queue] -= n
        if last:
            got.reverse()
        return got[0] if len(got) == 1 else tuple(np.concatenate(c) for c in zip(*got))

    def close(self) -> None:
        if self.files is not None:
            self.files.delete_dir(self.root)


class Minima:
    """The least common prefix since any earlier point of a scan.

    Only values less than all later ones matter, and they are at most ``cap`` + 1 different ones.
    """

    def __init__(self):
        self.at, self.value, self.n = np.zeros(0, np.int64), np.zeros(0, np.int32), 0

    def since(self, point: np.ndarray) -> np.ndarray:
        """Least value after each scanned place ``point``; very large if there is none."""
        i = np.searchsorted(self.at, point, "right")
        return np.r_[self.value, np.int32(1 << 30)][i]

    def add(self, values: np.ndarray) -> None:
        least = np.minimum.accumulate(values[::-1])[::-1]
        keep = np.flatnonzero(np.r_[least[:-1] < least[1:], True])
        old = np.searchsorted(self.value, least[0], "left")
        self.at = np.r_[self.at[:old], keep + self.n]
        self.value = np.r_[self.value[:old], least[keep]]
        self.n += len(values)


def _range_minima(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of values[lo .. hi], both included, from a table of minima of all powers of two."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        step = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    level = np.frexp((hi - lo + 1).astype(float))[1] - 1
    out = np.empty(len(lo), values.dtype)
    for k in np.unique(level):
        these = level == k
        out[these] = np.minimum(levels[k][lo[these]], levels[k][hi[these] - (1 << int(k)) + 1])
    return out


class Shard:
    """The text all levels of one shard's recursion refer to."""

    def __init__(self, text: np.ndarray, cap: int, folder: str, in_memory: int = IN_MEMORY, held: int = HELD_ENTRIES):
        """``text``: small whole numbers above 0."""
        self.text = np.r_[text, 0].astype(np.uint16)
        self.cap, self.folder, self.in_memory, self.held = cap, folder, in_memory, held
        self.levels, self.spilled = 0, 0
        self.padded = np.r_[self.text, np.zeros(cap + 1, np.uint16)]

    def common(self, a: int, b: int) -> int:
        """Bytes that the suffixes at two places share, up to the cap."""
        differ = self.padded[a:a + self.cap] != self.padded[b:b + self.cap]
        at = int(differ.argmax())
        return at if differ[at] else self.cap

    def extended(self, a: np.ndarray, b: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Common prefixes of many pairs that are known to share ``known`` bytes."""
        out = np.minimum(known, self.cap).astype(np.int32)
        open_ = np.flatnonzero(out < self.cap)
        while len(open_):
            same = self.padded[a[open_] + out[open_]] == self.padded[b[open_] + out[open_]]
            open_ = open_[same]
            out[open_] += 1
            open_ = open_[out[open_] < self.cap]
        return out

    def suffixes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes from the largest down, in pieces: position, and bytes shared with the one before it."""
        return self.descending(self.text.astype(np.int64), np.arange(len(self.text)))

    def descending(self, sym: np.ndarray, where: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Suffixes of one level's string, whose symbols start at the bytes ``where``; its last symbol is the only 0."""
        self.levels += 1
        n = len(sym)
        ends = np.flatnonzero(np.r_[sym[1:] != sym[:-1], True])
        rises = np.r_[sym[ends[:-1]] < sym[ends[:-1] + 1], True]
        is_s = np.repeat(rises, np.diff(np.r_[-1, ends]))
        star = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
        seeds, seed_lcp = self.sorted_stars(sym, where, star)
        width = np.zeros(int(sym.max()) + 1, np.int64)
        width[sym[:-1]] = np.diff(where)
        symbols = np.unique(sym).tolist()
        starts = np.searchsorted(sym[seeds], symbols, "left").tolist() + [len(seeds)]

        queues = Queues(self.folder, self.held)
        state = {}

        def begin():
            state.update(minima=Minima(), last=np.full(len(width), -1, np.int64), before=None)

        def scan(kind, pos, lcp, want_s):
            """Put what stands before ``pos`` into its queues; ``lcp``: shared with the one scanned before."""
            minima, last = state["minima"], state["last"]
            p = pos - 1
            k = np.flatnonzero((p >= 0) & (is_s[p] == want_s))
            if len(k):
                t = sym[p[k]]
                order = np.argsort(t, kind="stable")
                k, t = k[order], t[order]
                first = np.r_[True, t[1:] != t[:-1]]
                head = np.minimum.accumulate(lcp)
                least = np.empty(len(k), np.int32)
                least[first] = np.minimum(minima.since(last[t[first]]), head[k[first]])
                if not first.all():
                    inner = np.flatnonzero(~first)
                    least[inner] = _range_minima(lcp, k[inner - 1] + 1, k[inner])
                share = np.minimum(least + width[t], self.cap).astype(np.int32)
                bounds = np.flatnonzero(first).tolist() + [len(k)]
                for i, j in zip(bounds, bounds[1:]):
                    queues.put((kind, int(t[i])), p[k[i:j]], share[i:j])
                last[t[first]] = minima.n + k[np.r_[np.flatnonzero(first)[1:] - 1, len(k) - 1]]
            minima.add(lcp)
            state["before"] = int(pos[-1])

        def joined(pos, lcp):
            """``lcp`` with that of the first entry of a queue, which is measured on the text."""
            lcp = lcp.copy()
            lcp[0] = 0 if state["before"] is None else self.common(int(where[state["before"]]), int(where[pos[0]]))
            return lcp

        begin()
        for s, lo, hi in zip(symbols, starts, starts[1:]):
            fresh = True
            while (got := queues.take(("L", s))) is not None:
                pos, lcp = got
                lcp = joined(pos, lcp) if fresh else lcp
                fresh = False
                queues.put(("done", s), pos, lcp)
                scan("L", pos, lcp, False)
            for i in range(lo, hi, PIECE):
                pos, lcp = seeds[i:min(i + PIECE, hi)], seed_lcp[i:min(i + PIECE, hi)]
                scan("L", pos, joined(pos, lcp) if i == lo else lcp, False)

        begin()
        for s in reversed(symbols):
            fresh = True
            while (got := queues.take(("S", s))) is not None:
                pos, lcp = got
                lcp = joined(pos, lcp) if fresh else lcp
                fresh = False
                yield pos, lcp
                scan("S", pos, lcp, True)
            above, fresh = 0, True
            while (got := queues.take(("done", s), last=True)) is not None:
                pos, lcp = got[0][::-1], np.r_[np.int32(above), got[1][:0:-1]].astype(np.int32)
                above = got[1][0]
                lcp = joined(pos, lcp) if fresh else lcp
                fresh = False
                yield pos, lcp
                scan("S", pos, lcp, True)
        self.spilled += queues.spilled
        queues.close()
        # the end of the string is in no queue
        yield np.array([n - 1]), np.zeros(1, np.int32)

    # -- the suffixes that start a rise -------------------------------------

    def sorted_stars(self, sym: np.ndarray, where: np.ndarray, star: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """S* suffixes in order, and what each shares with the one before."""
        names, different = self.named(sym, star)
        at = where[star]
        if different == len(star):
            order = np.argsort(names)
            return star[order], self.neighbours(at[order])
        if len(star) <= self.in_memory:
            order, lcp = self.doubled(names, at)
            return star[order], lcp
        down = list(self.descending(names, at))
        order, lcp = (np.concatenate(c)[::-1] for c in zip(*down))
        return star[order], np.r_[np.int32(0), lcp[:-1]]

    def neighbours(self, at: np.ndarray) -> np.ndarray:
        return np.r_[np.int32(0), self.extended(at[:-1], at[1:], np.zeros(len(at) - 1, np.int64))].astype(np.int32)

    def named(self, sym: np.ndarray, star: np.ndarray) -> tuple[np.ndarray, int]:
        """A number for each S* substring, in their order; equal ones have equal numbers, the last is 0.

        A substring that is the start of another comes after it: the other falls where it rises.
        """
        m = len(star)
        length = np.r_[np.diff(star) + 1, 1]
        bits, pad = int(sym.max() + 1).bit_length(), int(sym.max()) + 1
        per = max(1, (62 - m.bit_length()) // bits)
        rank, active, off = np.zeros(m, np.int64), np.arange(m), 0
        while len(active):
            key = rank[active]
            for j in range(off, off + per):
                inside = j < length[active]
                key = key << bits | np.where(inside, sym[np.where(inside, star[active] + j, 0)], pad)
            order = np.argsort(key, kind="stable")
            key, these = key[order], active[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            group = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(key)]))
            old = rank[these]
            old_start = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
            old_at = np.repeat(old_start, np.diff(np.r_[old_start, len(old)]))
            rank[these] = old + new[group] - old_at
            off += per
            longest = np.maximum.reduceat(length[these], new)
            size = np.diff(np.r_[new, len(key)])
            active = these[((size > 1) & (longest > off))[group]]
        different, names = np.unique(rank, return_inverse=True)
        return names.astype(np.int64), len(different)

    def doubled(self, names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes of a string of names by prefix doubling in memory; names span two bytes at least."""
        m, h, ranks = len(names), 1, [names.astype(np.int32)]
        while h * 2 < self.cap:
            r = ranks[-1].astype(np.int64)
            key = r * (m + 1) + np.r_[r[h:] + 1, np.zeros(min(h, m), np.int64)][:m]
            order = np.argsort(key)
            new = np.cumsum(np.r_[False, key[order[1:]] != key[order[:-1]]]).astype(np.int32)
            r = np.empty(m, np.int32)
            r[order] = new
            ranks.append(r)
            h *= 2
            if new[-1] == m - 1:
                break
        order = np.argsort(ranks[-1], kind="stable")
        a, b = order[:-1], order[1:]
        shared = np.zeros(m - 1, np.int64)
        for r in reversed(ranks):
            fits = np.maximum(a, b) + shared < m
            same = fits.copy()
            same[fits] = r[(a + shared)[fits]] == r[(b + shared)[fits]]
            shared[same] += h
            shared = np.minimum(shared, m - 1 - np.maximum(a, b))
            h //= 2
        known = at[a + shared] - at[a]
        return order, np.r_[np.int32(0), self.extended(at[a], at[b], known)].astype(np.int32)


def repeated(parts: list[bytes], span: int, folder: str, in_memory: int = IN_MEMORY, held: int = HELD_ENTRIES, stats: dict | None = None) -> list[np.ndarray]:
    """For each part, whether the ``span`` bytes from each place in it on occur at another place too."""
    sizes = np.array([len(p) for p in parts])
    # 1 ends a part; no span that fits into a part holds one
    joined = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(sizes)
    shard = Shard(np.insert(joined, ends, 1), span, folder, in_memory, held)
    found = np.zeros(len(shard.text), bool)
    before = 0
    for pos, lcp in shard.suffixes():
        hit = lcp >= span
        found[pos[hit]] = True
        found[np.r_[before, pos[:-1]][hit]] = True
        before = pos[-1]
    if stats is not None:
        stats.update(levels=shard.levels, spilled=shard.spilled)
    out, start = [], 0
    for n in sizes.tolist():
        out.append(found[start:start + max(0, n - span + 1)])
        start += n + 1
    return out
