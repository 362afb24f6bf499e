"""External induced sorting of one shard's suffixes, with their common prefixes.

The suffixes at local minima (S*) are named and sorted in the reduced problem; all others follow
from them in two scans, first those followed by something smaller (L), then those followed by
something larger (S). A scan takes suffixes in order out of queues, one for each first symbol, and
puts the suffix one symbol longer into the queue of its own first symbol. The tuples in the queues
are position and common prefix with the entry before: the new one is one more than the least
common prefix scanned since the last entry of the same queue. Queues hold blocks, and blocks move
to disk when the queues hold more than their budget. All steps work on whole blocks of tuples.

Common prefixes count up to `depth`; suffixes that agree so far may stand in any order. So a run
of one symbol that is longer than `depth` goes into its queue in one piece from there on.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BUDGET = 256 << 20
BLOCK = 1 << 20
Tuples = tuple[np.ndarray, np.ndarray]


class Queues:
    """First-in first-out queues of tuple blocks by symbol, on disk beyond `budget` bytes."""

    def __init__(self, budget: int):
        self.budget, self.held, self.file = budget, 0, None
        self.blocks: dict[int, list] = {}

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        for at in range(0, len(pos), BLOCK):
            self.blocks.setdefault(symbol, []).append((pos[at : at + BLOCK], lcp[at : at + BLOCK]))
        self.held += pos.nbytes + lcp.nbytes
        if self.held > self.budget:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for blocks in self.blocks.values():
            for i, block in enumerate(blocks):
                if isinstance(block[0], np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(block[0].tobytes() + block[1].tobytes())
                    blocks[i] = (at, len(block[0]), block[0].dtype)
        self.held = 0

    def load(self, block) -> Tuples:
        if isinstance(block[0], np.ndarray):
            self.held -= block[0].nbytes + block[1].nbytes
            return block
        at, n, kind = block
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * kind.itemsize), kind), np.frombuffer(self.file.read(n), np.uint8)

    def take(self, symbol: int, backwards: bool = False) -> Iterator[Tuples]:
        """The tuples of a queue, about a block at a time, also those that come while it is read."""
        while left := self.blocks.get(symbol):
            n = size = 0
            for block in reversed(left) if backwards else left:
                n, size = n + 1, size + (len(block[0]) if isinstance(block[0], np.ndarray) else block[1])
                if size >= BLOCK:
                    break
            cut = len(left) - n if backwards else n
            now, self.blocks[symbol] = (left[cut:], left[:cut]) if backwards else (left[:cut], left[cut:])
            loaded = [self.load(block) for block in now]
            yield loaded[0] if n == 1 else tuple(map(np.concatenate, zip(*loaded, strict=True)))

    def close(self) -> None:
        if self.file:
            self.file.close()


class Scan:
    """Common prefixes of what one scan induces, over all its blocks."""

    def __init__(self, symbols: int, depth: int):
        self.depth = depth
        self.since = np.zeros(symbols, np.uint8)  # least common prefix since a queue's last entry

    def induce(self, lcp: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For the entries `at` of a block, which go to the queue `symbol`: queue, entries, lcp."""
        if not len(at):
            self.since = np.minimum(self.since, lcp.min())
            return
        order = np.argsort(symbol, kind="stable")
        at, symbol = at[order], symbol[order]
        upto = np.minimum.accumulate(lcp)
        first = np.ones(len(at), bool)
        first[1:] = symbol[1:] != symbol[:-1]
        least = np.minimum(self.since[symbol], upto[at])
        later = np.flatnonzero(~first)
        if len(later):
            least[later] = _range_min(lcp, at[later - 1] + 1, at[later])
        value = np.minimum(least.astype(np.int16) + 1, self.depth).astype(np.uint8)
        self.since = np.minimum(self.since, upto[-1])
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(at))
        after = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.uint8(self.depth))
        self.since[symbol[starts]] = after[at[ends - 1] + 1]
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            yield int(symbol[s]), at[s:e], value[s:e]


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minima of values[lo..hi], both ends included."""
    level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    result, table, width = np.empty(len(lo), values.dtype), values, 1
    for k in range(int(level.max()) + 1):
        own = level == k
        if own.any():
            result[own] = np.minimum(table[lo[own]], table[hi[own] - width + 1])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return result


class Text:
    """The symbols of a shard: 0 ends it, 1 parts its segments, bytes are 2 and more."""

    def __init__(self, segments: list[bytes]):
        raw = np.frombuffer(b"\0".join(segments) + b"\0\0", np.uint8)
        ends = np.cumsum([len(s) + 1 for s in segments]) - 1
        self.starts = np.concatenate([[0], ends[:-1] + 1])
        used = np.zeros(256, bool)
        used[raw] = True
        codes = np.zeros(256, np.uint16)
        codes[used] = np.arange(used.sum()) + 2
        self.symbols = int(used.sum()) + 3  # one more that is above all
        kind = np.uint8 if self.symbols <= 255 else np.dtype(">u2")
        body = codes.astype(kind)[raw]
        body[ends], body[-1] = 1, 0
        self.per = 8 // body.itemsize
        self.size = len(body)
        padded = np.zeros(self.size + 2 * self.per, body.dtype)
        padded[: self.size] = body
        self.body = padded[: self.size]
        # The symbols from each position on, eight bytes at a time.
        self.words = np.ndarray(self.size + self.per, ">u8", padded.data, strides=(body.itemsize,))
        self.bits = 8 * body.itemsize

    def word(self, pos: np.ndarray) -> np.ndarray:
        return self.words[np.minimum(pos, self.size)].astype(np.uint64)

    def common(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Common prefixes of the suffixes a and b, up to `depth`."""
        found = np.full(len(a), depth, np.uint8)
        left = np.arange(len(a))
        for at in range(0, depth, self.per):
            other = self.word(a[left] + at) ^ self.word(b[left] + at)
            differ = other != 0
            high = 63 - (np.frexp(other[differ].astype(np.float64))[1] - 1)
            # The conversion may round up to the next power of two.
            high += (other[differ] >> (63 - high).astype(np.uint64)) == 0
            found[left[differ]] = np.minimum(at + high // self.bits, depth)
            left = left[~differ]
            if not len(left):
                break
        return found


def _refine(rank: np.ndarray, key: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Splits equal ranks by key, for the entries `among`; returns those that are still tied.

    A rank is the number of entries that are smaller.
    """
    order = np.lexsort((key, rank[among]))
    among, key = among[order], key[order]
    old = rank[among]
    group = np.ones(len(among), bool)
    group[1:] = old[1:] != old[:-1]
    part = group.copy()
    part[1:] |= key[1:] != key[:-1]
    index = np.arange(len(among))
    group_at = np.maximum.accumulate(np.where(group, index, 0))
    part_at = np.maximum.accumulate(np.where(part, index, 0))
    rank[among] = old + part_at - group_at
    tied = ~part
    tied[:-1] |= ~part[1:]
    return among[tied]


def sort_minima(text: Text, minima: np.ndarray, depth: int) -> np.ndarray:
    """The reduced problem: the S* suffixes in order, by doubling over the names of what lies
    between one minimum and the next."""
    rank = np.zeros(len(minima), np.int64)
    length = np.append(np.diff(minima) + 1, 1)
    per, bits = text.per, text.bits
    tied, at = np.arange(len(minima)), 0
    while len(tied := tied[length[tied] >= at]) and at <= depth:
        key = text.word(minima[tied] + at)
        missing = np.clip(at + per - length[tied], 0, per).astype(np.uint64) * np.uint64(bits)
        # What has ended is larger than what goes on.
        ended = np.where(missing >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(missing, np.uint64(63))) - np.uint64(1))
        tied = _refine(rank, key | ended, tied)
        at += per
    _, counts = np.unique(rank, return_counts=True)
    step, tied = 1, np.flatnonzero(np.repeat(counts > 1, counts)[np.argsort(np.argsort(rank, kind="stable"), kind="stable")])
    while len(tied) and step <= depth:
        following = tied + step
        key = np.where(following < len(rank), rank[np.minimum(following, len(rank) - 1)] + 1, 0)
        tied = _refine(rank, key, tied)
        step *= 2
    return minima[np.argsort(rank, kind="stable")]


def _long_runs(body: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of over `depth` equal symbols: the place from which `depth` + 1 of them are left, the
    run's start, and a mark on all places from the start to there."""
    cuts = np.concatenate([[0], np.flatnonzero(body[1:] != body[:-1]) + 1, [len(body)]])
    long = np.flatnonzero(np.diff(cuts) > depth)
    starts, edges = cuts[long], cuts[long + 1] - depth - 1
    inside = np.zeros(len(body) if len(long) else 0, bool)
    for a, b in zip(starts.tolist(), edges.tolist(), strict=True):
        inside[a : b + 1] = True
    return edges, starts, inside


def sorted_suffixes(text: Text, depth: int, budget: int = BUDGET) -> Iterator[Tuples]:
    """All suffixes from the last to the first: blocks of (position, common prefix with the
    suffix that came before, up to `depth`)."""
    body, n = text.body, text.size
    kind = np.int32 if n < 1 << 31 else np.int64
    step = np.sign(np.diff(body.astype(np.int16)))
    turn = np.where(step != 0, np.arange(n - 1), n)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    rising = np.append(step[np.minimum(turn, n - 2)] > 0, True)
    del step, turn
    minima = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    del rising
    minima = sort_minima(text, minima, depth).astype(kind)
    minima_lcp = np.concatenate([np.zeros(1, np.uint8), text.common(minima[:-1], minima[1:], depth)])
    cuts = np.searchsorted(body[minima], np.arange(text.symbols + 1))
    falling, done, growing = Queues(budget), Queues(budget), Queues(budget)

    edges, edge_starts, inside = _long_runs(body, depth)

    def scan(state: Scan, queues: Queues, pos: np.ndarray, lcp: np.ndarray, wanted, own: int | None = None) -> None:
        before = pos - 1
        symbol = body[before]
        chosen = wanted(symbol) & (pos > 0)
        if len(edges):
            chosen &= ~(inside[pos] & (symbol == own))
        at = np.flatnonzero(chosen)
        for to, entries, values in state.induce(lcp, at, symbol[at]):
            queues.push(to, before[entries], values)
            if to == own and len(edges):
                last = before[entries][np.isin(before[entries], edges)]
                starts = edge_starts[np.searchsorted(edges, last)]
                rest = [np.arange(a, b, dtype=kind) for a, b in zip(starts.tolist(), last.tolist(), strict=True)]
                for part in rest:
                    queues.push(own, part, np.full(len(part), depth, np.uint8))

    try:
        state = Scan(text.symbols, depth)
        for c in range(text.symbols):
            last = None
            for pos, lcp in falling.take(c):
                if last is None:
                    lcp = np.concatenate([np.zeros(1, np.uint8), lcp[1:]])
                last = pos[-1:]
                done.push(c, pos, lcp)
                scan(state, falling, pos, lcp, lambda s, c=c: s >= c, c)
            lo, hi = cuts[c], cuts[c + 1]
            if hi > lo:
                lcp = minima_lcp[lo:hi].copy()
                lcp[0] = 0 if last is None else text.common(last, minima[lo : lo + 1], depth)[0]
                for a in range(lo, hi, BLOCK):
                    b = min(hi, a + BLOCK)
                    scan(state, falling, minima[a:b], lcp[a - lo : b - lo], lambda s, c=c: s > c)
        state = Scan(text.symbols, depth)
        for c in reversed(range(text.symbols)):
            last = None
            for pos, lcp in growing.take(c):
                if last is None:
                    lcp = np.concatenate([np.zeros(1, np.uint8), lcp[1:]])
                last = pos[-1:]
                yield pos, lcp
                scan(state, growing, pos, lcp, lambda s, c=c: s <= c, c)
            onward = None  # common prefix of the block's last entry with the next block's first
            for pos, lcp in done.take(c, backwards=True):
                pos = pos[::-1]
                if onward is None:
                    onward = 0 if last is None else text.common(last, pos[:1], depth)[0]
                lcp, onward = np.concatenate([np.array([onward], np.uint8), lcp[:0:-1]]), lcp[0]
                last = pos[-1:]
                yield pos, lcp
                scan(state, growing, pos, lcp, lambda s, c=c: s < c)
    finally:
        for queues in (falling, done, growing):
            queues.close()


def repeats(segments: list[bytes], counts: np.ndarray, depth: int, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """The strings of `depth` bytes that start earlier too: (segment, offset) of each.

    Only the first `counts` offsets of each segment are judged and compared; each has `depth`
    bytes in its segment. An earlier segment, or offset, is an earlier start.
    """
    text = Text(segments)
    judged = np.zeros(text.size + 1, np.int8)
    np.add.at(judged, text.starts, 1)
    np.add.at(judged, text.starts + counts, -1)
    judged = np.cumsum(judged, dtype=np.int8).astype(bool)
    found: list[np.ndarray] = []
    least = None  # of the group that the last block ended in
    for pos, lcp in sorted_suffixes(text, depth, budget):
        keep = judged[pos]
        group = np.cumsum(lcp < depth)
        pos, group = pos[keep], group[keep]
        if lcp[0] < depth:
            least = None
        if not len(pos):
            least = None if group.size == 0 and (lcp < depth).any() else least
            continue
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        starts = np.flatnonzero(first)
        lows = np.minimum.reduceat(pos, starts)
        opened = int(lcp[0] < depth)
        if group[0] == opened and least is not None:
            if lows[0] < least:
                found.append(np.array([least]))
            lows[0] = min(lows[0], least)
        found.append(pos[pos != np.repeat(lows, np.diff(np.append(starts, len(pos))))])
        total = int((lcp < depth).sum())
        least = int(lows[-1]) if group[-1] == total else None
    at = np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
    segment = np.searchsorted(text.starts, at, "right") - 1
    return segment, at - text.starts[segment]
