"""External induced sorting: the suffixes of a text and their common prefixes.

Suffixes are pairs (place, common prefix with the suffix before). They wait in
queues, one for each first character; together these are a priority queue whose
head is the least unread suffix. The sorted leftmost-S suffixes are seeded, and
from the head each suffix induces the place before it: in ascending order for
suffixes greater than the one behind them (type L), then in descending order
for the others (type S). Which of both the place before is, its own character
tells. The common prefix of two induced suffixes is one more than the least
value between their origins.

The seeds are sorted by induction as well: a first round orders the stretches
from one seed to the next, equal ones get equal names, and the string of names
is sorted by doubling, each step an external merge sort, until names tell all
seeds apart or cover `depth` characters.

Queues, seeds, names and marks are held in memory up to a budget and beyond it
in files of the task; a text may be mapped from a file, too. All else works on
chunks of bounded size, so that a text may be far larger than memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

#: Entries that are worked on at once, and bytes that one sort holds in memory besides.
CHUNK, BUDGET = 1 << 20, 192 << 20
#: Zero bytes behind a text, so that a word of eight bytes can be read at each place.
PAD = 8


class Spool:
    """What one sort holds: in memory up to a budget, then in temporary files."""

    def __init__(self, budget: int = BUDGET):
        self.left, self.file = budget, None

    def array(self, n: int, kind) -> np.ndarray:
        """An array of n zeros, in memory or mapped from a file that has no name."""
        size = n * np.dtype(kind).itemsize
        if size <= self.left or not n:
            self.left -= size
            return np.zeros(n, kind)
        with tempfile.TemporaryFile() as f:
            f.truncate(size)
            return np.memmap(f, kind, "r+", shape=(n,))

    def put(self, a: np.ndarray):
        if a.nbytes <= self.left:
            self.left -= a.nbytes
            return a
        self.file = self.file or tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(memoryview(np.ascontiguousarray(a)).cast("B"))
        return at, a.dtype, len(a)

    def get(self, x) -> np.ndarray:
        if isinstance(x, np.ndarray):
            return x
        at, kind, n = x
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * kind.itemsize), kind)


class Queue:
    """First in, first out; can be read again from the end."""

    def __init__(self, spool: Spool):
        self.spool, self.parts, self.next = spool, [], 0

    def put(self, place: np.ndarray, lcp: np.ndarray) -> None:
        if len(place):
            self.parts.append((self.spool.put(place), self.spool.put(lcp)))

    def read(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is unread, also what comes in meanwhile, in chunks as large as may be."""
        while self.next < len(self.parts):
            yield from self._joined(self.parts[self.next :], count=True)

    def forwards(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from self._joined(self.parts)

    def backwards(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from self._joined(self.parts[::-1], turn=-1)

    def _joined(self, parts: list, turn: int = 1, count: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for a, b in parts:
            self.next += count
            held.append((self.spool.get(a)[::turn], self.spool.get(b)[::turn]))
            n += len(held[-1][0])
            if n >= CHUNK:
                yield from self._sliced(held)
                held, n = [], 0
        if held:
            yield from self._sliced(held)

    @staticmethod
    def _sliced(held: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        place, lcp = held[0] if len(held) == 1 else tuple(np.concatenate(x) for x in zip(*held))
        for i in range(0, len(place), CHUNK):
            yield place[i : i + CHUNK], lcp[i : i + CHUNK]


class Text:
    """Characters with PAD zeros behind them, in memory or mapped."""

    def __init__(self, padded: np.ndarray):
        self.n = len(padded) - PAD
        self.chars = padded[: self.n]
        self.place = np.int32 if self.n < 1 << 31 else np.int64
        self._words = np.ndarray((self.n + 1,), "<u8", padded, strides=(1,))

    def common(self, a: np.ndarray, b: np.ndarray, limit) -> np.ndarray:
        """The common prefixes of the suffixes at a and b, up to `limit`, by comparison of words of eight bytes."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.minimum(limit, self.n - np.maximum(a, b))
        out, live, done = limit.copy(), np.arange(len(a)), 0
        while len(live):
            apart = self._words[np.minimum(a[live] + done, self.n)] ^ self._words[np.minimum(b[live] + done, self.n)]
            last = apart != 0
            if last.any():
                x = apart[last]
                same = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
                out[live[last]] = np.minimum(done + same, limit[live[last]])
                live = live[~last]
            done += 8
            live = live[limit[live] > done]
        return out


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64."""
    out = np.ones(n, np.uint64)
    m = 1
    while m < n:
        out[m : 2 * m] = out[: min(m, n - m)] * np.uint64(pow(base, m, 1 << 64))
        m *= 2
    return out


def _seeds(text: Text, spool: Spool) -> np.ndarray:
    """The leftmost-S places in ascending order: less than the suffix behind them, after one that is greater. Read from the end in chunks."""
    parts, total, end, is_s = [], 0, text.n - 1, False  # the type of the character at `end`
    while end > 0:
        start = max(0, end - CHUNK)
        t = text.chars[start : end + 1].astype(np.int16)
        step = np.append(np.sign(np.diff(t)), 1 if is_s else -1)
        at = np.where(step != 0, np.arange(len(step)), len(step))
        types = step[np.minimum.accumulate(at[::-1])[::-1]] > 0
        found = (start + 1 + np.flatnonzero(types[1:] & ~types[:-1])).astype(text.place)
        parts.append(spool.put(found))
        total += len(found)
        end, is_s = start, bool(types[0])
    out, n = spool.array(total, text.place), 0
    for part in reversed(parts):
        part = spool.get(part)
        out[n : n + len(part)] = part
        n += len(part)
    return out


def _by_character(text: Text, places: np.ndarray, spool: Spool) -> np.ndarray:
    """`places` in the order of their characters, by counts."""
    start = np.concatenate([[0], np.cumsum(_counts(text, places))])
    out = spool.array(len(places), text.place)
    for i in range(0, len(places), CHUNK):
        part = places[i : i + CHUNK]
        c = text.chars[part]
        order = np.argsort(c, kind="stable")
        n = np.bincount(c, minlength=256)
        to = np.arange(len(part)) + np.repeat(start[:-1] - np.cumsum(n) + n, n)
        out[to] = part[order]
        start[:-1] += n
    return out


def _counts(text: Text, places: np.ndarray) -> np.ndarray:
    """How many places have each character."""
    out = np.zeros(256, np.int64)
    for i in range(0, len(places), CHUNK):
        out += np.bincount(text.chars[places[i : i + CHUNK]], minlength=256)
    return out


def ordered(keys: np.ndarray, spool: Spool) -> np.ndarray:
    """The places of `keys` in stable ascending order: sorted runs, merged range by range of keys."""
    n = len(keys)
    if n <= CHUNK:
        return np.argsort(keys, kind="stable")
    key, at, out = spool.array(n, keys.dtype), spool.array(n, np.int64), spool.array(n, np.int64)
    runs = [(i, min(n, i + CHUNK)) for i in range(0, n, CHUNK)]
    samples = []
    for i, j in runs:
        order = np.argsort(keys[i:j], kind="stable")
        key[i:j], at[i:j] = keys[i:j][order], order + i
        samples.append(key[i : j : max(1, CHUNK // 256)])
    sample = np.sort(np.concatenate(samples))
    cuts = np.unique(sample[128::128])
    begin, done = [i for i, _ in runs], 0
    for cut in [*cuts.tolist(), None]:
        for equal in (False, True):
            if cut is None and equal:
                break
            end = [j if cut is None else b + int(np.searchsorted(key[b:j], cut, "right" if equal else "left")) for b, (_, j) in zip(begin, runs)]
            if equal:  # no order left to find
                for b, e in zip(begin, end):
                    out[done : done + e - b] = at[b:e]
                    done += e - b
            else:
                places = np.concatenate([at[b:e] for b, e in zip(begin, end)])
                order = np.argsort(np.concatenate([key[b:e] for b, e in zip(begin, end)]), kind="stable")
                out[done : done + len(places)] = places[order]
                done += len(places)
            begin = end
    return out


def _ordered_seeds(text: Text, seeds: np.ndarray, in_order: np.ndarray, depth: int, spool: Spool) -> np.ndarray:
    """The seeds (ascending places) in the order of their suffixes, given the
    places in the order of the stretches up to the next seed."""
    n = len(seeds)
    if n < 2:
        return seeds
    name, last, names = spool.array(n, np.int64), None, -1
    for i in range(0, n, CHUNK):
        place = in_order[i : i + CHUNK]
        which = np.searchsorted(seeds, place)
        size = np.where(which + 1 < n, seeds[np.minimum(which + 1, n - 1)].astype(np.int64) + 1, text.n) - place
        if last is None:
            before, before_size = np.append(place[:1], place[:-1]), np.append(np.int64(-1), size[:-1])
        else:
            before, before_size = np.append(last[0], place[:-1]), np.append(last[1], size[:-1])
        same = size == before_size
        same[same] = text.common(before[same], place[same], size[same]) == size[same]
        name[which] = names + np.cumsum(~same)
        names += int((~same).sum())
        last = place[-1], size[-1]
    covered, names = 1, names + 1
    while names < n and 2 * covered <= depth:  # a stretch advances by two characters at least
        key = spool.array(n, np.int64)
        for i in range(0, n, CHUNK):
            behind = name[i + covered : i + covered + CHUNK] + 1
            part = name[i : i + CHUNK] * (n + 1)
            part[: len(behind)] += behind[: len(part)]
            key[i : i + CHUNK] = part
        order, value, names = ordered(key, spool), None, -1
        for i in range(0, n, CHUNK):
            part = order[i : i + CHUNK]
            k = key[part]
            new = np.append(value is None or k[0] != value, k[1:] != k[:-1])
            name[part] = names + np.cumsum(new)
            names, value = names + int(new.sum()), k[-1]
        covered, names = covered * 2, names + 1
    out, order = spool.array(n, text.place), ordered(name, spool)
    for i in range(0, n, CHUNK):
        out[i : i + CHUNK] = seeds[order[i : i + CHUNK]]
    return out


def _least(lcp: np.ndarray, at: np.ndarray, target: np.ndarray, since: np.ndarray) -> np.ndarray:
    """For entries `at` of a chunk, in the order of their queues (`target`): the
    least common prefix since the entry before that went to the same queue.
    `since` holds that value for each queue over earlier chunks and is updated."""
    low = np.minimum.accumulate(lcp)
    first = np.r_[True, target[1:] != target[:-1]]
    last = np.r_[first[1:], True]
    out = np.empty(len(at), lcp.dtype)
    out[first] = np.minimum(since[target[first]], low[at[first]])
    later = np.flatnonzero(~first)
    padded = np.append(lcp, np.iinfo(lcp.dtype).max).astype(lcp.dtype)
    if len(later):
        pairs = np.column_stack([at[later - 1] + 1, at[later] + 1]).ravel()
        out[later] = np.minimum.reduceat(padded, pairs)[::2]
    np.minimum(since, low[-1], out=since)
    tail = np.minimum.accumulate(padded[::-1])[::-1]
    since[target[last]] = tail[at[last] + 1]
    return out


def _shifted(parts: Iterator[tuple[np.ndarray, np.ndarray]], first: Callable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Entries in reverse order with the common prefix to what now stands before
    them; `first(place)` gives the one of the first entry."""
    held = None
    for place, lcp in parts:
        yield place, np.append(first(place[0]) if held is None else held, lcp[:-1]).astype(lcp.dtype)
        held = lcp[-1]


class Sorted:
    """One induction from seeds in their order; without `seed_lcp` no common prefixes are kept. Those that are stop at `depth`."""

    def __init__(self, text: Text, seeds: np.ndarray, seed_lcp: np.ndarray | None, depth: int, spool: Spool):
        self.text, self.depth, self.keep = text, depth, seed_lcp is not None
        self.kind = np.uint8 if depth < 255 else np.uint16
        n = np.zeros(256, np.int64)
        for i in range(0, text.n, CHUNK):
            n += np.bincount(text.chars[i : i + CHUNK], minlength=256)
        self.chars = np.flatnonzero(n).tolist()
        self.low, self.high = [Queue(spool) for _ in range(256)], [Queue(spool) for _ in range(256)]
        start = np.concatenate([[0], np.cumsum(_counts(text, seeds))])
        since = np.zeros(256, self.kind)
        self.low[text.chars[-1]].put(np.array([text.n - 1], text.place), np.zeros(1, self.kind))
        for c in self.chars:
            last = None
            for place, lcp in self.low[c].read():
                if last is None:
                    lcp = np.append(0, lcp[1:]).astype(self.kind)
                self._induce(place, lcp, lambda b, c=c: b >= c, self.low, since)
                last = place[-1]
            for i in range(start[c], start[c + 1], CHUNK):
                place = np.array(seeds[i : min(i + CHUNK, start[c + 1])])
                lcp = np.array(seed_lcp[i : i + len(place)]) if self.keep else np.zeros(len(place), self.kind)
                if i == start[c]:
                    lcp[0] = self._border(last, place[0])
                self._induce(place, lcp, lambda b, c=c: b >= c, self.low, since)
        since = np.zeros(256, self.kind)
        for c in reversed(self.chars):
            last = None
            for place, lcp in self.high[c].read():
                if last is None:
                    lcp = np.append(0, lcp[1:]).astype(self.kind)
                self._induce(place, lcp, lambda b, c=c: b <= c, self.high, since)
                last = place[-1]
            for place, lcp in _shifted(self.low[c].backwards(), lambda p, last=last: self._border(last, p)):
                self._induce(place, lcp, lambda b, c=c: b < c, self.high, since)

    def _induce(self, place: np.ndarray, lcp: np.ndarray, wanted: Callable, queues: list[Queue], since: np.ndarray) -> None:
        """Queue the places before those of a chunk whose characters are `wanted`."""
        before = place - 1
        c = self.text.chars[np.maximum(before, 0)]
        ok = np.flatnonzero((before >= 0) & wanted(c))
        if not len(ok):
            np.minimum(since, lcp.min(), out=since)
            return
        order = np.argsort(c[ok], kind="stable")
        at = ok[order]
        target = c[at]
        if self.keep:
            values = np.minimum(_least(lcp, at, target, since), self.kind(self.depth - 1)) + self.kind(1)
        else:
            values = np.zeros(len(at), self.kind)
        cuts = np.flatnonzero(np.r_[True, target[1:] != target[:-1], True]).tolist()
        for a, b in zip(cuts, cuts[1:]):
            queues[target[a]].put(before[at[a:b]], values[a:b])

    def _border(self, a, b) -> int:
        """Common prefix of the suffixes where a character's two types meet."""
        return 0 if a is None else int(self.text.common(np.array([a]), np.array([b]), self.depth)[0])

    def seeds(self) -> Iterator[np.ndarray]:
        """The leftmost-S places in ascending order: those of type S behind a greater character."""
        for c in self.chars:
            for place, _ in self.high[c].backwards():
                yield place[(place > 0) & (self.text.chars[np.maximum(place - 1, 0)] > c)]

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and common prefixes in ascending order of the suffixes."""
        for c in self.chars:
            last = None
            for place, lcp in self.low[c].forwards():
                if last is None:
                    lcp = np.append(0, lcp[1:]).astype(self.kind)
                yield place, lcp
                last = place[-1]
            yield from _shifted(self.high[c].backwards(), lambda p, last=last: self._border(last, p))


def sorted_suffixes(text: Text, depth: int = 100, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (place, common prefix with the suffix before) in ascending order.

    Suffixes that agree in `depth` characters come in any order among
    themselves; common prefixes are exact up to `depth` and stop there.
    """
    if not 1 < depth < 1 << 16:
        raise ValueError(f"depth {depth}")
    if not text.n:
        return iter(())
    spool = Spool(budget)
    seeds = _seeds(text, spool)
    first, in_order, n = Sorted(text, _by_character(text, seeds, spool), None, depth, Spool(budget)), spool.array(len(seeds), text.place), 0
    for part in first.seeds():
        in_order[n : n + len(part)] = part
        n += len(part)
    del first
    found = _ordered_seeds(text, seeds, in_order, depth, spool)
    kind = np.uint8 if depth < 255 else np.uint16
    lcp = spool.array(len(found), kind)
    for i in range(1, len(found), CHUNK):
        j = min(i + CHUNK, len(found))
        lcp[i:j] = text.common(found[i - 1 : j - 1], found[i:j], depth)
    return iter(Sorted(text, found, lcp, depth, Spool(budget)))


def text_of(t: np.ndarray) -> Text:
    """A text of the characters `t` (uint8)."""
    return Text(np.append(t, np.zeros(PAD, np.uint8)))
