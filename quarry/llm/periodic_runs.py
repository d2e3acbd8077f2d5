"""Periodic runs of words: stretches that repeat with a smallest period and that no neighbour extends.

Many texts at a time become one sequence of word numbers, with a separator of its own
after each. Doubling sorts its suffixes; on the way it names the blocks of 4, 8, 16... words. The
blocks that start at every half of their length ask for their occurrences
shortly behind: the suffixes that begin with a block are neighbours in the
suffix array, and a wavelet tree over it gives the next greater place among
them (range successor). Occurrences that overlap by half and more stand in an
arithmetic progression, the period of which is the only candidate that they
give; all other distances are candidates each. Words that agree before and
behind a candidate are counted by the names of blocks, so that every
run comes out whole.

Every run is found: if its period is between 1.5 w - 1 and 3 w - 2, it holds a
block of w words at a multiple of w / 2 that occurs again a period later.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs have so many words and two periods at least.
LEAST = 12
#: Words that are searched together; a longer text is searched alone. Numbers, names and tree take about 200 bytes a word.
TOGETHER = 1 << 18
#: Candidates that are followed up at once.
AT_ONCE = 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class WaveletTree:
    """Counts and order of the values within ranges of a sequence; all queries are arrays."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels: list[tuple[int, np.ndarray]] = []
        for bit in reversed(range(max(1, int(values.max(initial=0)).bit_length()))):
            ones = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((bit, zeros))
            values = np.concatenate([values[~ones], values[ones]])

    def less(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values from `low` up to `high` are less than x."""
        n = np.zeros(len(x), np.int64)
        beyond = x >= 1 << len(self.levels)
        whole = high - low
        for bit, zeros in self.levels:
            a, b = zeros[low], zeros[high]
            one = (x >> bit & 1).astype(bool)
            n += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return np.where(beyond, whole, n)

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value of number n, from 0, in ascending order of those from `low` up to `high`."""
        value = np.zeros(len(n), np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[low], zeros[high]
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            value += one.astype(np.int64) << bit
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return value


class Blocks:
    """Names of the blocks of 1, 2, 4... symbols at every place, and the places in the order of what follows them.

    The first and the last symbol occur once. `width` is the greatest length that
    has names: more than `most`, or such that no block of twice that length occurs twice.
    """

    def __init__(self, symbols: np.ndarray, most: int) -> None:
        n = len(symbols)
        self.order = np.argsort(symbols, kind="stable")
        slots, key = np.arange(n), symbols[self.order]
        name = np.empty(n, np.int32)
        self.names, self.width = [name], 1
        #: Places, first slots and numbers of slots of the blocks that occur again, by length.
        self.repeated: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        at = self.order
        while True:
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(begins, len(key)))
            first, size = np.repeat(slots[begins], sizes), np.repeat(sizes, sizes)
            name[at] = first
            again = size > 1
            slots, at, first, size = slots[again], at[again], first[again], size[again]
            self.repeated[self.width] = (at, first, size)
            if not len(at) or self.width > most:
                return
            # A block that occurs again ends before the last symbol, so what follows it has a name.
            key = first.astype(np.int64) * n + name[at + self.width]
            by = np.argsort(key)
            at, key = at[by], key[by]
            self.order[slots] = at
            name = name.copy()
            self.names.append(name)
            self.width *= 2

    def _same(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        total = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.names))):
            name, width = self.names[k], 1 << k
            left = np.arange(len(i))
            while len(left):
                x, y = (i[left] + total[left], j[left] + total[left]) if forward else (i[left] - total[left] - width, j[left] - total[left] - width)
                left = left[(x >= 0) & (name[np.maximum(x, 0)] == name[np.maximum(y, 0)])]
                total[left] += width
                if k < len(self.names) - 1:  # only the longest blocks may follow each other
                    break
        return total

    def same_from(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j > i on agree."""
        return self._same(i, j, True)

    def same_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j > i agree."""
        return self._same(i, j, False)


def _distances(blocks: Blocks, tree: WaveletTree, width: int, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of blocks of `width` and distances to their later occurrences that may be periods."""
    before, upto = tree.less(low, high, at + 1), tree.less(low, high, at + 3 * width - 1)
    some = upto > before
    at, low, high, before, upto = (x[some] for x in (at, low, high, before, upto))
    step = tree.nth(low, high, before) - at
    yield at, step
    # As far as the progression of a block goes, all else in it is a multiple of its step.
    chained = np.flatnonzero(2 * step <= width)
    rest = before + 1
    end = at[chained] + step[chained] + blocks.same_from(at[chained], at[chained] + step[chained])
    rest[chained] = tree.less(low[chained], high[chained], end - width + 1)
    more = np.maximum(upto - rest, 0)
    ends = np.cumsum(more)
    done = 0
    while done < len(more):
        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + AT_ONCE, "right")))
        n = more[done:stop]
        which = np.repeat(np.arange(done, stop), n)
        number = rest[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        yield at[which], tree.nth(low[which], high[which], number) - at[which]
        done = stop


def find_runs(symbols: np.ndarray, longest: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start, then period.

    The first and the last symbol occur once; no run is longer than `longest`.
    """
    least = max(least, 12)  # shorter runs may hold no block of four that asks for them
    blocks = Blocks(symbols, (longest // 2 + 1) // 3)
    slots = _covered(blocks.repeated[4], len(symbols)) if 4 in blocks.repeated else np.zeros(0, np.int64)
    found: list[np.ndarray] = []
    if len(slots):
        tree = WaveletTree(blocks.order[slots])
        for width, (at, first, size) in blocks.repeated.items():
            asks = at % (width // 2) == 0 if width >= 4 else np.zeros(len(at), bool)
            if not asks.any():
                continue
            at, low = at[asks], np.searchsorted(slots, first[asks])
            for place, period in _distances(blocks, tree, width, at, low, low + size[asks]):
                fit = (period >= 1.5 * width - 1) | (width == 4)
                place, period = place[fit], period[fit]
                before = blocks.same_before(place, place + period)
                length = before + blocks.same_from(place, place + period) + period
                fit = length >= np.maximum(least, 2 * period)
                found.append(np.stack([place - before, length, period])[:, fit])
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    # A stretch may have been found by multiples of its period, too.
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    new = np.ones(len(by), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _covered(repeated: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Those of n slots that belong to blocks that occur again."""
    _, first, size = repeated
    change = np.zeros(n + 1, np.int64)
    first, size = np.unique(np.stack([first, size]), axis=1)
    change[first] += 1
    change[first + size] -= 1
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def _collapsed(texts: list[bytes], least: int) -> tuple[list[int], pa.Array, list[bytes]]:
    """Numbers of words, runs and what is left, of each text."""
    words = [t.split() for t in texts]  # bytes are split at ASCII white space, and at nothing else
    sizes = np.array([len(w) for w in words], np.int64)
    numbers = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode()
    n_words = len(numbers.dictionary)
    begins = np.cumsum(sizes + 1) - sizes  # a separator stands before each text and at the end
    symbols = np.empty(int(sizes.sum()) + len(texts) + 1, np.int64)
    is_word = np.ones(len(symbols), bool)
    is_word[np.append(begins - 1, len(symbols) - 1)] = False
    symbols[is_word] = numbers.indices.to_numpy(zero_copy_only=False)
    symbols[~is_word] = np.arange(n_words, n_words + len(texts) + 1)
    start, length, period = find_runs(symbols, int(sizes.max(initial=0)), least)
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change) > 0
    owner = np.searchsorted(begins, start, "right") - 1
    left = []
    for w, at, n in zip(words, begins.tolist(), sizes.tolist()):
        gone = dropped[at : at + n]
        left.append(b" ".join([x for x, g in zip(w, gone.tolist()) if not g] if gone.any() else w))
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - begins[owner], length, period)], fields=list(RUN))
    return sizes.tolist(), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs), left


def collapse(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row, with the columns that `keep` names.

    A run is a stretch of consecutive words with a smallest period q and of max(`least`, 2 q) words at
    least that no neighbouring word extends. runs has start (a number of a word, from 0), length
    and period of all of them, by start, then period. collapsed are the words but those that some run contains
    after its first q words, with single blanks between them. Words are separated by ASCII white space.

    A null text counts as empty: no words, no runs, an empty text. Null and
    repeated ids stay rows of their own. No shuffle; `least` is 12 or more.
    Texts that repeat in a batch are searched once.
    """
    if least < LEAST:
        raise ValueError(f"runs of under {LEAST} words aren't searched")
    names = [id_col, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rest = b.drop_columns(["_text"])
            done, known, size = 0, {}, 0
            which: list[int] = []
            for i, x in enumerate(b.column("_text")):
                which.append(known.setdefault((x.as_py() or "").encode(), len(known)))
                size += len(x.as_py() or "") // 6 + 1
                if size >= TOGETHER or i == b.num_rows - 1:
                    n, runs, left = _collapsed(list(known), least)
                    take = pa.array(which)
                    part = rest.slice(done, len(which))
                    columns = [pa.array(n, pa.int64()), runs, pa.array(left, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays([*part.columns, *(c.take(take) for c in columns)], [*part.schema.names, "n_words", "runs", "collapsed"])
                    done, known, which, size = i + 1, {}, [], 0

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(F.col(text_col).alias("_text"), *names).mapInArrow(run, f"{schema}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def repeated_tail(text: Column, key: Column) -> Column:
    """`text` with a tail that repeats, for a tenth of the keys: the words that the checks of this operator plant.

    With h = crc32 of the key, g = h / 10 and n words, each word from a = g % n on
    becomes word a + (i - a) % p with p = 1 + (n - a) / (3 + g % 8), where h % 10 is 0 (quotients are whole numbers). Other
    texts, those without words or without a key stay.
    """
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        made = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i)))
        return F.when(n > 0, F.array_join(made, " ")).otherwise(text)

    # The words are bound once, not worked out again for each place.
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), tail), F.lit(0))).otherwise(text)
