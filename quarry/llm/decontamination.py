"""Benchmark decontamination by Wu-Manber search over words.

The search strings are windows of consecutive words of the benchmark's items.
For each block of two words the shift table says how far the search may jump;
where the jump is zero, the bucket of that block holds the few windows that
end their first m words with it and begin with the same block as the text, and
these are compared directly. Windows shorter than the usual length have tables
of their own, as the shortest string bounds every jump.

Words are numbers of the block's vocabulary and all tables flat arrays, about
30 bytes for each word of the items.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import settle

#: Bytes of item text that one pass over the documents searches for; a larger benchmark takes more passes.
BLOCK_BYTES = 16 << 20
#: Windows of these lengths share tables.
SHORT = ((1, 1), (2, 3), (4, 6), (7, 1 << 30))
#: Spreads blocks over the shift table.
FACTOR = 0x9E3779B1

_word = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """Words of digits, letters and non-ASCII characters, A-Z in lower case; none for null."""
    return _word.findall(text.encode().lower()) if text else []


class Search:
    """Wu-Manber tables for strings of words. A string is `size` numbers of `words` from `start`; `owner` tells whose it is."""

    def __init__(self, words: np.ndarray, start: np.ndarray, size: np.ndarray, owner: np.ndarray):
        self.words, self.m = words, int(size.min())
        self.pairs = self.m > 1
        self.jump = self.m - self.pairs
        self.mask = (1 << min(26, max(10, int(4 * len(words)).bit_length()))) - 1
        shift = np.full(self.mask + 1, self.jump, np.uint8 if self.jump < 256 else np.int32)
        for end in range(1 + self.pairs, self.m + 1):  # the least jump of a block comes last
            shift[self._block(start + end)] = self.m - end
        self.shift = memoryview(shift)
        key = self._block(start + self.m) << 32 | self._block(start + 1 + self.pairs)
        order = np.lexsort((owner, start, key))
        start, size, owner, key = start[order], size[order], owner[order], key[order]
        # Equal strings stand once, with all their owners.
        hashed = size.astype(np.uint64)
        for i in range(int(size.max())):
            inside = i < size
            w = words[np.where(inside, start + i, 0)].astype(np.uint64)
            hashed = np.where(inside, (hashed ^ w) * np.uint64(0xFF51AFD7ED558CCD) + (hashed >> np.uint64(31)), hashed)
        order = np.lexsort((owner, hashed, key))
        start, size, owner, key, hashed = start[order], size[order], owner[order], key[order], hashed[order]
        same = (key[1:] == key[:-1]) & (hashed[1:] == hashed[:-1]) & (size[1:] == size[:-1])
        for i in range(int(size.max())):
            both = np.flatnonzero(same)
            both = both[i < size[both]]
            same[both] &= words[start[both + 1] + i] == words[start[both] + i]
        first = np.flatnonzero(np.append(True, ~same))
        self.key, self.start, self.size = memoryview(np.ascontiguousarray(key[first])), start[first].astype(np.int32), size[first].astype(np.int32)
        self.owner, self.owned = owner.astype(np.int32), np.append(first, len(owner)).astype(np.int32)

    def _block(self, end: np.ndarray) -> np.ndarray:
        """The place in the shift table of the block before each end."""
        last = self.words[end - 1].astype(np.int64)
        return (self.words[end - 2].astype(np.int64) * FACTOR + last if self.pairs else last) & self.mask

    def find(self, text: list[int | None]) -> Iterator[tuple[int, int, np.ndarray]]:
        """Every occurrence: its first word's place, how many words, and the owners. None is a word of no string."""
        end, n, shift, mask, m, jump, key = self.m, len(text), self.shift, self.mask, self.m, self.jump, self.key
        while end <= n:
            last = text[end - 1]
            if last is None:  # no string covers it
                end += m
                continue
            if self.pairs:
                before = text[end - 2]
                if before is None:
                    end += jump
                    continue
                last = before * FACTOR + last & mask
            else:
                last &= mask
            step = shift[last]
            if step:
                end += step
                continue
            start = end - m
            if self.pairs:
                a, b = text[start], text[start + 1]
                first = None if a is None or b is None else a * FACTOR + b & mask
            else:
                first = last
            if first is not None:
                wanted = last << 32 | first
                i = bisect_left(key, wanted)
                while i < len(key) and key[i] == wanted:
                    at, size = int(self.start[i]), int(self.size[i])
                    if text[start : start + size] == self.words[at : at + size].tolist():
                        yield start, size, self.owner[self.owned[i] : self.owned[i + 1]]
                    i += 1
            end += 1


class Benchmark:
    """Windows of a block of items, and the items of each window."""

    def __init__(self, items: list[tuple], size: int):
        number: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items})
        place, parts, lengths, owner = {x: i for i, x in enumerate(self.names)}, [], [], []
        for item, text in items:
            w = words(text)
            if w:
                parts.append(np.fromiter((number.setdefault(x, len(number)) for x in w), np.int32, len(w)))
                lengths.append(len(w))
                owner.append(place[item])
        self.number, self.searches = number.get, []
        if not parts:
            return
        n, owner = np.array(lengths), np.array(owner)
        begin = np.cumsum(n) - n
        windows = np.maximum(n - size + 1, 1)
        start = np.arange(windows.sum()) + np.repeat(begin - np.cumsum(windows) + windows, windows)
        width, owner = np.repeat(np.minimum(n, size), windows), np.repeat(owner, windows)
        all_words = np.concatenate(parts)
        for low, high in ((size, size), *((a, min(b, size - 1)) for a, b in SHORT)):
            own = (low <= width) & (width <= high)
            if own.any():
                self.searches.append(Search(all_words, start[own], width[own], owner[own]))

    def hits(self, text: list[bytes]) -> list[tuple[int, int, set]]:
        numbers = list(map(self.number, text))
        return [(start, start + size, {self.names[i] for i in owners}) for search in self.searches for start, size, owners in search.find(numbers)]


def runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint runs that cover the same places."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, n_hit, items, spans) for every row of `docs`.

    A window is `size` consecutive words of an item; an item of fewer words,
    but not none, is one window. A word inside any occurrence of a window is
    hit. `items` holds the ids, as text in ascending order, of the items with
    an occurring window; `spans` the disjoint runs of hit words (start, end).
    Null texts have no words; items with a null id are ignored. Null and
    repeated document ids stay rows of their own. `keep` names columns to carry
    along. The items are searched in blocks of bounded size, one pass over the
    documents for each block, without a shuffle; each pass is settled before
    the next, so that a worker holds the tables of one block.
    """
    names = [id_col, *keep]
    items = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).na.drop()
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-5 * n_bytes // (4 * block_bytes)) if n_bytes > block_bytes else 1
    spark = docs.sparkSession
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    found = {"_n": "bigint", "_start": "array<int>", "_end": "array<int>", "_items": "array<string>"}
    out = docs.select(F.col(text_col).alias("_text"), *names)
    out = out.withColumns({c: F.lit(0).cast(t) if c == "_n" else F.array().cast(t) for c, t in found.items()})
    schema = ", ".join(["_text string", kinds, *(f"{c} {t}" for c, t in found.items())])
    for k in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == k).collect()
        block = spark.sparkContext.broadcast([(str(i), t) for i, t in rows])
        out = out.mapInArrow(_pass(block, size, k == n_blocks - 1), schema)
        out = out if k == n_blocks - 1 else settle(out)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda t, x: t + x)
    spans = F.transform(F.arrays_zip("_start", "_end"), lambda x: F.struct(x["_start"].alias("start"), x["_end"].alias("end")))
    return out.select(*names, F.col("_n").alias("n_words"), (total("_end") - total("_start")).alias("n_hit"), F.col("_items").alias("items"), spans.alias("spans"))


_benchmarks: dict[tuple, Benchmark] = {}


def _pass(block, size: int, last: bool):
    """Search one block of items; the last pass leaves the text behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (block.id if hasattr(block, "id") else id(block), size)
        if key not in _benchmarks:
            _benchmarks.clear()
            _benchmarks[key] = Benchmark(block.value, size)
        benchmark = _benchmarks[key]
        for b in batches:
            n, start, end, found = (b.column(i).to_pylist() for i in range(b.num_columns - 4, b.num_columns))
            for i, text in enumerate(b.column(0)):
                w = words(text.as_py())
                n[i] = len(w)
                hits = benchmark.hits(w)
                if hits:
                    spans = runs([*zip(start[i], end[i]), *((x, y) for x, y, _ in hits)])
                    start[i], end[i] = [x for x, _ in spans], [y for _, y in spans]
                    found[i] = sorted(set(found[i]).union(*(s for *_, s in hits)))
            text = pa.nulls(b.num_rows, pa.string()) if last else b.column(0)
            made = [pa.array(n, pa.int64()), pa.array(start, pa.list_(pa.int32())), pa.array(end, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([text, *b.columns[1:-4], *made], b.schema.names)

    return run
