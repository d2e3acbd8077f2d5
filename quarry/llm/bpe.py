"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus' most frequent words (counted over all documents) are encoded once
and compiled into a minimal acyclic automaton: equal suffixes share states,
and numbers on the transitions add up to the piece's place in a table of token
ids. The automaton is a few flat arrays that each worker maps into memory.
Pieces that it lacks are merged exactly, by the ranks of their pairs.
"""

from __future__ import annotations

import json
import mmap
import re
import tempfile
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import settle
from quarry.llm.token_counts import PATTERN, byte_of

#: Words in the lexicon, with and without a blank before, and characters of a word; both bound it on the driver and in the broadcast. Longer words are merged exactly.
LEXICON, LONGEST = 65_536, 64
#: Pieces that a worker remembers besides the lexicon; they make way for newer ones in two generations.
MEMO = 150_000
#: Tokens that are decoded at once.
AT_ONCE = 1 << 18

_slow = regex.compile(PATTERN)
_latin = "A-Za-zÀ-ÖØ-öø-ÿ"
#: The same pattern for texts of Latin-1 letters, plain digits and plain white space only, which the faster module can split.
_fast = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_latin}]+| ?[0-9]+| ?[^\s{_latin}0-9]+|\s+(?!\S)|\s+")
_other = re.compile("[^\t-\r -~\xa1-\xff]|[ª²³µ¹º¼-¾]")


def pieces(text: str) -> list[str]:
    """The pre-tokeniser's pieces of a text without special strings."""
    return (_slow if _other.search(text) else _fast).findall(text)


class Vocabulary:
    """A byte-level BPE file (JSON) of the tokenizers library."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        table = byte_of()
        spell = lambda s: bytes(table[c] for c in s)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.id_of = {spell(k): v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        self.core = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=self.id_of, special_tokens={})
        self.bytes_of = {v: k for k, v in self.id_of.items()} | {v: k.encode() for k, v in self.special.items()}
        known = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.spelt, self.size = np.frombuffer(b"".join(known), np.uint8), np.array([len(x) for x in known])
        self.start = np.cumsum(self.size) - self.size
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, piece: str) -> list[int]:
        """The ids of one piece, by the ranks of its pairs. The pre-tokeniser takes a piece that stands alone whole."""
        return self.core.encode_ordinary(piece)

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of the ids up to each of `ends`, which begins with 0."""
        parts = []
        for i in range(0, len(ids), AT_ONCE):
            size, start = self.size[ids[i : i + AT_ONCE]], self.start[ids[i : i + AT_ONCE]]
            at = np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)
            parts.append(self.spelt[at].tobytes())
        spelt, to = b"".join(parts), np.append(0, np.cumsum(self.size[ids]))[ends].tolist()
        return [spelt[a:b].decode("utf-8", "replace") for a, b in zip(to, to[1:])]


def compile_lexicon(words: list[bytes], outputs: list[list[int]]) -> bytes:
    """The minimal acyclic transducer of `words` (distinct) as flat arrays in one block of bytes.

    Built from sorted words: states behind the last word's end can't change any
    more and are replaced by an equal state where there is one.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    register: dict[tuple, int] = {}
    final: list[bool] = []
    edges: list[list[tuple[int, int]]] = []
    count: list[int] = []  # words that end at a state or behind it

    def freeze(state: tuple[list, list]) -> int:
        key = (state[0][0], tuple(state[1]))
        if key not in register:
            register[key] = len(final)
            final.append(state[0][0])
            edges.append(list(state[1]))
            count.append(state[0][0] + sum(count[t] for _, t in state[1]))
        return register[key]

    path: list[tuple[list, list]] = [([False], [])]  # open states of the last word
    last = b""
    for i in order:
        w, n = words[i], 0
        while n < min(len(w), len(last)) and w[n] == last[n]:
            n += 1
        for k in range(len(path) - 1, n, -1):
            path[k - 1][1].append((last[k - 1], freeze(path.pop())))
        path.extend(([False], []) for _ in w[n:])
        path[-1][0][0] = True
        last = w
    for k in range(len(path) - 1, 0, -1):
        path[k - 1][1].append((last[k - 1], freeze(path.pop())))
    root = freeze(path[0])
    first = np.zeros(len(final) + 1, np.int32)
    label, target, add = [], [], []
    for s, out in enumerate(edges):
        before = int(final[s])
        for c, t in out:
            label.append(c)
            target.append(t)
            add.append(before)
            before += count[t]
        first[s + 1] = len(label)
    ids = [outputs[i] for i in order]
    arrays = [first, np.array(target, np.int32), np.array(add, np.int32), np.cumsum([0, *map(len, ids)]).astype(np.int32), np.array(list(chain.from_iterable(ids)), np.int32), np.array(label, np.uint8), np.array(final, np.uint8)]
    head = np.array([root, *map(len, arrays)], np.int32)
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled transducer, mapped into memory from a file of this worker that has no name any more."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(block)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        root, *sizes = np.frombuffer(self.map, np.int32, 8).tolist()
        at, arrays = 32, []
        for n, kind in zip(sizes, [np.int32] * 5 + [np.uint8] * 2):
            arrays.append(memoryview(np.frombuffer(self.map, kind, n, at)))
            at += n * np.dtype(kind).itemsize
        self.root, (self.first, self.target, self.add, self.start, self.ids, self.label, self.final) = root, arrays

    def get(self, word: bytes) -> list[int] | None:
        state, place, first, label = self.root, 0, self.first, self.label
        for c in word:
            end = first[state + 1]
            i = bisect_left(label, c, first[state], end)
            if i == end or label[i] != c:
                return None
            place += self.add[i]
            state = self.target[i]
        return self.ids[self.start[place] : self.start[place + 1]].tolist() if self.final[state] else None


class Coder:
    """Encodes texts: memory of recent pieces, then the lexicon, then exact merges. Ids are four bytes each."""

    def __init__(self, path: str, block: bytes | None):
        self.vocabulary = Vocabulary(path)
        self.lexicon = Lexicon(block) if block else None
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            found = self.lexicon.get(text.encode()) if self.lexicon else None
            ids = array("i", self.vocabulary.merge(text) if found is None else found).tobytes()
        if len(self.memo) >= MEMO:
            self.old, self.memo = self.memo, {}
        self.memo[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        special, out = self.vocabulary.special, []
        for part in self.vocabulary.split.split(text) if self.vocabulary.split and any(s in text for s in special) else [text]:
            if part in special:
                out.append(array("i", [special[part]]).tobytes())
                continue
            found, get = pieces(part), self.memo.get
            try:
                out.append(b"".join(map(get, found)))
            except TypeError:  # a piece that isn't remembered
                out.append(b"".join([get(p) or self.piece(p) for p in found]))
        return b"".join(out)


_coders: dict[tuple, Coder] = {}


def coder(path: str, block) -> Coder:
    """One coder for each worker process, file and lexicon (a broadcast or None)."""
    key = (path, block.id if hasattr(block, "id") else id(block))
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(path, block.value if block is not None else None)
    return _coders[key]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for x in b.column(0):
            seen.update(w for w in (x.as_py() or "").split() if len(w) <= LONGEST)
            if len(seen) > MEMO:
                yield out()
                seen.clear()
    yield out()


def frequent_words(docs: DataFrame, n: int = LEXICON, text_col: str = "text") -> list[str]:
    """The n most frequent words between white space (ties by the word), of LONGEST characters at most.

    Each task counts before the shuffle. A histogram of the counts' logarithms
    shows which counts can be among the n highest; only words of such counts
    are sorted and sent on.
    """
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_count, "word string, n long")
    counts = settle(counts.groupBy("word").agg(F.sum("n").alias("n")).withColumn("step", F.floor(F.log2("n") * 16)))
    least, seen = 0, 0
    for step, words in sorted(map(tuple, counts.groupBy("step").agg(F.count("*")).collect()), reverse=True):
        least, seen = step, seen + words
        if seen >= n:
            break
    top = counts.where(F.col("step") >= least).select("word", "n").orderBy(F.col("n").desc(), "word").limit(n)
    return [r[0] for r in top.collect()]


def build_lexicon(docs: DataFrame, path: str, n: int = LEXICON, text_col: str = "text"):
    """The corpus' lexicon for the vocabulary at `path`, as a broadcast: the
    pieces of its n most frequent words. None for a corpus without words."""
    found = sorted({p for w in frequent_words(docs, n, text_col) for p in (*pieces(w), *pieces(" " + w))})
    v = Vocabulary(path)
    return docs.sparkSession.sparkContext.broadcast(compile_lexicon([p.encode() for p in found], [v.merge(p) for p in found])) if found else None


def encode(docs: DataFrame, path: str, lexicon=None, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ids, and with `decode` the text decoded from the ids) for every row.

    The ids are those of the tokenizers library for the byte-level BPE file at
    `path`, without special tokens added; special strings in a text become
    their own ids. A null text counts as empty and gets no ids. Rows with null
    or repeated ids stay as they are. `keep` names more columns to carry along.
    No shuffle.
    """
    names = [id_col, *keep]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names) + ", ids array<int>" + (", decoded string" if decode else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, lexicon)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids = [c.encode(x.as_py() or "") for x in part.column(0)]
                ends = np.cumsum([0, *map(len, ids)]) // 4
                flat = np.frombuffer(b"".join(ids), np.int32)
                columns = [*part.columns[1:], pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))]
                if decode:
                    columns.append(pa.array(c.vocabulary.decode_all(flat, ends), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*names, "ids", *["decoded"] * decode])

    return docs.select(F.col(text_col).alias("_text"), *names).mapInArrow(run, schema)


def decode_ids(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from token ids; null ids give an empty text, unknown ids fail."""
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = coder(path, None).vocabulary
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.decode(x.as_py() or ()) for x in b.column(1)], pa.string())], ["id", "text"])

    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)
