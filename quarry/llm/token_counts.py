"""Token counts by overlap resynchronisation.

Short texts are encoded whole. A huge text is cut into chunks that overlap;
each chunk is encoded with offsets. Two neighbouring chunks are spliced at a
position where both have a token boundary and the pre-tokeniser always ends one
piece and begins the next, whatever stands before: behind a letter before what
is none, behind a digit before what is none, and behind another sign, but an
apostrophe, before a letter, digit or white space. No alternative of its
pattern goes on there. Pieces are merged each on its own, so the tokens on both
sides are those of the whole text. Where an overlap holds no such position it
is widened, up to the rest of the text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of byte-level BPE: the pre-tokeniser's pattern, and the bytes that stand for themselves in the vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

CHUNK, OVERLAP = 65_536, 512
SEAM = regex.compile(r"(?:(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\s\p{L}\p{N}'])(?=[\s\p{L}\p{N}]))(?=.)", regex.S)


def byte_of() -> dict[str, int]:
    """The byte for each character of the vocabulary file; bytes that don't stand for themselves follow from 256 on."""
    rest = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """The tokens of a byte-level BPE vocabulary file (JSON), merged by the tiktoken library."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        table = byte_of()
        ranks = {bytes(table[c] for c in k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {k: v for k, v in ranks.items() if v not in self.special.values()}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.core = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def parts(self, text: str) -> tuple[list[str], int]:
        """The stretches between special strings, and how many those are."""
        if self.split is None or not any(s in text for s in self.special):
            return [text], 0
        parts = self.split.split(text)
        return parts, len(parts) - 1

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        parts, specials = self.parts(text)
        return specials + sum(len(self.core.encode_ordinary(p)) if len(p) <= chunk else self.count_long(p, chunk, overlap) for p in parts)

    def ends(self, text: str) -> list[int]:
        """The end of each token of `text` in UTF-8 bytes."""
        return list(accumulate(map(len, self.core.decode_tokens_bytes(self.core.encode_ordinary(text)))))

    def count_long(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of a long text: encode chunks, splice each at a seam that both neighbours share."""
        total, start = 0, 0
        while len(text) - start > chunk:
            end, wide = start + chunk, overlap
            while True:
                left, right = text[start:end], text[max(start + 1, end - wide) : end + wide]
                at = self.seam(left, right, max(start + 1, end - wide) - start)
                if at:
                    break
                wide *= 2
                end = min(len(text), start + chunk + wide)
                if end == len(text):
                    break
            if not at:
                break
            total += at[1]
            start += at[0]
        return total + len(self.core.encode_ordinary(text[start:]))

    def seam(self, left: str, right: str, offset: int) -> tuple[int, int] | None:
        """The last seam of the overlap at which both chunks end a token: its
        place in `left`, and how many tokens of `left` end there or before.
        `right` begins at `offset` of `left`."""
        mine, other = self.ends(left), None
        for m in reversed(list(SEAM.finditer(left, offset))):
            p = m.start()
            n = len(left[:p].encode())
            k = _index(mine, n)
            if k is None or p <= offset:
                continue
            other = other if other is not None else self.ends(right)
            if _index(other, len(left[offset:p].encode())) is not None:
                return p, k + 1
        return None


def _index(ends: list[int], x: int) -> int | None:
    from bisect import bisect_left

    i = bisect_left(ends, x)
    return i if i < len(ends) and ends[i] == x else None


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of `docs`.

    `path` is a byte-level BPE file of the tokenizers library, found at the
    same place on every worker. Special strings in a text are one token each,
    as that library has it. A null text counts as empty: 0 bytes and tokens.
    Rows with null or repeated ids are kept as they are; no other column is
    read. No shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            texts = [x.as_py() or "" for x in b.column(1)]
            n = [e.count(x, chunk, overlap) for x in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])], ["id", "n_bytes", "n_tokens", "over_limit"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
