"""N-gram models as flat sorted arrays, and the scores of texts in them.

A node is an n-gram of the model. Those of one length are numbered in the order
of (node of all but the last symbol, last symbol), which is one number, so that
a node is found by a binary search: of all places of a text at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Numbers of the symbols that are no characters.
MARKS = {"<s>": 0x110000, "</s>": 0x110001, "<unk>": 0x110002}
START, END = MARKS["<s>"], MARKS["</s>"]
NAMES = {code: mark for mark, code in MARKS.items()}
FILLER = 0x110003
#: Places that are scored at once.
PIECE = 1 << 20


def _code(symbol: str) -> int:
    """Code point of a character or of its escape."""
    return MARKS.get(symbol) or (ord(symbol) if len(symbol) == 1 else int(symbol[2:], 16))


@dataclass
class PackedModel:
    """codes: the sorted symbols; keys, logp, bow: of each length of n-grams. No probability is NaN."""

    codes: np.ndarray
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    bow: list[np.ndarray]
    unknown: float

    def _find(self, level: int, before: np.ndarray | None, symbol: np.ndarray) -> np.ndarray:
        """Nodes of a length by those of one symbol less and the last symbols; -1 where there is none."""
        keys = self.keys[level]
        if not len(keys):
            return np.full(len(symbol), -1)
        wanted = symbol if before is None else np.where((before < 0) | (symbol < 0), -1, before * len(self.codes) + symbol)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, at, -1)

    def _symbols(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, -1)

    def place_scores(self, codes: np.ndarray) -> np.ndarray:
        """For each symbol the logarithm of its probability after those before it, by the longest n-gram that the
        model has and the weights of the longer contexts."""
        symbol = self._symbols(codes)
        score = np.full(len(codes), self.unknown)
        node: np.ndarray | None = None
        for level in range(len(self.keys)):
            before = None if node is None else np.concatenate(([-1], node[:-1]))
            node = self._find(level, before, symbol)
            if before is not None:
                score += np.where(before >= 0, self.bow[level - 1][before], 0.0)
            own = self.logp[level][node] if len(self.logp[level]) else np.full(len(node), np.nan)
            score = np.where((node >= 0) & ~np.isnan(own), own, score)
        return score

    def text_score(self, codes: np.ndarray) -> float:
        """The sum over a text's symbols and line ends, in pieces that begin with as much as n-grams reach back."""
        total, reach = 0.0, len(self.keys) - 1
        for at in range(0, len(codes), PIECE):
            first = max(0, at - reach)
            part = codes[first : at + PIECE]
            scores = self.place_scores(part)[at - first :]
            total += float(scores[part[at - first :] != START].sum())
        return total


def text_codes(text: str) -> np.ndarray:
    """The symbols of a text: each line between its marks, without ASCII white space; none of an empty text."""
    if not text:
        return np.zeros(0, np.int64)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    c = c[(c == 10) | ~((c >= 9) & (c <= 13) | (c >= 28) & (c <= 32))]
    ends = c == 10
    out = np.repeat(c, np.where(ends, 2, 1))
    last = np.flatnonzero(ends) + np.arange(ends.sum())  # of each line, where its end stands
    out[last], out[last + 1] = END, START
    return np.concatenate(([START], out, [END]))


def symbol_of(code: int) -> str:
    """The symbol of a number: a mark, an ASCII character, or the escape of another."""
    if code >= START:
        return NAMES[code]
    return chr(code) if code < 0x80 else f"\\x{code:02x}" if code < 0x100 else f"\\u{code:04x}" if code < 0x10000 else f"\\U{code:08x}"


def longest_counts(codes: np.ndarray, order: int) -> tuple[list[str], np.ndarray]:
    """The different n-grams of texts' symbols, one text behind the other, and how often each occurs: for each symbol after `<s>` the longest one up to `order` that ends there."""
    # Before each `<s>` stand so many fillers that all n-grams have `order` places.
    opens = codes == START
    fill = max(order - 2, 0)
    full = np.repeat(codes, np.where(opens, fill + 1, 1))
    first = np.flatnonzero(opens) + fill * np.arange(np.count_nonzero(opens))
    for i in range(fill):
        full[first + i] = FILLER
    total: dict[str, int] = {}
    for at in range(0, len(full), PIECE):
        part = full[max(0, at - order + 1) : at + PIECE]
        reach = at - max(0, at - order + 1)
        ends = np.flatnonzero(part < FILLER)
        ends = ends[(ends >= reach) & (part[ends] != START)]
        if not len(ends):
            continue
        own = np.flatnonzero(np.bincount(part))
        number = np.zeros(own[-1] + 1, np.int64)
        number[own] = np.arange(len(own))
        small = number[part]
        key, room = small[ends - order + 1], len(own)
        for k in range(order - 2, -1, -1):
            if room * len(own) >= 1 << 62:
                different, key = np.unique(key, return_inverse=True)
                room = len(different)
            key, room = key * len(own) + small[ends - k], room * len(own)
        if room <= min(4 * PIECE, 16 * len(ends)):
            counts = np.bincount(key, minlength=room)
            place = np.zeros(room, np.int64)
            place[key] = ends
            there = np.flatnonzero(counts)
            place, counts = place[there], counts[there]
        else:
            _, which, counts = np.unique(key, return_index=True, return_counts=True)
            place = ends[which]
        names = ["" if c == FILLER else symbol_of(int(c)) + " " for c in own]
        grams = small[place[:, None] + np.arange(1 - order, 1)].tolist()
        for gram, n in zip(grams, counts.tolist()):
            text = "".join([names[x] for x in gram])[:-1]
            total[text] = total.get(text, 0) + n
    return list(total), np.fromiter(total.values(), np.int64, len(total))


def pack(model: pa.Table) -> PackedModel:
    """The model (ngram, logp, bow). N-grams that others begin with become nodes without a probability where they are lacking."""
    words = pc.split_pattern(model["ngram"].combine_chunks(), " ")
    told = pc.dictionary_encode(words.flatten())
    told = told.combine_chunks() if isinstance(told, pa.ChunkedArray) else told
    code_of = np.array([_code(s) for s in told.dictionary.to_pylist()], np.int64)
    codes, number = np.unique(code_of, return_inverse=True)
    flat = number[told.indices.to_numpy(zero_copy_only=False)]
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    begin = np.cumsum(size) - size
    logp, bow = (np.asarray(model[c].combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False), float) for c in ("logp", "bow"))
    order = int(size.max()) if len(size) else 0
    grams, rest = [None] * order, np.zeros((0, order), np.int64)
    for n in range(order, 0, -1):
        rows = np.flatnonzero(size == n)
        own = flat[begin[rows][:, None] + np.arange(n)]
        every = np.unique(np.concatenate((own, rest[:, :n])), axis=0)
        grams[n - 1], rest = (own, rows, every), every
    unknown = logp[(size == 1) & (codes[flat[begin]] == MARKS["<unk>"])]
    if not len(unknown):
        raise ValueError("the model has no <unk>")
    out = PackedModel(codes, [], [], [], float(unknown[0]))

    def nodes(symbols: np.ndarray) -> np.ndarray | None:
        found = None
        for i in range(symbols.shape[1]):
            found = out._find(i, found, symbols[:, i])
        return found

    for n, (own, rows, every) in enumerate(grams, 1):
        before = nodes(every[:, : n - 1])
        out.keys.append(np.sort(every[:, 0] if before is None else before * len(codes) + every[:, -1]))
        at = nodes(own)
        for columns, values, default in ((out.logp, logp, np.nan), (out.bow, np.nan_to_num(bow), 0.0)):
            column = np.full(len(every), default)
            column[at] = values[rows]
            columns.append(column)
    return out
