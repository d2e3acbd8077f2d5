"""Quality classifier by compression.

Two zstandard dictionaries are built from pieces of good and of bad labelled
texts. A text is compressed piece by piece with either; the difference of the
sizes over the text's length tells which of the two it resembles. A logistic
curve, fitted on labelled texts that the dictionaries haven't seen, turns the
difference into the probability of label 1. The length has no say of its own:
the less text there is, the more the difference gives way to the share of
label 1 among all labels, which is the score of an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fit takes this many documents of each label at most, those of least id hash, with their whole texts.
SAMPLE_DOCUMENTS = 1_500
PIECE, DICTIONARY, LEVEL = 2_048, 112_640, 3
#: With so many bytes text and share of labels weigh the same.
SHORT = 128


def is_held_out(id_col: str = "doc_id") -> Column:
    """Rows whose crc32(id as text) mod 4 is 2 are never learned from; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """Dictionaries of label 1 and 0, and the curve: 1 / (1 + exp(-x)) with
    x = w * (slope * difference + shift) + (1 - w) * prior and the weight w of a text of n bytes, n / (n + SHORT)."""

    good: bytes
    bad: bytes
    slope: float
    shift: float
    prior: float

    def open(self) -> Model:
        make = lambda d: zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=False, write_dict_id=False)
        self._good, self._bad = make(self.good), make(self.bad)
        return self

    def difference(self, text: bytes) -> float:
        """How many bytes a byte of text takes less with the good dictionary than with the bad; 0 for no text."""
        total = 0
        for i in range(0, len(text), PIECE):
            piece = text[i : i + PIECE]
            total += len(self._bad.compress(piece)) - len(self._good.compress(piece))
        return total / max(1, len(text))

    def score(self, text: bytes) -> float:
        w = weight(text)
        x = w * (self.slope * self.difference(text) + self.shift) + (1 - w) * self.prior
        return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def weight(text: bytes) -> float:
    return len(text) / (len(text) + SHORT)


def _pieces(texts: list[bytes], budget: int) -> list[bytes]:
    """Pieces of texts, up to a budget of bytes: all of them, or some that are evenly spread over all texts."""
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    step = max(1.0, sum(map(len, pieces)) / max(1, budget))
    return [pieces[int(k * step)] for k in range(int(len(pieces) / step))]


def _dictionary(texts: list[bytes], budget: int) -> bytes:
    """A dictionary of pieces, up to a budget of bytes that both labels share; empty if there is too little text."""
    pieces = _pieces(texts, budget)
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(pieces)[-DICTIONARY:]


def _curve(difference: np.ndarray, w: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift by logistic regression with Newton's steps, smoothed targets and a slight penalty."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, known, found = np.column_stack([w * difference, w]), (1 - w) * prior, np.zeros(2)
    ridge = np.diag([1e-4, 1e-4])
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(a @ found + known, -40, 40)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (target - p) - ridge @ found)
        found = found + np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-7:
            break
    return float(found[0]), float(found[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out: Column | None = None, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Learn from labelled rows that aren't held out.

    Null ids, labels and texts are left out; a document with several labels
    or texts counts as its least. Two thirds of the sample make the dictionaries, one
    third the curve. Where a label has no sample the score is the same for all
    texts: the smoothed share of label 1.
    """
    held_out = is_held_out(id_col) if held_out is None else held_out
    known = labels.where(~held_out).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y")).na.drop()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).na.drop()
    found: dict[int, list[bytes]] = {}
    for y in (1, 0):
        # Bounded: ids of least hash.
        ids = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample).select("id")
        rows = texts.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"))
        found[y] = [r["text"].encode() for r in sorted(rows.withColumn("h", F.xxhash64("id")).collect(), key=lambda r: (r["h"], r["id"]))]
    good, bad = found[1], found[0]
    sampled = float(np.log((len(good) + 1) / (len(bad) + 1)))
    if len(good) < 3 or len(bad) < 3:
        return Model(b"", b"", 0.0, sampled, sampled)
    train = {y: [t for i, t in enumerate(ts) if i % 3] for y, ts in found.items()}
    budget = min(sum(map(len, ts)) for ts in train.values())
    model = Model(_dictionary(train[1], budget), _dictionary(train[0], budget), 0.0, 0.0, 0.0).open()
    tests = [(t, y) for y, ts in found.items() for t in ts[::3]]
    told = (np.array(x) for x in zip(*((model.difference(t), weight(t), y) for t, y in tests)))
    slope, shift = _curve(*told, sampled)
    # The sample may hold equally many of both labels; the share among all labelled rows shifts the curve.
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    prior = float(np.log((counts[1] + 1) / (counts[0] + 1)))
    return Model(model.good, model.bad, slope, shift + prior - sampled, prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, score) for every row: the probability of label 1, from the whole text alone.

    A null text counts as empty; an empty text gets the share of label 1. Null and repeated ids stay rows of their own. `keep` names
    columns to carry along. No shuffle.
    """
    names = [id_col, *keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value.open()
        for b in batches:
            scores = [m.score((x.as_py() or "").encode()) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(scores, pa.float64())], [*names, "score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names) + ", score double"
    return docs.select(F.col(text_col).alias("_text"), *names).mapInArrow(run, schema)
