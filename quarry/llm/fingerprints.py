"""Document fingerprints: canonical exact digests.

A text's canonical form is NFKC, case folded, NFKC again, with each run of
white space as one blank and none at the ends. Its fingerprint is a 128-bit
xxhash of that form in hex. Texts of equal fingerprints are compared byte by
byte; should different forms ever share a hash, all fingerprints carry the
SHA-256 of the form as well, so that equal fingerprints mean equal forms.
"""

from __future__ import annotations

import hashlib
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import partitions, settle

#: Repeated hashes up to this many bytes are broadcast to the scan; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20


def canonical(text: str) -> bytes:
    """NFKC, case fold, NFKC, white space folded and trimmed, as UTF-8."""
    if text.isascii():
        text = text.lower()
    else:
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(text.split()).encode()


Hash = Callable[[bytes], str]


def digest(form: bytes, wide: bool = False, narrow: Hash = xxhash.xxh3_128_hexdigest) -> str:
    """128-bit xxhash in hex; the wide digest adds SHA-256."""
    return narrow(form) + (hashlib.sha256(form).hexdigest() if wide else "")


def edit(text: str, other: str) -> str:
    """`text` with its last floor(n/2) characters replaced by the first as many, or all, of `other`."""
    n = len(text) // 2
    return text[: len(text) - n] + other[:n]


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", narrow: Hash = xxhash.xxh3_128_hexdigest) -> DataFrame:
    """(id, fingerprint, n_same): n_same rows share the canonical form, whose hash `narrow` gives.

    A null text counts as empty, and all empty texts share one fingerprint.
    Null ids, repeated ids and repeated rows stay rows of their own; an empty
    table gives an empty result. No other column is read.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def prints(wide: bool) -> DataFrame:
        return texts.mapInArrow(_digests(wide, narrow), f"id {kind}, fingerprint string")

    first = settle(prints(False))
    out = prints(True) if clash(texts, first, narrow) else first
    same = out.groupBy("fingerprint").agg(F.count("*").alias("n_same"))
    return out.join(same, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "n_same")


def _digests(wide: bool, narrow: Hash):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([digest(canonical(x), wide, narrow) for x in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), found], ["id", "fingerprint"])

    return run


def clash(texts: DataFrame, prints: DataFrame, narrow: Hash = xxhash.xxh3_128_hexdigest) -> bool:
    """Whether different forms of `texts` (text) share a hash, by comparison of
    the bytes of all forms whose hash occurs more than once in `prints`.

    Each task folds the copies that it meets, so that a large group of copies
    sends one form a batch. The least and the greatest form of a hash differ
    if any two do.
    """
    several = prints.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select(F.col("fingerprint").alias("h"))
    several = settle(several)
    hashed = texts.select("text").mapInArrow(_with_hash(narrow), "h string, text string")
    if several.count() * 64 <= BROADCAST_BYTES:
        several = F.broadcast(several)
    forms = hashed.join(several, "h", "left_semi").mapInArrow(_distinct_forms, "h string, form binary")
    return not forms.groupBy("h").agg(F.min("form").alias("a"), F.max("form").alias("z")).where("a <> z").isEmpty()


def _with_hash(narrow: Hash):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([digest(canonical(x), False, narrow) for x in b.column(0).to_pylist()], pa.string()), b.column(0)], ["h", "text"])

    return run


def _distinct_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        forms = list({(h, canonical(x)) for h, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())})
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in forms], pa.string()), pa.array([x for _, x in forms], pa.binary())], ["h", "form"])


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", narrow: Hash = xxhash.xxh3_128_hexdigest) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The documents stand in descending order of id, null ids last, those of one
    id by the xxhash64 of the text; after the last comes the first. The edited
    text is `edit(text, next text)`. Out: id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next, which are 1
    where the forms are equal and 0 elsewhere. Null texts count as empty. A
    single row is its own next. The text is shuffled once, into ranges of ids,
    and of hashes within an id that many rows have or lack; equal rows travel
    as one with their number. The first row of each range goes to the range
    before it as well, so that no task needs more than its own range.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = partitions(spark)
    share = [i / (2 * n) for i in range(1, 2 * n)]
    cuts, rows, known = texts.agg(F.percentile_approx("id", share, 20 * n), F.count("*"), F.count("id")).first()
    ranges = Ranges.of(cuts or [], 2 * n * (rows - known) // max(1, rows))
    hashed = texts.withColumn("h", F.xxhash64("text") if ranges.by_hash else F.lit(0).cast("long"))
    # The first row of each range: as many as there are ranges.
    firsts = hashed.select("id", "h").mapInArrow(_firsts(ranges), f"part int, id {kind}, h long")
    firsts = firsts.groupBy("part").agg(F.max(F.struct("id", F.bitwise_not("h").alias("back"))).alias("top"))
    firsts = {r["part"]: (r["top"]["id"], ~r["top"]["back"]) for r in firsts.collect()}
    order = [F.col("part"), F.col("ghost"), F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    dealt = hashed.mapInArrow(_deal(ranges, firsts), f"part int, ghost boolean, id {kind}, text string, copies int")
    dealt = dealt.repartitionById(n, F.pmod("part", F.lit(n))).sortWithinPartitions(*order)
    schema = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    first = settle(dealt.mapInArrow(_compare(False, narrow), schema))
    out = dealt.mapInArrow(_compare(True, narrow), schema) if clash(texts, first, narrow) else first
    return out.withColumnRenamed("id", id_col)


@dataclass
class Ranges:
    """Numbered ranges in the order of the documents: ids between `cuts`, which
    ascend, and `several` ranges of hashes for a cut that many rows have; the
    last `nulls` ranges are those of rows without an id."""

    cuts: list
    several: list[int]
    nulls: int

    @classmethod
    def of(cls, cuts: list, nulls: int) -> Ranges:
        """A value that stands for k quantiles gets k ranges of its own."""
        found = sorted(Counter(cuts).items())
        return cls([x for x, _ in found], [k if k > 1 else 0 for _, k in found], max(1, nulls))

    def __post_init__(self):
        self.by_hash, at = any(self.several) or self.nulls > 1, 1
        self.own, self.below = [0] * len(self.cuts), [0] * len(self.cuts)
        for i in range(len(self.cuts) - 1, -1, -1):
            self.own[i] = at
            at += self.several[i]
            self.below[i] = at
            at += 1
        self.last = at

    def part(self, x, h: int) -> int:
        spread = lambda k: (h + (1 << 63)) * k >> 64
        if x is None:
            return self.last + spread(self.nulls)
        i = bisect_left(self.cuts, x)
        if i == len(self.cuts):
            return 0
        return self.own[i] + spread(self.several[i]) if self.several[i] and self.cuts[i] == x else self.below[i]


def _firsts(ranges: Ranges):
    """The first (id, hash) of each range in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict = {}
            for x, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = ranges.part(x, h)
                if p not in found or _before((x, h), found[p]):
                    found[p] = (x, h)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x for x, _ in found.values()], b.schema.types[0]), pa.array([h for _, h in found.values()], pa.int64())], ["part", "id", "h"])

    return run


def _before(a: tuple, b: tuple) -> bool:
    """Whether (id, hash) a stands before b."""
    if a[0] == b[0]:
        return a[1] < b[1]
    return b[0] is None or a[0] is not None and a[0] > b[0]


def _deal(ranges: Ranges, firsts: dict):
    """Each row to its range, equal rows of a batch as one; a range's first row
    also, as a ghost, to the range before that has rows, or from the first to
    the last."""
    held = sorted(firsts)
    before = {q: p for p, q in zip(held[-1:] + held[:-1], held)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, h = b.column(0).to_pylist(), b.column(2).to_pylist()
            texts = b.column(1).to_pylist()
            place: dict[tuple, int] = {}  # of the first of equal rows
            copies = Counter(place.setdefault(row, i) for i, row in enumerate(zip(ids, texts)))
            rows = list(copies)
            parts = [ranges.part(ids[i], h[i]) for i in rows]
            ghosts = [(i, p) for i, p in zip(rows, parts) if (ids[i], h[i]) == firsts[p]]
            take = pa.array([*rows, *(i for i, _ in ghosts)], pa.int64())
            columns = [pa.array([*parts, *(before[p] for _, p in ghosts)], pa.int32()), pa.array([False] * len(rows) + [True] * len(ghosts)), b.column(0).take(take), b.column(1).take(take), pa.array([*copies.values(), *[1] * len(ghosts)], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "ghost", "id", "text", "copies"])

    return run


def _compare(wide: bool, narrow: Hash):
    """Rows come by range, each range's own rows first and then its ghosts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # part, ghost, id, text, form and digest of the row before
        for b in batches:
            out: list[list] = [[] for _ in range(7)]

            def tell(x, own: str, form: bytes, found: str, text: str, other: bytes, times: int = 1) -> None:
                edited = edit(own, text)
                edited_form = canonical(edited)
                row = (x, len(own), hashlib.sha256(edited.encode()).hexdigest(), found, digest(edited_form, wide, narrow), float(edited_form == form), float(form == other))
                for column, v in zip(out, row):
                    column.extend([v] * times)

            for part, ghost, x, text, copies in zip(*(b.column(i).to_pylist() for i in range(5))):
                before = last if last and last[0] == part else None
                if ghost and (before is None or before[1]):
                    continue
                form = canonical(text)
                now = (part, ghost, x, text, form, digest(form, wide, narrow))
                if before:
                    tell(*before[2:], text, form)
                if copies > 1:  # each but the last is followed by its equal
                    tell(*now[2:], text, form, copies - 1)
                last = now
            kinds = [b.schema.types[2], pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)

    return run
