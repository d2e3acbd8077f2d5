"""MinHash near-dedup with odd sketches.

A document is the set of its distinct shingles of consecutive words, hashed to
64 bits. Documents of equal sets are one class. For each class come

* the minima of k hash functions, in bands of r rows: two sets of similarity t
  share a band with a chance of 1 - (1 - t^r)^bands, and the number of bands is
  such that one in a million pairs at the threshold shares none;
* the odd sketch of the k samples: a bitmap that holds the parity of how many
  samples fall on each bit. The bits in which two sketches differ tell how many
  samples differ, most precisely where few do.

Classes that share a band are compared by sketch, and those that may reach the
threshold (five standard errors below it still count) make up candidate groups.
Within a group every link is then decided on the full sets. Neither step hands
on pairs: a task gives back a spanning forest of what it has linked, so that a
group of n classes yields fewer than n links for each block. It is found by a
search from class to class that looks only at classes not reached yet; common
shingles are counted along postings, so that memory grows with the shingles of
a block and not with its pairs. Large buckets and groups are dealt to tasks as
pairs of blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import partitions, settle
from quarry.llm.components import components

ROWS, MISS, BITS = 5, 1e-6, 256
#: Classes of a bucket, and shingles of a candidate group, that one block holds; a class counts as so many shingles at least.
BUCKET_BLOCK, GROUP_BLOCK, LEAST_WEIGHT = 8_192, 200_000, 24
#: Keys of up to this many bytes are broadcast to the second scan of the texts; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
SEED = 0x9E3779B97F4A7C15


def bands(least: float, rows: int = ROWS, miss: float = MISS) -> int:
    """So many bands that a pair of similarity `least` shares none with a chance of `miss` only."""
    return math.ceil(math.log(miss) / math.log(1 - least**rows))


def most_differing(least: float, k: int, bits: int = BITS) -> int:
    """The most bits in which sketches of k samples differ for a pair that may still be as similar as `least`."""
    p = max(0.0, least - 5 * math.sqrt(least * (1 - least) / k))
    flips = 2 * k * (1 - p)
    expected = bits / 2 * (1 - (1 - 2 / bits) ** flips)
    return min(bits, math.ceil(expected + 5 * math.sqrt(expected * (1 - expected / bits))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles. Words are split at ASCII
    white space, A-Z in lower case; fewer words than `size`, but not none, are
    one shingle."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = _mix(out + h[i : len(h) - n + 1 + i] * np.uint64(2 * i + 1))
    return np.unique(out)


class Signer:
    """Keys, bands and odd sketches of sets; the functions follow from the numbers alone."""

    def __init__(self, n_bands: int, rows: int = ROWS, bits: int = BITS):
        self.n_bands, self.rows, self.bits, self.k = n_bands, rows, bits, n_bands * rows
        r = _mix(np.arange(1, 2 * self.k + 1, dtype=np.uint64) * np.uint64(SEED))
        self.a, self.b = (r[: self.k] | np.uint64(1))[:, None], r[self.k :][:, None]
        self.salt = np.arange(self.k, dtype=np.uint64) * np.uint64(SEED)

    def minima(self, s: np.ndarray) -> np.ndarray:
        out = np.full(self.k, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(s), 8_192):
            np.minimum(out, ((self.a * s[i : i + 8_192] + self.b) ^ (self.b >> np.uint64(7))).min(axis=1), out=out)
        return out

    def sign(self, s: np.ndarray) -> tuple[bytes, list[int], bytes]:
        m = self.minima(s)
        lows = [xxhash.xxh3_64_intdigest(m[i : i + self.rows].tobytes(), seed=i) - (1 << 63) for i in range(0, self.k, self.rows)]
        parity = np.bincount((_mix(m + self.salt) % np.uint64(self.bits)).astype(np.int64), minlength=self.bits) & 1
        return xxhash.xxh3_128_digest(s.tobytes()), lows, np.packbits(parity.astype(np.uint8)).tobytes()


def spanning(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that join the places 0..n-1 as all links do: fewer than n. `linked(x, rest)` marks those of `rest` that x is linked with."""
    found: list[tuple[int, int]] = []
    rest = np.arange(n)
    while len(rest) > 1:
        reached, rest = [int(rest[0])], rest[1:]
        while reached and len(rest):
            x = reached.pop()
            hit = linked(x, rest)
            near = rest[hit].tolist()
            if near:
                found += [(x, y) for y in near]
                reached += near
                rest = rest[~hit]
    return found


def _sign(size: int, n_bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(n_bands)
        for b in batches:
            n, keys, lows, sketches = [], [], [], []
            for text in b.column(1):
                s = shingles(text.as_py(), size)
                n.append(len(s))
                key, low, sketch = signer.sign(s) if len(s) else (None, None, None)
                keys.append(key)
                lows.append(low)
                sketches.append(sketch)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(lows, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], ["id", "hash", "n", "key", "bands", "sketch"])

    return run


def _blocks(rows: DataFrame, group: str, sizes: DataFrame, most: int) -> DataFrame:
    """Deal rows to pairs of blocks (i, j): groups whose size in `sizes` (group,
    size) is over `most` get several blocks, so that any two rows of a group
    meet in one pair. `mine` is the row's own block."""
    several = sizes.where(F.col("size") > most).select(group, F.ceil(F.col("size") / most).cast("int").alias("nb"))
    out = rows.join(several, group, "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    out = out.withColumn("mine", F.pmod(F.xxhash64("key"), F.col("nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    out = out.withColumn("_o", other)
    return out.withColumns({"i": F.least("mine", "_o"), "j": F.greatest("mine", "_o")}).drop("_o", "nb")


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of equal `by` columns, which stand together, as one batch each; single rows are left out."""
    rest: list[pa.RecordBatch] = []
    last = None

    def done() -> Iterator[pa.RecordBatch]:
        if sum(r.num_rows for r in rest) > 1:
            yield rest[0] if len(rest) == 1 else pa.Table.from_batches(rest).combine_chunks().to_batches()[0]

    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(b.schema.names.index(c)) for c in by]
        new = np.zeros(b.num_rows - 1, bool)
        for c in columns:
            codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            new |= codes[1:] != codes[:-1]
        starts = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for s, e in zip(starts, starts[1:]):
            key = tuple(c[s].as_py() for c in columns) if s == 0 or e == b.num_rows else None
            if s == 0 and key == last:
                rest.append(b.slice(s, e - s))
                continue
            if s == 0 or rest:
                yield from done()
                rest = []
            if e == b.num_rows:
                rest, last = [b.slice(s, e - s)], key
            elif e - s > 1:
                yield b.slice(s, e - s)
        if len(starts) > 2 or last is None:
            last = tuple(c[b.num_rows - 1].as_py() for c in columns)
    yield from done()


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], ["a", "b"])


def _by_sketch(num: int, den: int, most: int):
    """Candidates of each bucket: pairs of fitting sizes whose sketches differ in at most `most` bits, as a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[bytes, bytes]] = []
        for r in _runs(batches, ["bucket", "i", "j"]):
            keys = r.column(r.schema.names.index("key")).to_pylist()
            n = r.column(r.schema.names.index("n")).to_numpy()
            sketch = np.frombuffer(b"".join(r.column(r.schema.names.index("sketch")).to_pylist()), np.uint64).reshape(len(keys), -1)

            def near(x: int, rest: np.ndarray) -> np.ndarray:
                m = n[rest]
                differing = np.bitwise_count(sketch[rest] ^ sketch[x]).sum(axis=1, dtype=np.int64)
                return (differing <= most) & (np.minimum(m, n[x]) * den >= np.maximum(m, n[x]) * num)

            found += [(keys[x], keys[y]) for x, y in spanning(len(keys), near)]
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    return run


class Postings:
    """The sets of a block by element: how many elements does one set share with others?"""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.n = sets, len(sets)
        self._build(np.arange(self.n))

    def _build(self, rest: np.ndarray) -> None:
        """Keep postings of `rest` only."""
        self.size = len(rest)
        element = np.concatenate([self.sets[i] for i in rest])
        order = np.argsort(element, kind="stable")
        self.element, self.owner = element[order], np.repeat(rest, [len(self.sets[i]) for i in rest])[order]

    def common(self, x: int, rest: np.ndarray) -> np.ndarray:
        """How many elements each of `rest`, sets that are left of all earlier ones, shares with x."""
        if 2 * len(rest) < self.size:
            self._build(rest)
        low, high = (np.searchsorted(self.element, self.sets[x], side) for side in ("left", "right"))
        size = high - low
        place = np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)
        return np.bincount(self.owner[place], minlength=self.n)[rest]


def _by_sets(num: int, den: int):
    """Links of each candidate group, decided on the full sets, as a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _runs(batches, ["group", "i", "j"]):
            names = r.schema.names
            keys, mine = r.column(names.index("key")).to_pylist(), r.column(names.index("mine")).to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in r.column(names.index("shingles")).to_pylist()]
            n, postings = np.array([len(s) for s in sets]), Postings(sets)
            apart = r.column(names.index("i"))[0].as_py() != r.column(names.index("j"))[0].as_py()

            def linked(x: int, rest: np.ndarray) -> np.ndarray:
                both = postings.common(x, rest)
                link = den * both >= num * (n[x] + n[rest] - both)
                return link & (mine[rest] != mine[x]) if apart else link

            yield _edges([(keys[x], keys[y]) for x, y in spanning(len(keys), linked)])

    return run


def _sets(size: int):
    """(group, key, n, shingles) of the texts whose key is the wanted one, once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                group, key, n, found = [], [], [], []
                for g, k, text in zip(*(b.slice(at, 500).column(i).to_pylist() for i in range(3))):
                    if k in seen:
                        continue
                    s = shingles(text, size)
                    if len(s) and xxhash.xxh3_128_digest(s.tobytes()) == k:
                        seen.add(k)
                        group.append(g)
                        key.append(k)
                        n.append(len(s))
                        found.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.binary()), pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(found, pa.binary())], ["group", "key", "n", "shingles"])

    return run


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept, text_hash) for every row of `docs`.

    Two documents are linked if den * (common shingles) >= num * (shingles of
    either). `component_id` is the least id that links reach, the document's
    own included; `kept` tells whether that is its own id. `text_hash` is the
    xxhash64 of the text. A text without words
    (or null) has no shingles and is linked with nothing. Rows of one id and
    different texts are linked through their texts only. A row without an id
    takes part; it is kept only if no id is in its component, and then all such
    rows are. No other column is read.
    """
    spark = docs.sparkSession
    n_tasks = partitions(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    least = num / den
    n_bands = bands(least)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hashed = texts.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    signed = settle(hashed.mapInArrow(_sign(size, n_bands), f"id {kind}, hash long, n long, key binary, bands array<bigint>, sketch binary"))
    classes = settle(signed.where("key is not null").groupBy("key").agg(F.min("id").alias("rep"), F.min(F.struct("id", "hash")).alias("own"), F.count("*").alias("copies"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")))

    rows = classes.select(F.explode("bands").alias("bucket"), "key", "n", "sketch")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size"))
    dealt = _blocks(rows, "bucket", shared, BUCKET_BLOCK).drop("mine")
    near = dealt.repartition(n_tasks, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(_by_sketch(num, den, most_differing(least, n_bands * ROWS)), "a binary, b binary")
    groups = settle(components(near).withColumnsRenamed({"node": "key", "root": "group"}))

    wanted = settle(groups.join(classes.select("key", "own", "n"), "key"))
    small = wanted.count() * 96 <= BROADCAST_BYTES
    # One row of each class gives its set: the least, by id and text. Rows of one id, or of none, are told apart by the text.
    picked = wanted.select("group", "key", F.col("own.id").alias("_id"), F.col("own.hash").alias("_hash"))
    own = hashed["id"].eqNullSafe(picked["_id"]) & (hashed["hash"] == picked["_hash"])
    sets = hashed.join(F.broadcast(picked) if small else picked, own).select("group", "key", "text").mapInArrow(_sets(size), "group binary, key binary, n long, shingles binary")
    sizes = wanted.groupBy("group").agg(F.sum(F.greatest("n", F.lit(LEAST_WEIGHT))).alias("size"))
    dealt = _blocks(sets, "group", sizes, GROUP_BLOCK)
    links = dealt.repartition(n_tasks, "group", "i", "j").sortWithinPartitions("group", "i", "j").mapInArrow(_by_sets(num, den), "a binary, b binary")
    roots = components(links)

    linked = classes.select("key", "rep").join(roots.withColumnRenamed("node", "key"), "key")
    lowest = linked.groupBy("root").agg(F.min("rep").alias("component"))
    linked = linked.join(lowest, "root").select("key", "component")
    # Classes of one row that nothing is linked with need no look-up.
    alone = classes.where("copies > 1").select("key", F.col("rep").alias("component")).join(linked.select("key"), "key", "left_anti")
    known = linked.unionByName(alone)
    out = signed.select("id", "hash", "n", "key").join(known.withColumn("_known", F.lit(True)), "key", "left")
    component = F.when(F.col("_known"), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), F.col("hash").alias("text_hash"))
