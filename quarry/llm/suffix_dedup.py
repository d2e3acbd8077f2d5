"""Suffix-array dedup: bytes that a long string covers which also starts earlier.

To find repeated strings of `length` bytes over the whole corpus, suffixes need
be sorted only where strings can repeat. Every such string has a least hash
among its short substrings, its anchor; equal strings have equal anchors.
Consecutive strings of one anchor make a stretch of a document.

1. Stretches are dealt by anchor. A stretch whose bytes occur before, by a
   128-bit hash besides the anchor, is covered whole. An anchor with one stretch
   only is done.
2. The first stretches of anchors with several different ones are put together
   into shards, by anchor, and the suffixes of a shard are sorted with their
   common prefixes by external induced sorting. In each run of suffixes that
   share `length` bytes all but the earliest string repeat.
3. An anchor whose stretches are more than a share of a shard is dealt by a
   second key that equal strings have in common: a 128-bit hash of the string.
   All but the earliest string of each hash repeat; those that a task has met
   before are told there.
4. The covered bytes of each document are joined with its text and removed.

Steps 2 to 4 read one shuffle of the texts.

A corpus has as many shards as its stretches have bytes for. A shard may be
larger than memory: its text, its rows and all that the sort holds go to files
of the task beyond a budget. Rows of an anchor are else only streamed in order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import partitions, settle
from quarry.llm.induced_sorting import BUDGET, PAD, Spool, Text, powers, sorted_suffixes

#: Bytes of the substrings that anchors are chosen among, and of the segments in which long texts are read.
ANCHOR, SEGMENT = 24, 1 << 18
BASE = 0xD6E8FEB86659FD93
#: Bytes of a shard, about, and of the stretches of one anchor beyond which its strings are dealt one by one.
SHARD_BYTES, HOT_BYTES = 16 << 20, 2 << 20
#: Anchors of up to this many bytes are broadcast; more are joined. Strings that go on at once, and that a task remembers.
BROADCAST_BYTES, STRINGS, MET = 32 << 20, 1 << 16, 1 << 17


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class Anchors:
    """Stretches of equal anchors of a text."""

    def __init__(self, length: int):
        self.length, self.size = length, min(ANCHOR, length)
        self.width = length - self.size + 1
        n = SEGMENT + length + 1
        self.up, self.down = powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)

    def stretches(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each segment: anchors, first string, number of strings, and whether the anchor occurs in the stretch again."""
        for at in range(0, max(0, len(text) - self.length + 1), SEGMENT):
            a = np.frombuffer(text, np.uint8, min(SEGMENT + self.length - 1, len(text) - at), at)
            sums = np.zeros(len(a) + 1, np.uint64)
            np.cumsum(a * self.up[: len(a)], out=sums[1:])
            v = _mixed((sums[self.size :] - sums[: -self.size]) * self.down[: len(a) - self.size + 1])
            m, size = v, 1
            while 2 * size <= self.width:
                m, size = np.minimum(m[:-size], m[size:]), 2 * size
            if size < self.width:
                m = np.minimum(m[: size - self.width], m[self.width - size :])
            start = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
            n = np.diff(np.append(start, len(m)))
            g, wide = m[start], n + self.width - 1
            begin = np.cumsum(np.append(0, wide[:-1]))
            place = np.arange(wide.sum()) + np.repeat(start - begin, wide)
            again = np.add.reduceat((v[place] == np.repeat(g, wide)).astype(np.int32), begin) > 1
            yield g.view(np.int64), start + at, n, again


def _stretches(length: int, key_type: pa.DataType):
    """(anchor, content, check, key, start, n, again) of every document; content and check are a hash of the stretch's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, h = Anchors(length), xxhash.xxh3_128_digest
        for b in batches:
            for low in range(0, b.num_rows, 500):
                part = b.slice(low, 500)
                found, content, rows = [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    text = text.encode()
                    for g, start, n, again in anchors.stretches(text):
                        found.append((g, start, n, again))
                        content += [h(text[x : x + y]) for x, y in zip(start.tolist(), (n + length - 1).tolist())]
                        rows += [i] * len(g)
                if rows:
                    g, start, n, again = (np.concatenate(x) for x in zip(*found))
                    key, halves = part.column(0).take(pa.array(rows)), np.frombuffer(b"".join(content), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(halves[:, 0]), pa.array(halves[:, 1]), key.cast(key_type), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(again)], ["anchor", "content", "check", "key", "start", "n", "again"])

    return run


def _sift(length: int):
    """Over stretches sorted by anchor, content, check, key and start: those whose
    content came before are covered (`sort` false); the first of each content
    must be sorted if its anchor has other contents or occurs in it again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the first stretch of the anchor in hand, as long as it has one content
        last = (None, None, None)  # anchor, content and check of the row before
        for b in batches:
            if not b.num_rows:
                continue
            anchor, content, check, again = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 6))
            new_anchor = np.append(anchor[0] != last[0], anchor[1:] != anchor[:-1])
            new = new_anchor | np.append(content[0] != last[1], content[1:] != content[:-1]) | np.append(check[0] != last[2], check[1:] != check[:-1])
            group = np.cumsum(new_anchor)  # 0: the anchor in hand before this batch
            contents = np.bincount(group, weights=new).astype(np.int64)
            contents = np.append(contents, np.zeros(max(0, group[-1] + 1 - len(contents)), np.int64))
            # The anchor in hand goes on in this batch with another content.
            many = contents > 1
            many[0] = contents[0] > 0
            final = group[-1]
            sort = new & (many[group] | again)
            out = []
            if held is not None and group[0] == 0 and many[0]:
                out.append(held)
                held = None
            if group[0] > 0 or final > 0:
                held = None
            # The last anchor may go on: keep its only first stretch in hand.
            if final > 0 and contents[final] == 1:
                i = int(np.flatnonzero(new & (group == final))[0])
                held = None if sort[i] else b.slice(i, 1)
            covered = np.flatnonzero(~new)
            for rows, flag in ((np.flatnonzero(sort), True), (covered, False)):
                if len(rows):
                    out.append((b.take(pa.array(rows)), flag))
            for x in out:
                x, flag = x if isinstance(x, tuple) else (x, True)
                yield pa.RecordBatch.from_arrays([x.column(0), x.column(3), x.column(4), x.column(5), pa.array(np.full(x.num_rows, flag))], ["anchor", "key", "start", "n", "sort"])
            last = (anchor[-1], content[-1], check[-1])

    return run


def _cut(length: int):
    """The bytes of stretches to be sorted, from each document's text and list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 200):
                part = b.slice(low, 200)
                row, anchor, start, n, found = [], [], [], [], []
                for i, (text, wanted) in enumerate(zip(part.column(1), part.column(2).to_pylist())):
                    if wanted:
                        text = text.as_py().encode()
                        for x in wanted:
                            row.append(i)
                            anchor.append(x["anchor"])
                            start.append(x["start"])
                            n.append(x["n"])
                            found.append(text[x["start"] : x["start"] + x["n"] + length - 1])
                yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), part.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(found, pa.binary())], ["anchor", "key", "start", "n", "bytes"])

    return run


def _strings(length: int, key_type: pa.DataType):
    """(n, content, check, key, start) of the strings of the wanted stretches; content and check are a hash of a string's bytes.

    A string that the task has not met, at an earlier place, has n 0. Others are
    covered: n of them from `start` on are one row, and content deals these rows evenly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, met, dealt = xxhash.xxh3_128_digest, {}, 0
        rows, digests, starts, ns = [], [], [], []

        def batch(keys: pa.Array) -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            columns = [pa.array(ns, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), keys.take(pa.array(rows, pa.int64())).cast(key_type), pa.array(starts, pa.int32())]
            for x in (rows, digests, starts, ns):
                x.clear()
            return pa.RecordBatch.from_arrays(columns, ["n", "content", "check", "key", "start"])

        for b in batches:
            for i, (key, text, wanted) in enumerate(zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist())):
                if not wanted:
                    continue
                text = text.as_py().encode()
                for x in sorted((x["start"], x["n"]) for x in wanted):
                    first, upto = x[0], x[0] + x[1]
                    run_end = -1  # where the covered strings in hand end
                    for at in range(first, upto):
                        digest, place = h(text[at : at + length]), (key, at)
                        before = met.get(digest)
                        if before is not None and before < place:
                            if run_end == at:
                                ns[-1] += 1
                            else:
                                dealt += 1
                                rows.append(i)
                                digests.append(h(dealt.to_bytes(8, "little")))
                                starts.append(at)
                                ns.append(1)
                            run_end = at + 1
                        else:
                            if before is None and len(met) >= MET:
                                met.clear()
                            met[digest] = place
                            rows.append(i)
                            digests.append(digest)
                            starts.append(at)
                            ns.append(0)
                        if len(rows) >= STRINGS:
                            yield batch(b.column(0))
                            run_end = -1
            if rows:
                yield batch(b.column(0))

    return run


def _later_strings():
    """Covered stretches (key, start, n) from rows of `_strings` sorted by n, content, check, key and start: all but the first of each string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)  # content and check of the row before
        for b in batches:
            if not b.num_rows:
                continue
            n, content, check = (b.column(i).to_numpy() for i in (0, 1, 2))
            new = np.append(content[0] != last[0], content[1:] != content[:-1]) | np.append(check[0] != last[1], check[1:] != check[:-1])
            covered = pa.array(np.flatnonzero((n > 0) | ~new))
            last = (content[-1], check[-1])
            if len(covered):
                yield pa.RecordBatch.from_arrays([b.column(3).take(covered), b.column(4).take(covered), pa.array(np.maximum(n, 1)).take(covered)], ["key", "start", "n"])

    return run


def repeated(text: Text, length: int, spool: Spool, budget: int = BUDGET) -> np.ndarray:
    """At which places of `text` a string starts whose `length` characters also start before."""
    out = spool.array(text.n, bool)
    least = None  # the earliest place of the run in hand
    for place, lcp in sorted_suffixes(text, length, budget):
        new = lcp < length
        if least is not None:
            place, new = np.append(least, place), np.append(True, new)
        else:
            new[0] = True
        start = np.flatnonzero(new)
        first = np.minimum.reduceat(place, start)
        run = np.cumsum(new) - 1
        out[place[place != first[run]]] = True
        least = first[-1]
    return out


#: Characters of a shard are bytes plus one; UTF-8 has none above 0xF4. A zero ends each stretch.
_plus_one = bytes((i + 1) % 256 for i in range(256))


class Shard:
    """The stretches of a shard in order: rows (key, start, n) and one text, both in files beyond what is held."""

    def __init__(self, batches: Iterator[pa.RecordBatch], held: int):
        self.rows = tempfile.SpooledTemporaryFile(held)
        self.file = tempfile.SpooledTemporaryFile(held)
        writer = None
        for b in batches:
            for low in range(0, b.num_rows, 1_000):
                part = b.slice(low, 1_000)
                rows = part.select(["key", "start", "n"])
                writer = writer or pa.ipc.new_stream(self.rows, rows.schema)
                writer.write_batch(rows)
                for x in part.column(part.schema.names.index("bytes")):
                    self.file.write(x.as_py().translate(_plus_one))
                    self.file.write(b"\0")
        self.empty = writer is None
        if writer is not None:
            writer.close()
        self.file.write(bytes(PAD))
        size = self.file.tell()
        self.file.seek(0)
        self.text = Text(np.frombuffer(self.file.read(), np.uint8) if size <= held else np.memmap(self.file, np.uint8, "r", shape=(size,)))

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        self.rows.seek(0)
        yield from pa.ipc.open_stream(self.rows)


def _sort_shard(length: int, budget: int = BUDGET):
    """Covered stretches (key, start, n) of a shard whose rows come by key and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(batches, budget // 4)
        if shard.empty:
            return
        hits, at = repeated(shard.text, length, Spool(budget // 4), budget // 2), 0
        for rows in shard:
            n, start = rows.column("n").to_numpy(), rows.column("start").to_numpy()
            size = n.astype(np.int64) + length
            begin = np.cumsum(size) - size
            hit = np.array(hits[at : at + size.sum()])
            at += len(hit)
            owner = np.repeat(np.arange(len(n)), size)
            offset = np.arange(len(hit)) - begin[owner]
            hit &= offset < n[owner]
            edge = hit & ~(np.append(False, hit[:-1]) & np.append(False, owner[1:] == owner[:-1]))
            first = np.flatnonzero(edge)
            if len(first):
                count = np.add.reduceat(hit, first)
                row = owner[first]
                yield pa.RecordBatch.from_arrays([rows.column("key").take(pa.array(row)), pa.array((start[row] + offset[first]).astype(np.int32)), pa.array(np.asarray(count).astype(np.int32))], ["key", "start", "n"])

    return run


def _remove(length: int):
    """(n_bytes, spans, kept) from each text and its covered stretches."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 200):
                part = b.slice(low, 200)
                size, spans, kept = [], [], []
                for text, covered in zip(part.column(1), part.column(2).to_pylist()):
                    text = text.as_py().encode()
                    runs: list[dict[str, int]] = []
                    for x in sorted((c["start"], c["start"] + c["n"] + length - 1) for c in covered or ()):
                        if runs and x[0] <= runs[-1]["end"]:
                            runs[-1]["end"] = max(runs[-1]["end"], x[1])
                        else:
                            runs.append({"start": x[0], "end": x[1]})
                    ends = [0, *(r["end"] for r in runs)]
                    starts = [*(r["start"] for r in runs), len(text)]
                    size.append(len(text))
                    spans.append(runs)
                    kept.append(b"".join(text[x:y] for x, y in zip(ends, starts)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())], ["key", "n_bytes", "spans", "kept"])

    return run


def _ordered_key(i: Column, text: Column) -> Column:
    """Text that sorts by a whole number, nulls last, and then by a hash of `text`."""
    shifted = i.cast("decimal(38,0)") + F.lit("1" + "0" * 20).cast("decimal(38,0)")
    return F.concat_ws("|", F.coalesce(F.lpad(shifted.cast("string"), 40, "0"), F.lit("~")), F.sha2(text, 256))


def _with_wanted(dealt: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text, wanted) of every document, with the texts that are wanted only.

    An inner join would ask for keys that aren't null before the texts are dealt,
    and so deal them anew.
    """
    return dealt.join(wanted, "key", "left").select("key", F.when(F.col("wanted").isNotNull(), F.col("text")).alias("text"), "wanted")


def _repeated_strings(dealt: DataFrame, stretches: DataFrame, length: int, key_type: pa.DataType) -> DataFrame:
    """Covered stretches (key, start, n) of the strings of `stretches` that an earlier one of them equals.

    A task sends a string once as long as it remembers it, so that one that many
    documents share sends a row for each task, not for each place. Nothing is
    settled: the texts are those that `dealt` sends in the job that reads the result.
    """
    key, n_tasks = dealt.schema["key"].dataType.simpleString(), partitions(dealt.sparkSession)
    wanted = stretches.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("wanted"))
    strings = _with_wanted(dealt, wanted).mapInArrow(_strings(length, key_type), f"n int, content long, check long, key {key}, start int")
    hit = strings.repartition(n_tasks, "content").sortWithinPartitions("n", "content", "check", "key", "start").mapInArrow(_later_strings(), f"key {key}, start int, n int")
    # Strings that follow one another make one stretch.
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    run = F.col("start") - F.coalesce(F.sum("n").over(before), F.lit(0))
    return hit.withColumn("run", run).groupBy("key", "run").agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n")).drop("run")


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept) for every row: the disjoint runs (start, end)
    of bytes that a string of `length` bytes covers which also starts earlier,
    and the bytes that are left.

    Earlier means a smaller id, or an earlier start in the same text; strings
    lie within one text and are judged on the input. Null texts count as empty.
    Rows of the same id and text count as one document and get the same result;
    of the same id and different texts, the one of the lesser hash comes first.
    Null ids come last. Other columns are not read. `length` is 2 to 65,535.
    """
    if not 1 < length < 1 << 16:
        raise ValueError(f"length {length}")
    spark = docs.sparkSession
    n_tasks = partitions(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows, ids = texts.agg(F.count("*"), F.count_distinct("key")).first()
    plain = rows == ids and kind in ("tinyint", "smallint", "int", "bigint")
    if not plain:
        # A key that sorts as id and hash do; rows of equal keys are equal.
        ids = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        ids = ids.withColumn("key", _ordered_key(F.col("id"), F.col("text")))
        texts = ids.select("key", "text")
        ids = ids.select("id", "key")
        texts = texts.dropDuplicates(["key"])
    key = texts.schema["key"].dataType.simpleString()
    key_type = pa.string() if key == "string" else {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32()}.get(key, pa.int64())

    found = texts.mapInArrow(_stretches(length, key_type), f"anchor long, content long, check long, key {key}, start int, n int, again boolean")
    sifted = found.repartition(n_tasks, "anchor").sortWithinPartitions("anchor", "content", "check", "key", "start").mapInArrow(_sift(length), f"anchor long, key {key}, start int, n int, sort boolean")
    sifted = settle(sifted)

    # All joins below read this one shuffle of the texts.
    dealt = texts.repartition(n_tasks, "key")
    to_sort, size = sifted.where("sort"), F.sum(F.col("n").cast("long") + length - 1)
    n_shards = max(n_tasks, -(-(to_sort.agg(size).first()[0] or 0) // SHARD_BYTES))
    hot = settle(to_sort.groupBy("anchor").agg(size.alias("bytes")).where(F.col("bytes") > HOT_BYTES).select("anchor"))
    n_hot = hot.count()
    covered = sifted.where("not sort").select("key", "start", "n")
    if n_hot:
        hot = F.broadcast(hot) if n_hot * 64 <= BROADCAST_BYTES else hot
        covered = covered.unionByName(_repeated_strings(dealt, to_sort.join(hot, "anchor", "left_semi"), length, key_type))
        to_sort = to_sort.join(hot, "anchor", "left_anti")
    wanted = to_sort.groupBy("key").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("wanted"))
    cut = _with_wanted(dealt, wanted).mapInArrow(_cut(length), f"anchor long, key {key}, start int, n int, bytes binary")
    shards = cut.repartition(n_shards, "anchor").sortWithinPartitions("key", "start").mapInArrow(_sort_shard(length), f"key {key}, start int, n int")
    covered = covered.unionByName(shards)
    covered = covered.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("covered"))
    out = dealt.join(covered, "key", "left").select("key", "text", "covered").mapInArrow(_remove(length), f"key {key}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
    if plain:
        return out.withColumnRenamed("key", id_col)
    return ids.join(out, "key").select(F.col("id").alias(id_col), "n_bytes", "spans", "kept")
