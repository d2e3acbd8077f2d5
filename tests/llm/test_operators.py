"""The operators on small tables with nulls, ties, repeated rows and odd texts."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import bpe, common, components, decontamination, fingerprints, html_extraction, near_dedup, quality, secrets, suffix_dedup, token_counts, url_filters
from quarry.operators import common as shared

PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Columns whose names clash with those that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, h long, id string, n int, spans string, _text string"


def table(spark, rows):
    """Documents from (doc_id, text[, source])."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "k", 1, "i", 2, "x", "t") for r in rows], SCHEMA).repartition(3)


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


LONG = " ".join(f"word{i}" for i in range(3000))
ROWS = [(1, "Hello big World"), (2, None), (3, ""), (4, " \n"), (None, "hello big world"), (5, LONG), (6, LONG), (6, LONG), (7, LONG + " end"), (None, None)]


def brute_components(rows, size, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def test_near_duplicates_of_odd_rows(spark):
    out = near_dedup.near_duplicates(table(spark, ROWS), size=3, num=85, den=100)
    assert got(out, "doc_id", "n_shingles", "component_id", "kept") == brute_components(ROWS, 3, 85, 100)
    assert near_dedup.near_duplicates(table(spark, ROWS).limit(0)).count() == 0


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", 4)
    monkeypatch.setattr(near_dedup, "GROUP_BLOCK", 300)
    r = random.Random(1)
    base = [[f"w{r.randint(0, 400)}" for _ in range(90)] for _ in range(6)]
    rows = []
    for i in range(160):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 3, 4, 8, 20])):
            w[r.randrange(len(w))] = f"x{r.randint(0, 50)}"
        rows.append((i, " ".join(w)))
    for size, num in ((3, 85), (5, 80)):
        out = near_dedup.near_duplicates(table(spark, rows), size=size, num=num, den=100)
        assert got(out, "doc_id", "n_shingles", "component_id", "kept") == brute_components(rows, size, num, 100)


def test_components_of_paths_and_circles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (102, 102), (100, 101), (None, 5)]
    out = components.components(spark.createDataFrame(links, "a long, b long"))
    assert got(out, "node", "root") == sorted([(i, 0) for i in range(41)] + [(i, 100) for i in (100, 101, 102)], key=repr)


def test_components_split_hubs(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB", 3)
    r = random.Random(3)
    links = [(0, i) for i in range(1, 30)] + [(99, i) for i in range(40, 60)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(60)]
    up = {x: x for e in links for x in e}
    for _ in up:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    loops = {x for x in up if all(a == b for a, b in links if x in (a, b))}
    out = components.components(spark.createDataFrame(links, "a long, b long"))
    assert got(out, "node", "root") == sorted(((x, y) for x, y in up.items() if x not in loops), key=repr)


def test_near_copies_without_ids_meet_their_own_class_only(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, f"{words} n{i % 100}") for i in range(400)] + [(7, f"{words} n5")] * 3
    docs = table(spark, rows)
    out = got(near_dedup.near_duplicates(docs, size=3, num=85, den=100), "doc_id", "component_id", "kept")
    assert out == sorted([(None, 7, False)] * 400 + [(7, 7, True)] * 3, key=repr)


def test_fingerprints_of_odd_rows(spark):
    out = {(r[0], r[1]) for r in fingerprints.fingerprint(table(spark, ROWS)).select("fingerprint", "n_same").collect()}
    assert sorted(n for _, n in out) == [1, 2, 3, 4]
    assert fingerprints.fingerprint(table(spark, ROWS).limit(0)).count() == 0


MANY = [(None, f"text {i % 40} é") for i in range(150)] + [(7, f"text {i % 30}") for i in range(200)] + [(i, f"t{i}") for i in range(60)] + [(None, "copy")] * 90


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], [(i, f"text {i % 5} é") for i in range(300)], [(None, None)], [], MANY, MANY[:150], [(7, "same")] * 50])
def test_fingerprints_with_the_next_document(spark, rows):
    df = table(spark, rows) if rows else table(spark, ROWS).limit(0)
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1] or "")))
    want = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        e = fingerprints.edit(t, nxt)
        form, edited, other = (fingerprints.canonical(x) for x in (t, e, nxt))
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprints.digest(form), fingerprints.digest(edited), float(form == edited), float(form == other)))
    out = fingerprints.with_next(df)
    assert got(out, "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == sorted(want, key=repr)


def test_a_clash_of_hashes_is_found_by_bytes(spark):
    texts = spark.createDataFrame([("a",), ("A",), ("b",)], "text string")
    assert fingerprints.clash(texts, texts.selectExpr("'same' as fingerprint")) is False  # real digests don't clash
    # A hash of one character: forms that share it are told apart by the wide digest.
    weak = lambda form: hashlib.md5(form).hexdigest()[0]
    rows = [(i, f"Text {i % 30}") for i in range(60)]
    found = {r.doc_id: (r.fingerprint, r.n_same) for r in fingerprints.fingerprint(table(spark, rows), narrow=weak).collect()}
    assert all(n == 2 and found[i][0] == found[(i + 30) % 60][0] and len(f) == 65 for i, (f, n) in found.items()) and len({f for f, _ in found.values()}) == 30
    out = {r.doc_id: r.fingerprint for r in fingerprints.with_next(table(spark, rows), narrow=weak).collect()}
    assert out == {i: f for i, (f, _) in found.items()}
    same = fingerprints.fingerprint(table(spark, rows[:1] * 3), narrow=weak).collect()
    assert [len(r.fingerprint) for r in same] == [1, 1, 1]  # equal bytes are no clash


def test_ranges_share_out_hot_and_missing_ids():
    ranges = fingerprints.Ranges.of([3, 5, 5, 5, 9], 4)
    hashes = [-(1 << 63), -1, 0, (1 << 63) - 1]
    assert [ranges.part(x, 0) for x in (10, 9, 6, 4, 3, 1)] == [0, 1, 1, 5, 6, 6]
    assert [ranges.part(5, h) for h in hashes] == [2, 3, 3, 4] and [ranges.part(None, h) for h in hashes] == [7, 8, 9, 10]
    assert not fingerprints.Ranges.of([1, 2], 0).by_hash and fingerprints.Ranges.of([1, 1], 0).by_hash


def brute_repeats(rows, length):
    seen, out = set(), []
    order = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    for d, t in order:
        b = t.encode()
        hit = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                hit[p : p + length] = b"\1" * length
            seen.add(w)
        runs, p = [], 0
        while p < len(b):
            q = p
            while q < len(b) and hit[q]:
                q += 1
            if q > p:
                runs.append((p, q))
            p = max(q, p + 1)
        out.append((d, t, len(b), runs, bytes(x for x, h in zip(b, hit) if not h)))
    known = {(d, t): (d, *more) for d, t, *more in out}
    return sorted((known[d, t or ""] for d, t in rows), key=repr)


def test_repeats_of_odd_rows(spark):
    for rows in (ROWS, [(i, t) for i, (_, t) in enumerate(ROWS)]):
        out = suffix_dedup.remove_repeats(table(spark, rows), length=40)
        assert sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in out.collect()), key=repr) == brute_repeats(rows, 40)
    assert suffix_dedup.remove_repeats(table(spark, ROWS).limit(0)).count() == 0


def test_repeats_against_all_strings(spark):
    r = random.Random(2)
    base = ["".join(r.choice("ab é") for _ in range(60)) for _ in range(4)]
    rows = [(i, "".join(r.choice(base)[r.randint(0, 30) :] if r.random() < 0.7 else r.choice("ab") * r.randint(1, 150) for _ in range(r.randint(0, 6)))) for i in range(60)]
    out = suffix_dedup.remove_repeats(table(spark, rows), length=30)
    assert sorted(((x.doc_id, x.n_bytes, [tuple(s) for s in x.spans], bytes(x.kept)) for x in out.collect()), key=repr) == brute_repeats(rows, 30)


def test_an_anchor_that_many_documents_share_is_split(spark, monkeypatch):
    r = random.Random(8)
    word = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    line, ends = word(50), [word(70) for _ in range(6)]
    rows = [(i, word(90) + line + (r.choice(ends) if i % 2 else word(70))) for i in range(80)] + [(100, "ab" * 400), (101, "x" + "ab" * 300), (102, word(300))]
    bound, sort_shard = 3000, suffix_dedup._sort_shard

    def bounded(length):
        run = sort_shard(length)

        def counted(batches):
            held = [b for b in batches]
            size = sum(len(x) for b in held for x in b.column(4).to_pylist())
            assert size <= bound, size
            return run(iter(held))

        return counted

    monkeypatch.setattr(suffix_dedup, "_sort_shard", bounded)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 800, raising=False)
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 500, raising=False)
    out = suffix_dedup.remove_repeats(table(spark, rows), length=100)
    assert sorted((x.doc_id, x.n_bytes, [tuple(s) for s in x.spans], bytes(x.kept)) for x in out.collect()) == sorted(brute_repeats(rows, 100))


def test_hot_anchors_share_the_shuffle_of_the_texts(spark, monkeypatch):
    """The input is read three times, hot anchors or not: to count its ids, to find stretches and to deal the texts."""
    r = random.Random(12)
    word = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    line, ends = word(60), [word(70) for _ in range(4)]
    rows = [(i, word(90) + line + r.choice(ends)) for i in range(50)] + [(50, "no"), (51, None)]
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 500)
    strings, hot = suffix_dedup._repeated_strings, []
    monkeypatch.setattr(suffix_dedup, "_repeated_strings", lambda *args: hot.append(1) or strings(*args))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(counted, "doc_id long, text string")
    found = sorted((x.doc_id, x.n_bytes, [tuple(s) for s in x.spans], bytes(x.kept)) for x in suffix_dedup.remove_repeats(docs, length=100).collect())
    assert found == sorted(brute_repeats(rows, 100)) and hot and read.value == 3 * len(rows)


def test_contamination_in_blocks(spark):
    items = spark.createDataFrame([(1, "one two three"), (2, " ".join(f"w{i}" for i in range(15))), (3, ""), (None, "x y"), (4, None), (10, "One, two; THREE")], "item_id long, text string")
    rows = [(1, "zero ONE-two three four"), (2, None), (3, ""), (4, " ".join(f"w{i}" for i in range(2, 13)) + " one two three"), (None, "one two"), (5, "w0 w1 w2")]
    for size in (1 << 20, 20):  # one block; several
        out = decontamination.contamination(table(spark, rows), items, block_bytes=size)
        found = {r.doc_id: (r.n_words, r.n_hit, r["items"], [tuple(s) for s in r["spans"]]) for r in out.collect()}
        assert found == {1: (5, 3, ["1", "10"], [(1, 4)]), 2: (0, 0, [], []), 3: (0, 0, [], []), 4: (14, 14, ["1", "10", "2"], [(0, 14)]), None: (2, 0, [], []), 5: (3, 0, [], [])}
    assert {r.n_hit for r in decontamination.contamination(table(spark, rows), items.limit(0)).collect()} == {0}


def test_main_text_of_pages(spark):
    page = "<nav>Menu</nav><div><h2>Top story</h2><p>Body {0} of {0}</p></div><div>Ring 555 now</div><p>{1}</p>"
    rows = [(i, f"http://h.example/{i}", page.format(f"x{i}", f"tail{i}"), 1) for i in range(6)] + [(None, None, None, 1), (9, "http://a", "<article>A &amp; b</article>", 1), (9, "http://a", "<article>A &amp; b</article>", 1)]
    out = html_extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host int").repartition(3))
    found = got(out, "page_id", "text")
    assert found == sorted([(i, f"Body x{i} of x{i}\ntail{i}") for i in range(6)] + [(None, ""), (9, "A & b"), (9, "A & b")], key=repr)


def test_template_cleans_articles_but_not_by_copies(spark):
    page = "<nav>Menu</nav><article><h1>Head {0}</h1><p>Send this to a friend</p><p>Story {0}</p></article>"
    copy = "<article><h1>One</h1><p>Two</p><p>Three {0}</p></article>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(6)] + [(10 + i, f"http://c.example/{i}", copy.format(i // 3)) for i in range(4)]
    out = html_extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    assert got(out, "page_id", "text") == sorted([(i, f"Head {i}\nStory {i}") for i in range(6)] + [(10 + i, f"One\nTwo\nThree {i // 3}") for i in range(4)], key=repr)


def test_templates_are_the_classes_of_equal_occurrence_vectors(spark):
    """Against a plain deduction: vectors as sets of (page, count), the main element by depth among those of over half the text."""
    pages = {r.html: html_extraction_host(r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = [(h, p) for p, h in pages.items()] + [(h, p) for p, h in list(pages.items())[:40]]  # copies count once
    df = spark.createDataFrame(rows, "host string, html string").select("host", F.xxhash64("html").alias("row"), "html").repartition(3)
    found = {r.host: ({frozenset(c.tokens) for c in r.template}, r.main) for r in html_extraction.templates(df).collect()}
    want = {}
    for host in set(pages.values()):
        own = [html_extraction.counts(p) for p, h in pages.items() if h == host]
        vectors = {}
        for i, c in enumerate(own):
            for k, (n, _, _) in c.items():
                vectors.setdefault(k, []).append((i, n))
        classes = {}
        for k, v in vectors.items():
            if len(v) >= max(3, 0.6 * len(own)):
                classes.setdefault(tuple(v), []).append(k)
        classes = [v for v in classes.values() if len(v) >= 3]
        if classes:
            mass = {k: sum(c[k][1] for c in own if k in c) for v in classes for k in v}
            depth = {k: max(c[k][2] for c in own if k in c) for k in mass}
            total = max(m for k, m in mass.items() if depth[k] >= 0)
            large = [(depth[k], mass[k], k) for k in mass if depth[k] >= 0 and mass[k] > total / 2]
            want[host] = ({frozenset(v) for v in classes}, max(large)[2] if large else None)
    assert found == want and any(m for _, m in want.values())


def html_extraction_host(url):
    return url.split("://", 1)[1].split("/")[0].split("?")[0].split("#")[0].lower()


def test_the_template_finds_articles_without_their_marks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    marked = got(html_extraction.main_text(pages), "page_id", "text")
    bare = pages.withColumn("html", F.regexp_replace(F.regexp_replace("html", "<article>", "<div>"), "</article>", "</div>"))
    assert got(html_extraction.main_text(bare), "page_id", "text") == marked
    twice = got(html_extraction.main_text(pages.unionByName(pages)), "page_id", "text")
    assert twice == sorted(marked + marked, key=repr) and all(t for _, t in marked)


def test_quality_learns_from_its_fold_only(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("aeioutnrs") for _ in range(r.randint(2, 8)))
    vocabulary = [word() for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        rows.append((i, " ".join(r.choice(vocabulary) + ("" if good else "###%%") for _ in range(60))))
        labels.append((i, int(good) if zlib.crc32(str(i).encode()) % 4 != 2 else int(not good)))  # wrong where it mustn't be used
    docs = table(spark, [*rows, (None, None), (1000, ""), (1000, "")])
    model = quality.fit(docs, spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int"))
    scores = {x.doc_id: x.score for x in quality.score(docs, model).collect()}
    assert sum((scores[i] >= 0.7) == (i % 3 > 0) for i in range(600)) > 570
    assert all(0 <= s <= 1 for s in scores.values()) and scores[None] == scores[1000]
    # Text alone scores: the less of it, the nearer the share of label 1, on either side of it.
    model.open()
    share = 1 / (1 + np.exp(-model.prior))
    assert scores[None] == pytest.approx(share)
    for i in (3, 4):
        near = [abs(model.score(rows[i][1].encode()[:n]) - share) for n in (2, 40, 400)]
        assert near == sorted(near)
    # Half of the pieces are pieces of all of a long text.
    long = b"".join(b"%08d" % i for i in range(20_000))
    assert [int(x[:8]) // 1_000 for x in quality._pieces([long], 80_000)][:: 4] == [0, 2, 4, 6, 8, 10, 12, 14, 16, 18]
    assert quality._pieces([long, b"x"], 1 << 20)[-1] == b"x" and quality._pieces([], 0) == []
    flat = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert len({x.score for x in quality.score(docs, flat).collect()}) == 1


def test_tokens_of_odd_rows(spark):
    library = Tokenizer.from_file(PATH)
    ids = {t: library.encode(t or "", add_special_tokens=False).ids for _, t in ROWS}
    out = token_counts.token_counts(table(spark, ROWS), PATH, limit=5, chunk=200, overlap=5)
    assert got(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted([(d, len((t or "").encode()), len(ids[t]), len(ids[t]) > 5) for d, t in ROWS], key=repr)
    docs = table(spark, ROWS)
    out = bpe.encode(docs, PATH, bpe.build_lexicon(docs, PATH, n=10), decode=True)
    assert got(out, "doc_id", "ids", "decoded") == sorted([(d, ids[t], t or "") for d, t in ROWS], key=repr)
    back = bpe.decode_ids(out, PATH)
    assert got(back, "doc_id", "text") == sorted([(d, t or "") for d, t in ROWS], key=repr)
    assert bpe.build_lexicon(docs.limit(0), PATH) is None


def test_frequent_words_are_those_of_the_whole_corpus(spark):
    rows = [(i, "a a a b b c " + f"z{i}") for i in range(50)]
    assert bpe.frequent_words(table(spark, rows), 3) == ["a", "b", "c"]
    assert bpe.frequent_words(table(spark, rows), 5) == ["a", "b", "c", "z0", "z1"]
    assert bpe.frequent_words(table(spark, [(i, "漢" * 70 + " ab") for i in range(9)]), 5) == ["ab"]  # no whole texts on the driver


def test_secrets(spark):
    hexa, key, own = "0123456789abcdef" * 2, "AKIA" + "Z9" * 8, "ghp_Abc123Abc123Abc123Abc1"
    rows = [
        (1, f'é Password: "{hexa}" {own}', "s1"), (2, f"{key} and {key}0", "s1"), (3, f"api-key=abcdef apikey = abcdef! token=abc", "s2"), (4, None, None), (5, "", "s1"),
        (6, f"xx{hexa} ghp_Shared123Shared123Shared1", "s1"), (7, "ghp_Shared123Shared123Shared1", "s2"), (8, "AKIASHORT abcdef0123 secret:12345", "s1"), (None, f"{own}", "s1"), (None, f"{own}", "s1"),
    ]
    docs = table(spark, rows)
    out = secrets.scan(docs).select("doc_id", secrets.listed(F.col("base")).alias("base"), secrets.listed(F.col("spans")).alias("spans"))
    assert got(out, "doc_id", "base", "spans") == sorted([
        (1, "assign:2:45,hex:13:45", "assign:2:45,hex:13:45,owned:47:73"), (2, "access:0:20,access:25:46", "access:0:20,access:25:46"), (3, "assign:15:30", "assign:15:30"), (4, "", ""), (5, "", ""),
        (6, "hex:2:34", "hex:2:34"), (7, "", ""), (8, "", ""), (None, "", "owned:0:26"), (None, "", "owned:0:26"),
    ], key=repr)
    masked = {r.doc_id: r.text for r in secrets.redact(docs, keep=("lang",)).collect()}
    assert masked[1] == 'é [SECRET]" [SECRET]' and masked[2] == "[SECRET] and [SECRET]" and masked[4] is None and masked[7] == rows[6][1]


def test_secrets_are_judged_by_owners_and_repositories(spark):
    keys = [f"Key{i}Abc123Abc123Abc123Abc{i}" for i in range(4)]
    rows = [(i, f"x {keys[0]} y", f"s/{i}") for i in range(4)] + [(10 + i, f"x {keys[1]}", f"s/{i}") for i in range(3)] + [(20, keys[2], "s/1"), (21, keys[2], "t/1"), (22, "see/some/path-to-a-page-1234567890/ there", "s/1")]
    docs = table(spark, rows)
    out = secrets.scan(docs, repository=F.col("source"), owner=F.substring_index("source", "/", 1))
    assert {r.doc_id for r in out.where(F.size("spans") > 0).collect()} == {10, 11, 12}


@pytest.mark.parametrize("fold", [1, 3, 256])
def test_secrets_of_long_texts(spark, monkeypatch, fold):
    import re

    monkeypatch.setattr(secrets, "FOLD", fold)
    r = random.Random(fold)
    parts = ["é ", "token=abcdef1 ", "AKIA" + "Z" * 16 + " ", "0123456789abcdef01234567 ", "Xy1" * 9 + " ", "password: '0123456789abcdef0123456789'", "-"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.choice([0, 1, 5, 40, 400]))), "s") for i in range(30)]
    found = {x.doc_id: x for x in secrets.scan(table(spark, rows)).select("doc_id", secrets.listed(F.col("base")).alias("base"), secrets.listed(F.col("spans")).alias("spans")).collect()}
    hidden = {x.doc_id: x.text for x in secrets.redact(table(spark, rows)).collect()}
    owners = {}
    for i, text, _ in rows:
        base = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m.group(2)) >= 6]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
        wide = [(m.start(), 3, m.end()) for m in re.finditer("[A-Za-z0-9+/_-]+", text) if len(m.group()) >= 24 and all(re.search(p, m.group()) for p in ("[0-9]", "[a-z]", "[A-Z]")) and not any(s < m.end() and m.start() < e for s, _, e in base)]
        tell = lambda spans: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert found[i].base == tell(base) and found[i].spans == tell(base + wide)
        out, at = "", 0
        for s, _, e in sorted(base + wide):
            if s >= at:
                out += text[at:s] + "[SECRET]"
            at = max(at, e)
        assert hidden[i] == out + text[at:]


def test_a_long_text_of_secrets_takes_no_quadratic_time(spark):
    import time

    docs = table(spark, [(1, "token=abcdef1 Xy1Xy1Xy1Xy1Xy1Xy1Xy1Xy1Xy1 0123456789abcdef01234567 " * 20_000, "s")]).coalesce(1)
    began = time.time()
    assert secrets.redact(docs).first().text.count("[SECRET]") == 60_000
    assert time.time() - began < 60


def test_hot_keys_are_joined_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(shared, "HOT", 3)
    monkeypatch.setattr(shared, "SHARE", 10)
    rows = spark.createDataFrame([(i, "a" if i % 2 else f"k{i % 7}" if i % 3 else None) for i in range(60)], "i long, k string")
    known = spark.createDataFrame([("a", 1), ("k1", 2), ("k2", 3)], "k string, v long")
    out = common.join_hot(rows, known, ["k"])
    assert got(out, "i", "k", "v") == got(rows.join(known, "k", "left"), "i", "k", "v")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_url_filters(spark):
    rules = spark.createDataFrame([("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("example.com", "/en/7", "allow"), ("a.example.com", "", "block"), ("com", None, "block")], "host string, path string, verdict string")
    urls = ["http://EXAMPLE.com/en/7?x", "https://m.example.com/en/71#a", "http://a.example.com", "x://community/en/7", "http://other.com/en/7", "nothing", None, "http://com/en", "http://b.a.example.com/en/7", "http://example.com/en/7/x://y"]
    want = [
        ("example.com", "/en/7", "example.com/en/7", "allow"), ("m.example.com", "/en/71", "example.com/en/7", "allow"), ("a.example.com", "", "a.example.com", "block"), ("community", "/en/7", None, "allow"),
        ("other.com", "/en/7", "com/en/", "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("com", "/en", None, "allow"), ("b.a.example.com", "/en/7", "example.com/en/7", "allow"), ("example.com", "/en/7/x://y", "example.com/en/7", "allow"),
    ]
    pages = spark.createDataFrame([(i if u else None, u, "r", 0) for i, u in enumerate(urls * 2)], "page_id long, url string, rule string, kind int").repartition(3)
    out = url_filters.judge(pages, rules)
    assert got(out.withColumn("page_id", F.coalesce("page_id", F.lit(-1))), "host", "path", "rule", "verdict") == sorted(want * 2, key=repr)
    assert url_filters.judge(pages.limit(0), rules).count() == 0 and url_filters.judge(pages, rules.limit(0)).where("rule is not null").count() == 0


def test_hosts_of_very_many_labels(spark):
    """A host is looked up under as many suffixes as rules have numbers of labels, however long it is."""
    host = "a." * 200_000 + "example.com"
    pages = spark.createDataFrame([(1, f"http://{host}/x/y"), (2, "http://" + "." * 100_000), (3, "http://com/x")], "page_id long, url string")
    rules = spark.createDataFrame([("example.com", "/x", "block"), ("com", "/x", "allow"), ("a.example.com", "/z", "block")], "host string, path string, verdict string")
    assert sorted((r.page_id, r.rule, r.verdict) for r in url_filters.judge(pages, rules).collect()) == [(1, "example.com/x", "block"), (2, None, "allow"), (3, "com/x", "allow")]


HARD = (
    "<nav>Menu</nav><div class='ad'>Buy {0}</div>{1}<h1>Head {0}</h1><h2>Summary</h2><p>Story {0} that is long enough to be one</p>"
    "<p class='share-price'>Now {0}</p><div class='search-history'>Past {0}</div><p id='notice-period'>In {0}</p><p>By <b>Ann {0}</b></p>"
    "<p>Send this to a friend</p><div class='ad'>Inner {0}</div><h3>Related</h3><ul><li><a href=x>Link {0}</a></li><li><a href=y>More {0}</a></li></ul>"
    "<p>x <![CDATA[h&amp;<i]]> {0}</p>{2}<footer>Foot {0}</footer>"
)
PLAIN = "Head {0}\nSummary\nStory {0} that is long enough to be one\nNow {0}\nPast {0}\nIn {0}\nBy Ann {0}\nx h&amp;<i {0}"


def test_slots_are_decided_by_structure_and_not_by_words(spark):
    """Marks alone leave the inner advert, the links and the site's sentence in; words in classes would take three blocks of the article."""
    hosts = {"a": ("<article>", "</article>"), "b": ("<div>", "</div>"), "c": ("<main>", "</main>")}
    rows = [(10 * n + i, f"http://{h}.example/{i}", HARD.format(f"q{n}x{i}", *marks)) for n, (h, marks) in enumerate(hosts.items()) for i in range(6)]
    out = html_extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    assert got(out, "page_id", "text") == sorted([(10 * n + i, PLAIN.format(f"q{n}x{i}")) for n in range(3) for i in range(6)], key=repr)


def test_a_host_of_many_pages_is_joined_like_the_others(spark, monkeypatch):
    rows = [(i, f"http://h{int(i > 40)}.example/{i}", HARD.format(f"q{i}", "<article>", "</article>")) for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = got(html_extraction.main_text(pages), "page_id", "text")
    monkeypatch.setattr(html_extraction, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(html_extraction, "HOT_PAGES", 20)
    assert got(html_extraction.main_text(pages), "page_id", "text") == want and len(want) == 50
