"""Parts of the operators that need no Spark, against plain versions."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import bpe, decontamination, fingerprints, html_extraction, near_dedup, quality, suffix_dedup, token_counts
from quarry.llm import induced_sorting as sorting

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = "ab  c\n\t'sé²½ⅷ１　漢字🙂 <|endoftext|>.,-19́\x1c\x85"


def odd_texts(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return ["", " ", "<|endoftext|>", "a" * 500, *("".join(r.choice(ODD) for _ in range(r.randint(0, 120))) + r.choice(["", "<|endoftext|>", "a b c d " * 12]) for _ in range(n))]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_token_counts_equal_the_library(library):
    e = token_counts.Encoder(PATH)
    for x in odd_texts(400, 1):
        n = len(library.encode(x, add_special_tokens=False).ids)
        assert e.count(x) == n
        assert e.count(x, 40, 5) == n  # spliced
        assert e.count(x, 7, 1) == n  # widened overlaps


@pytest.mark.parametrize("kind", ["Chinese", "digits", "code", "blanks", "apostrophes"])
def test_long_texts_of_any_script_are_spliced(library, kind, monkeypatch):
    r = random.Random(kind)
    signs = {"Chinese": "漢字文本測試、。", "digits": "0123456789 ,", "code": "abc_(){};=+\n\t  'x", "blanks": "a  \n\t \u3000", "apostrophes": "'s't ll re've'd"}[kind]
    text = "".join(r.choice(signs) for _ in range(6_000))
    e, longest = token_counts.Encoder(PATH), []
    real = e.core
    monkeypatch.setattr(e, "core", type("Core", (), {"encode_ordinary": lambda self, t: longest.append(len(t)) or real.encode_ordinary(t), "decode_tokens_bytes": real.decode_tokens_bytes})())
    for chunk, overlap in ((200, 16), (333, 5)):
        assert e.count(text, chunk, overlap) == len(library.encode(text, add_special_tokens=False).ids)
    assert max(longest) < 1_000
    assert e.count("x" * 3_000, 200, 16) == len(library.encode("x" * 3_000, add_special_tokens=False).ids)


def test_bpe_equals_the_library_and_comes_back(library):
    words = sorted({w for x in odd_texts(50, 2) for w in bpe.pieces(x)})
    v = bpe.Vocabulary(PATH)
    block = bpe.compile_lexicon([w.encode() for w in words], [v.merge(w) for w in words])
    lexicon = bpe.Lexicon(block)
    assert all(lexicon.get(w.encode()) == v.merge(w) for w in words)
    assert lexicon.get(b"not a word") is None and lexicon.get(b"") is None
    for coder in (bpe.Coder(PATH, block), bpe.Coder(PATH, None)):
        for x in odd_texts(300, 3):
            ids = np.frombuffer(coder.encode(x), np.int32).tolist()
            assert ids == library.encode(x, add_special_tokens=False).ids
            assert coder.vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False) == x


def test_pieces_make_way_and_come_back(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 7)
    monkeypatch.setattr(bpe, "AT_ONCE", 5)
    coder, texts = bpe.Coder(PATH, None), odd_texts(60, 3)
    ids = [np.frombuffer(coder.encode(x), np.int32) for x in texts + texts]
    assert [x.tolist() for x in ids] == [library.encode(x, add_special_tokens=False).ids for x in texts] * 2
    assert len(coder.memo) <= 7 and len(coder.old) <= 7
    ends = np.cumsum([0, *map(len, ids)])
    assert coder.vocabulary.decode_all(np.concatenate(ids), ends) == [library.decode(x.tolist(), skip_special_tokens=False) for x in ids]
    assert coder.vocabulary.decode_all(np.empty(0, np.int32), np.array([0, 0, 0])) == ["", ""]
    broken = np.array([coder.vocabulary.id_of["é".encode()[:1]]], np.int32)
    assert coder.vocabulary.decode_all(broken, np.array([0, 1])) == [library.decode(broken.tolist(), skip_special_tokens=False)]


def test_lexicon_shares_suffixes():
    words = [a + b for a in ("ab", "cd", "ef", "gh") for b in ("ation", "ing", "ed")]
    block = bpe.compile_lexicon([w.encode() for w in words], [[i] for i in range(len(words))])
    states = np.frombuffer(block, np.int32, 8)[1] - 1
    assert states < 25 and all(bpe.Lexicon(block).get(w.encode()) == [i] for i, w in enumerate(words))


def naive_order(t: np.ndarray) -> list[int]:
    b = t.tobytes()
    return sorted(range(len(b)), key=lambda i: b[i:])


def common(b: bytes, i: int, j: int) -> int:
    n = 0
    while max(i, j) + n < len(b) and b[i + n] == b[j + n]:
        n += 1
    return n


@pytest.mark.parametrize("budget", [0, 100, 1 << 20])
def test_induced_sorting(budget, monkeypatch):
    monkeypatch.setattr(sorting, "CHUNK", 7)
    r = random.Random(budget)
    for k in range(150):
        t = np.array([r.randint(0, r.choice([1, 2, 3, 5, 20])) for _ in range(r.randint(1, 60))], np.uint8)
        t = np.tile(t, 4) if k % 3 == 0 else t
        depth = r.choice([4, 10, 100])
        found = list(sorting.sorted_suffixes(sorting.text_of(t), depth, budget))
        place, lcp = [x for p, _ in found for x in p.tolist()], [x for _, v in found for x in v.tolist()]
        b = t.tobytes()
        assert sorted(place) == list(range(len(t)))
        assert [b[i : i + depth] for i in place] == [b[i : i + depth] for i in naive_order(t)]
        assert all(min(lcp[i], depth) == min(common(b, place[i - 1], place[i]), depth) for i in range(1, len(place)))
    assert list(sorting.sorted_suffixes(sorting.text_of(np.empty(0, np.uint8)))) == []


def test_merges_of_runs_are_stable(monkeypatch):
    monkeypatch.setattr(sorting, "CHUNK", 300)
    r = np.random.default_rng(5)
    for top in (1, 3, 50, 1 << 40):
        keys = r.integers(0, top, 5_000)
        assert (sorting.ordered(keys, sorting.Spool(1 << 12)) == np.argsort(keys, kind="stable")).all()


@pytest.mark.parametrize("chunk,pieces,budget", [(1 << 13, 10_000, 120_000), (50, 40, 0)])
def test_a_shard_of_ten_budgets_sorts_in_10_mb(monkeypatch, chunk, pieces, budget):
    import tracemalloc

    import pandas  # noqa: F401  (so that its import isn't measured)
    import pyarrow as pa

    monkeypatch.setattr(sorting, "CHUNK", chunk)
    r = random.Random(9)
    known = [bytes(r.choice(b"abcdefgh ") for _ in range(130)) for _ in range(pieces // 2)]
    texts = [r.choice(known)[r.randint(0, 20) :] + b"z" * r.randint(0, 40) for _ in range(pieces)]
    kind = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("bytes", pa.binary())])
    batch = lambda i: pa.RecordBatch.from_pydict({"anchor": [1] * len(texts[i : i + 500]), "key": [*range(i, min(i + 500, pieces))], "start": [7] * len(texts[i : i + 500]), "n": [len(x) - 99 for x in texts[i : i + 500]], "bytes": texts[i : i + 500]}, schema=kind)
    tracemalloc.start()
    found = {(k, s + j) for b in suffix_dedup._sort_shard(100, budget)(batch(i) for i in range(0, pieces, 500)) for k, s, n in zip(*(b.column(c).to_pylist() for c in range(3))) for j in range(n)} if pieces < 100 else 0
    if pieces > 100:
        covered = sum(b.column(2).to_numpy().sum() for b in suffix_dedup._sort_shard(100, budget)(batch(i) for i in range(0, pieces, 500)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    seen, want, total = set(), set(), 0
    for k, x in enumerate(texts):
        for p in range(len(x) - 99):
            h = hash(x[p : p + 100])
            if h in seen:
                want.add((k, 7 + p)) if pieces < 100 else None
                total += 1
            seen.add(h)
    assert sum(map(len, texts)) > 10 * budget
    if pieces < 100:
        assert found == want
    else:
        assert covered == total and peak < 10 << 20


def test_anchors_are_equal_for_equal_strings():
    r = random.Random(4)
    text = bytes(r.choice(b"abcd ") for _ in range(900))
    anchors = suffix_dedup.Anchors(50)
    for part in (text[100:400], b"zz" + text[130:380] + b"yy"):
        mine = {(part[p : p + 50], g) for gs, start, n, _ in anchors.stretches(part) for g, s, k in zip(gs, start.tolist(), n.tolist()) for p in range(s, s + k)}
        whole = {text[p : p + 50]: g for gs, start, n, _ in anchors.stretches(text) for g, s, k in zip(gs, start.tolist(), n.tolist()) for p in range(s, s + k)}
        assert all(whole[w] == g for w, g in mine if w in whole)


@pytest.mark.parametrize("met,at_once", [(1 << 17, 1 << 16), (7, 5)])
def test_a_task_sends_a_string_once(monkeypatch, met, at_once):
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "MET", met)
    monkeypatch.setattr(suffix_dedup, "STRINGS", at_once)
    r = random.Random(6)
    line = "".join(r.choice("abcdefgh ") for _ in range(60))
    texts = {k: r.choice("xyz") * r.randint(0, 9) + line + r.choice("é ") * r.randint(0, 30) for k in range(60)}
    wanted = {k: [{"start": 40, "n": len(t.encode()) - 69}, {"start": 0, "n": 35}] if len(t.encode()) > 80 else None for k, t in texts.items()}
    keys = [*texts]
    r.shuffle(keys)  # earlier places may come later
    kind = pa.schema([("key", pa.int64()), ("text", pa.string()), ("wanted", pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())])))])
    batch = lambda ks: pa.RecordBatch.from_pylist([{"key": k, "text": texts[k] if wanted[k] else None, "wanted": wanted[k]} for k in ks], schema=kind)
    rows = []
    for ks in (sorted(keys[:30]), keys[30:]):  # two tasks
        sent = [x for b in suffix_dedup._strings(30, pa.int64())(batch(ks[i : i + 8]) for i in range(0, len(ks), 8)) for x in b.to_pylist()]
        seen = [(x["content"], x["check"]) for x in sent if not x["n"]]
        if met > 1000 and ks == sorted(ks):
            assert len(seen) == len(set(seen))
        rows += sent
    rows.sort(key=lambda x: (x["n"], x["content"], x["check"], x["key"], x["start"]))
    kind = pa.schema([("n", pa.int32()), ("content", pa.int64()), ("check", pa.int64()), ("key", pa.int64()), ("start", pa.int32())])
    out = suffix_dedup._later_strings()(pa.RecordBatch.from_pylist(rows[i : i + 11], schema=kind) for i in range(0, len(rows), 11))
    found = [(x["key"], x["start"] + j) for b in out for x in b.to_pylist() for j in range(x["n"])]
    places = sorted((k, x["start"] + j) for k in texts for x in wanted[k] or () for j in range(x["n"]))
    first = {}
    want = [(k, p) for k, p in places if first.setdefault(texts[k].encode()[p : p + 30], (k, p)) != (k, p)]
    assert sorted(found) == want and len(want) > 500


def test_wu_manber_finds_every_occurrence():
    r = random.Random(5)
    for k in range(400):
        strings = [tuple(r.randint(0, 2) for _ in range(r.randint(1 + k % 3, 6))) for _ in range(r.randint(1, 8))]
        text = [r.choice([0, 1, 2, None]) if k % 2 else r.randint(0, 2) for _ in range(40)]
        size = np.array([len(x) for x in strings])
        search = decontamination.Search(np.concatenate(strings).astype(np.int32), np.cumsum(size) - size, size, np.arange(len(strings)))
        found = [(i, n, o) for i, n, owners in search.find(text) for o in owners.tolist()]
        assert sorted(found) == sorted((i, len(x), o) for o, x in enumerate(strings) for i in range(len(text) - len(x) + 1) if tuple(text[i : i + len(x)]) == x)


def test_tables_of_a_large_benchmark_are_flat():
    """2 MB of items: under 60 MB while the tables are made, under 20 MB after."""
    import tracemalloc

    r = random.Random(6)
    known = [f"word{i}" for i in range(5_000)]
    items = [(str(i), " ".join(r.choice(known) for _ in range(100))) for i in range(2_200)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    b = decontamination.Benchmark(items, 10)
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert size > 1_800_000 and kept < 20 << 20 and peak < 60 << 20
    w = decontamination.words(items[7][1])
    assert {i for _, _, found in b.hits(["x", *w]) for i in found} == {"7"} and len(b.hits(w)) == 91


def test_windows_of_short_items():
    b = decontamination.Benchmark([("1", "A b-C"), ("2", "..."), ("3", " ".join(f"w{i}" for i in range(12)))], 10)
    assert sum(len(x.start) for x in b.searches) == 4
    assert b.hits(decontamination.words("x a B c y")) == [(1, 4, {"1"})]
    assert decontamination.runs([(3, 5), (1, 3), (7, 9)]) == [(1, 5), (7, 9)]


def test_sketches_tell_similarities():
    r = np.random.default_rng(6)
    signer = near_dedup.Signer(near_dedup.bands(0.8))
    most = near_dedup.most_differing(0.8, signer.k)
    for same in (0.8, 0.9, 0.97):
        for _ in range(20):
            pool = np.unique(r.integers(0, 1 << 63, 1000).astype(np.uint64))
            n = len(pool)
            out = int(n * (1 - same) / 2)
            a, b = np.sort(pool[out:]), np.sort(pool[: n - out])
            (_, x, u), (_, y, v) = signer.sign(a), signer.sign(b)
            bits = int(np.bitwise_count(np.frombuffer(u, np.uint8) ^ np.frombuffer(v, np.uint8)).sum())
            assert bits <= most and set(x) & set(y)
    far = [signer.sign(np.unique(r.integers(0, 1 << 63, 500).astype(np.uint64)))[2] for _ in range(2)]
    assert int(np.bitwise_count(np.frombuffer(far[0], np.uint8) ^ np.frombuffer(far[1], np.uint8)).sum()) > most


def test_postings_count_common_elements():
    r = np.random.default_rng(7)
    for k in (2, 5, 40):
        sets = [np.unique(r.integers(0, 300, 200).astype(np.uint64)) for _ in range(k)]
        postings, rest = near_dedup.Postings(sets), np.arange(k)
        for x in range(k - 1):
            rest = rest[rest > x]
            assert postings.common(x, rest).tolist() == [len(np.intersect1d(sets[x], sets[y])) for y in rest]


def test_spanning_joins_what_links_join():
    r = random.Random(8)
    for n in (1, 2, 9, 40):
        links = {(i, j) for i in range(n) for j in range(n) if i < j and r.random() < 1.2 / n}
        found = near_dedup.spanning(n, lambda x, rest: np.array([(min(x, y), max(x, y)) in links for y in rest.tolist()], bool))
        roots = []
        for edges in (links, found):
            up = list(range(n))
            for _ in range(n):
                for i, j in edges:
                    up[i] = up[j] = min(up[i], up[j])
            roots.append(up)
        assert roots[0] == roots[1] and len(found) == n - len(set(roots[0]))


def test_a_block_of_near_copies_stays_small():
    """16,000 sets of 18 shingles, all linked, and as many that are not: no memory of all pairs, no time of all pairs where links are found."""
    import tracemalloc

    import pyarrow as pa

    n = 16_000
    for own, least in ((1, n - 1), (9, 0)):
        sets = [np.sort(np.r_[np.arange(18 - own), 100 + own * i + np.arange(own)].astype(np.uint64)) for i in range(n if own == 1 else 4_000)]
        k = len(sets)
        rows = pa.RecordBatch.from_pydict({"group": [b"g"] * k, "key": [i.to_bytes(4, "big") for i in range(k)], "n": [18] * k, "shingles": [s.tobytes() for s in sets], "mine": pa.array([0] * k, pa.int32()), "i": pa.array([0] * k, pa.int32()), "j": pa.array([0] * k, pa.int32())})
        tracemalloc.start()
        found = sum(b.num_rows for b in near_dedup._by_sets(85, 100)(iter([rows])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found == least and peak < 100 << 20


def test_shingles():
    assert len(near_dedup.shingles(None, 3)) == len(near_dedup.shingles(" \n", 3)) == 0
    assert len(near_dedup.shingles("one Two", 3)) == 1
    assert (near_dedup.shingles("One two\tTHREE four", 3) == near_dedup.shingles("one two three  four ", 3)).all()
    assert len(near_dedup.shingles("a b c a b c a b c", 3)) == 3
    assert len(near_dedup.shingles("no split É", 1)) == 2  # only ASCII white space parts, only A-Z fold


def test_canonical_forms():
    assert fingerprints.canonical("  A b\n c ") == b"a b c"
    assert fingerprints.canonical("ﬁne Straße") == fingerprints.canonical("FINE STRASSE")
    assert fingerprints.canonical("é") == fingerprints.canonical("é") == fingerprints.canonical("É")
    assert fingerprints.edit("abcde", "XYZ") == "abcXY" and fingerprints.edit("abcd", "Z") == "abZ" and fingerprints.edit("", "x") == ""


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Big &amp; <i>bold</i></h1><p>One<b>two</b> &lt;p&gt;&nbsp;three<br>four<p>Five <!-- <p>no --> six</p>
<aside>Side</aside><form><input>Sign up</form><div id=comments><p>First!</p></div><ul><li>x<li>y</ul></article><footer>&copy; me</footer>"""


def test_html_main_text():
    assert html_extraction.extract(PAGE) == "Big & bold\nOnetwo <p> three four\nFive six\nx\ny"
    assert html_extraction.extract("") == "" and html_extraction.extract("plain <b>text") == "plain text"
    assert html_extraction.extract("<div id=main><p>a</p></div><p>b</p>") == "a"


def test_template_text_goes_where_no_article_is_marked():
    pages = [f"<div><p>Welcome to us</p><span>Call now</span></div><div><p>Story {i} about {i * 7}</p></div><div><p>All rights kept</p></div>" for i in range(5)]
    keys = [{k: n for k, (n, *_) in html_extraction.counts(p).items()} for p in pages]
    same = {k for k in keys[0] if all(c.get(k) == keys[0][k] for c in keys)}
    classes = {k: keys[0][k] for k in same}
    assert html_extraction.extract(pages[2], classes) == "Story 2 about 14"


def template_of(pages):
    keys = [{k: n for k, (n, *_) in html_extraction.counts(p).items()} for p in pages]
    same = {k for k in keys[0] if all(c.get(k) == keys[0][k] for c in keys)}
    return {k: keys[0][k] for k in same}


def test_slots_decide_where_articles_are_marked():
    pages = [f"<div><p>Welcome to us</p></div><article><h1>Head {i}</h1><p>Send this to a friend</p><p>Story {i} about {i * 7}</p></article><div><p>Next: {i + 1}</p></div>" for i in range(5)]
    classes = template_of(pages)
    assert html_extraction.extract(pages[2], classes) == "Head 2\nStory 2 about 14"
    # The only article is a teaser: the text beside it is the main text.
    pages = [f"<div><p>Welcome to us</p></div><div><p>Long story {i} " + f"about {i * 7} and more " * 9 + f"</p></div><article><p>Teaser {i}</p></article>" for i in range(5)]
    assert html_extraction.extract(pages[2], template_of(pages)).startswith("Long story 2 about 14 and more")
    # A page that is nothing but template keeps its article.
    pages = ["<div><p>Welcome to us</p></div><article><p>One story</p></article>"] * 3
    assert html_extraction.extract(pages[0], template_of(pages)) == "One story"


def test_html_of_great_depth_and_many_ends():
    assert html_extraction.extract("<div>" * 50_000 + "x") == "x"
    assert html_extraction.extract("</b></div><p>" * 50_000 + "x") == "x"
    assert html_extraction.extract("<p>a</i></section>b" * 3) == "a\nb\na\nb\na\nb"


def test_quality_model_without_labels_is_constant():
    m = quality.Model(b"", b"", 0.0, 0.4, 0.4).open()
    assert m.score(b"") == m.score(b"any text") == pytest.approx(1 / (1 + np.exp(-0.4)))
