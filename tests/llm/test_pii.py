"""Personal data: the patterns against plain regular expressions, the field against all paths, and what it learns against lines held out."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import sys
import time
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import connect  # noqa: E402

from quarry.llm import linear_chain, pii, registry  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m.group().split("."))) <= 255:
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        rest = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and rest % 10 == 0:
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((3, m.start(), m.end()))
    return sorted(out)


def test_patterns_against_plain_expressions():
    rng = random.Random(5)
    parts = ["@", "a.b", "x", ".", "..", "-", " ", "+", "1", "12", "255", "256", "0007", "4111111111111111", "4111 1111-1111 1111", "(555)", "é", "%", "\n", "a@b.c", "+1 ", "@d.e", "1.2.3.4"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "@" * 1_000_000, "a@" * 500_000, "a@" + "b-" * 500_000, "+1" * 500_000, "1 " * 500_000, "+" + "1(" * 500_000, "a\n" * 500_000])
def test_long_texts_take_linear_time(text):
    began = time.time()
    pii.base_spans(text)
    pii.words_of(text)
    assert time.time() - began < 15


def small_chain(rng) -> linear_chain.Chain:
    weights = rng.normal(size=(6, 3))
    weights[0] = 0
    allowed = np.array([[True, True, False], [True, True, True], [True, True, True]])
    return linear_chain.Chain(weights, rng.normal(size=(3, 3)), allowed, np.array([True, True, False]))


def every_path(chain: linear_chain.Chain, said: np.ndarray):
    """(score, tags) of all paths that are allowed."""
    for tags in itertools.product(range(3), repeat=len(said)):
        if chain.first[tags[0]] and all(chain.allowed[a, b] for a, b in zip(tags, tags[1:])):
            yield sum(said[t, k] for t, k in enumerate(tags)) + sum(chain.pairs[a, b] for a, b in zip(tags, tags[1:])), tags


def test_best_paths_and_marginals_against_all_paths():
    rng = np.random.default_rng(4)
    chain = small_chain(rng)
    sizes = np.array([3, 1, 0, 5, 2, 5])
    features = rng.integers(0, 6, (int(sizes.sum()), 2))
    begins = np.cumsum(sizes) - sizes
    sequences = linear_chain.Sequences.of(begins, sizes)
    tags = chain.decode(features, sequences)
    likely, pairs = linear_chain._expected(chain, features, sequences)
    want_pairs = np.zeros((3, 3))
    for a, n in zip(begins, sizes):
        if n:
            paths = list(every_path(chain, chain.scores(features[a : a + n])))
            assert tuple(tags[a : a + n]) == max(paths)[1]
            total = sum(np.exp(s) for s, _ in paths)
            for t in range(n):
                assert np.allclose(likely[a + t], [sum(np.exp(s) for s, p in paths if p[t] == k) / total for k in range(3)])
            for s, p in paths:
                for x, y in zip(p, p[1:]):
                    want_pairs[x, y] += np.exp(s) / total
    assert np.allclose(pairs, want_pairs)


def test_words_and_their_ends():
    text = 'say: "+1 (523) 555-1055%%%" (a) --\n\n.x. é1!'
    words = pii.words_of(text)
    assert [text[a:b] for a, b in zip(words.start, words.end)] == ["say", "+1", "(523)", "555-1055", "(a)", "--", "x", "é1"]
    assert words.line.tolist() == [0] * 6 + [2] * 2
    alone = pii.words_of("x\n" + text + "\ny")
    assert (alone.features[1:-1] == words.features).all()  # lines know nothing of each other


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(pii.labelled_lines(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def test_what_the_field_learns(model):
    """Lines that are in no table: forms that the patterns miss, and what looks like them."""
    told = {
        "please ring (617) 555-0190 tonight": [(3, "(617) 555-0190")],
        "tel 617-555-0190": [(3, "617-555-0190")],
        "phone (030) 5550-9999 again": [(3, "(030) 5550-9999")],
        "write sue@server now": [(0, "sue@server")],
        "my card 3787 344936 71000 is lost": [(2, "3787 344936 71000")],
        "in 2019 it cost 12.50 and 3,400 of 10.2.3": [],
        "Version 2.0, January 2004": [],
        "A0b1C2d3e4F5g6 https://x.org/a/b/12345-678?x=1": [],
        "order 1234567890123456 came": [],
        "plain words only, and no numbers": [],
    }
    for text, want in told.items():
        assert [(k, text[a:b]) for k, a, b in model.spans(text)] == want


def test_held_out_documents(model):
    """Of the patterns' spans in documents that the sample left out or not the field finds nine in ten by itself, and adds next to nothing."""
    texts = [t for (t,) in connect("/root/testdata/sf0.1").sql("SELECT text FROM documents WHERE doc_id >= 1000 AND doc_id < 4000").fetchall()]
    found = added = total = 0
    for t in texts:
        base, own = pii.base_spans(t), model.spans(t)
        total += len(base)
        found += len(set(base) & set(own))
        added += len(pii._with_added(base, own)) - len(base)
    assert total > 100 and found > 0.85 * total and added < 0.05 * total


def test_rows_of_every_kind(spark, model):
    texts = [None, "", "\n \n", "mail a@b.c and tel 617-555-0190\nip 1.2.3.4", "mail a@b.c and tel 617-555-0190\nip 1.2.3.4", "x" * 3000 + "\n(617) 555-0190 tel"]
    rows = [(None if i == 1 else i % 4, t, "de") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = pii.scan(docs, model).select("doc_id", "base", pii.listed(pii.F.col("spans")).alias("spans")).collect()
    assert sorted(map(repr, ((r.doc_id, r.spans) for r in found))) == sorted(map(repr, (
        (0, ""), (None, ""), (2, ""), (3, "email:5:10,ip:35:42,phone:19:31"), (0, "email:5:10,ip:35:42,phone:19:31"), (1, "phone:3001:3015"),
    )))
    assert pii.scan(docs.limit(0), model).count() == 0


def test_portions_change_nothing(model, monkeypatch):
    text = "\n".join(["tel 617-555-0190 or a@b", "", "plain", "x" * 90, "card 3782 822463 10005 ok"] * 5)
    whole = model.spans(text)
    assert len(whole) == 15
    for size in (1, 30, 70, 200):
        monkeypatch.setattr(pii, "TOGETHER", size)
        found = []
        for portion, where in pii._portions(["", text, "a"]):
            for k, a, b in model.spans(portion):
                i, at, place = max(w for w in where if w[2] <= a)
                assert i == 1
                found.append((k, at + a - place, at + b - place))
        assert found == whole


def test_without_labels(spark):
    none = spark.createDataFrame([], "text string, spans array<struct<kind:int,start:int,end:int>>")
    assert pii.fit(none).spans("tel 617-555-0190") == []
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.fit(pii.labelled_lines(empty)).spans("tel 617-555-0190") == [(3, 4, 16)]


def test_op11(spark):
    documents = dict(connect(SF).sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    found = {r.doc_id: r for r in registry.queries()["op11_pii"](spark, SF).collect()}
    assert found.keys() == documents.keys()
    for d, text in documents.items():
        base = plain_spans(text)
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        r = found[d]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in range(4))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1]))) and set(listed.split(",")) - {""} <= set(r.spans.split(","))
