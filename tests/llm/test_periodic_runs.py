"""Periodic runs against a version that tries every period at every word."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import connect  # noqa: E402

from quarry.llm import periodic_runs, registry  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs: stretches on which the words q apart agree, whose period no smaller q has."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([numbers[w] for w in words], np.int64)
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(x) // 2 + 1):
        same = np.concatenate([[0], (x[q:] == x[:-q]).astype(np.int8), [0]])
        change = np.flatnonzero(np.diff(same))
        for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
            if b - a + q >= max(least, 2 * q):
                found.setdefault((a, b - a + q), q)  # periods ascend
    return sorted((a, n, q) for (a, n), q in found.items())


def plain_collapse(words: list, runs: list) -> list:
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def of(words: list) -> list[tuple[int, int, int]]:
    texts = [" ".join(words).encode()]
    return [tuple(r.values()) for r in periodic_runs._collapsed(texts, 12)[1][0].as_py()]


def test_random_words_of_few_letters():
    rng = random.Random(7)
    for _ in range(1500):
        words = [rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randrange(60))]
        assert of(words) == plain_runs(words)


def test_repeats_within_repeats():
    rng = random.Random(8)
    for _ in range(300):
        words: list[str] = []
        while len(words) < rng.randrange(10, 400):
            unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 8))]
            unit = unit * rng.randrange(1, 9) + [rng.choice("abcd")] * rng.randrange(3)
            words += unit * rng.randrange(1, 6) + [rng.choice("abcdxyz") for _ in range(rng.randrange(4))]
        assert of(words) == plain_runs(words)


@pytest.mark.parametrize("words", [["a"] * 12, ["a"] * 11, ["a"] * 5000, list("ab") * 700 + ["c"] + list("ab") * 700, (["a"] * 300 + ["b"]) * 9, [str(i % 1000) for i in range(2999)], [str(i) for i in range(3000)], []])
def test_shapes(words):
    assert of(words) == plain_runs(words)


def test_words_of_fibonacci():
    a, b = ["a"], ["a", "b"]
    while len(b) < 2000:
        a, b = b, b + a
    assert of(b) == plain_runs(b)


def test_candidates_in_small_portions(monkeypatch):
    monkeypatch.setattr(periodic_runs, "AT_ONCE", 7)
    words = (["a"] * 40 + ["b"] + ["a"] * 30 + ["c"]) * 5
    assert of(words) == plain_runs(words)


def test_tree_against_sorting():
    rng = np.random.default_rng(3)
    values = rng.permutation(300)
    tree = periodic_runs.WaveletTree(values)
    low = rng.integers(0, 299, 500)
    high = low + 1 + rng.integers(0, 300 - low)
    x = rng.integers(0, 700, 500)
    assert tree.less(low, high, x).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(low, high, x)]
    n = rng.integers(0, high - low)
    assert tree.nth(low, high, n).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(low, high, n)]


def test_rows_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TOGETHER", 40)
    texts = [None, "", " \t\n", "la " * 20, "la " * 20, "x y z " * 9, "a b c d e f g h i j k l m", "one\ntwo\x0bthree\r" * 8 + "one", "  word" * 12]
    rows = [(i if i != 3 else None, t, "es", i) for i, t in enumerate(texts)] + [(7, texts[7], "de", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int").withColumns({"runs": F.lit(1), "_text": F.lit(2)}).coalesce(1)
    found = periodic_runs.collapse(docs, keep=("lang",)).collect()
    assert len(found) == len(rows)
    for r, (i, t, lang, _) in zip(found, rows):
        words = [w.decode() for w in (t or "").encode().split()]
        assert (r[0], r[1], r[2]) == (i, lang, len(words)) and [tuple(x) for x in r[3]] == plain_runs(words)
        assert r[4] == " ".join(plain_collapse(words, plain_runs(words)))
    assert periodic_runs.collapse(docs.limit(0)).count() == 0


def test_least_is_refused(spark):
    with pytest.raises(ValueError):
        periodic_runs.collapse(spark.createDataFrame([(1, "a")], "doc_id long, text string"), least=5)


def test_longer_runs_only(spark):
    docs = spark.createDataFrame([(1, "a " * 15 + "b " + "c d " * 12)], "doc_id long, text string")
    assert [tuple(x) for x in periodic_runs.collapse(docs, least=20).first().runs] == [(16, 24, 2)]


def planted(doc_id, words: list) -> list:
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_op13(spark):
    def sha(s: str) -> str:
        return hashlib.sha256(s.encode()).hexdigest()

    documents = dict(connect(SF).sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = {r.doc_id: tuple(r[c] for c in names) for r in registry.queries()["op13_periodic_runs"](spark, SF).collect()}
    assert found.keys() == documents.keys()
    n_planted = 0
    for d, text in documents.items():
        words = planted(d, [w.decode() for w in text.encode().split()])
        runs = plain_runs(words)
        n_planted += words != [w.decode() for w in text.encode().split()]
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * length // period if runs else None
        want = (d, len(runs), start, length, period, milli, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(plain_collapse(words, runs))))
        assert found[d] == want
    assert n_planted > 5


def test_planted_tails_of_odd_rows(spark):
    rows = [(None, "a b c"), (1, None), (2, " "), *((i, f"w{i} b c d e f g h i j") for i in range(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for d, before, after in docs.select("doc_id", "text", periodic_runs.repeated_tail(F.coalesce("text", F.lit("")), F.col("doc_id"))).collect():
        words = (before or "").split()
        assert after == (" ".join(planted(d, words)) if d is not None and words and zlib.crc32(str(d).encode()) % 10 == 0 else before or "")
