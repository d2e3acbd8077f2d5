"""The audit of filters against a version that applies every order to every document."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import filter_audit

LETTERS = "ABCDE"


def plain_audit(docs: list, labels: list) -> dict:
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    smallest: dict[str, int] = {}
    for d, t, _ in docs:
        if d is not None:
            smallest[t or ""] = min(smallest.get(t or "", d), d)
    failed = []
    for d, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {k for k, c in zip(LETTERS, (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), re.search(r"[#$%&*|]", t), d is not None and smallest[t] < d)) if c}
        mine = [x for x in labels if d is not None and x[0] == d]
        failed.append((lang or "", f, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    rows: dict = {}
    shapley: dict = defaultdict(int)
    for order in itertools.permutations(LETTERS):
        for part in {x[0] for x in failed}:
            left = [x for x in failed if x[0] == part]
            everyone = left
            for step, letter in enumerate(order, 1):
                out = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                gone = sum(letter in x[1] for x in everyone) - len(out)
                rows[part, "".join(order), step] = (len(left), len(out), gone, sum(x[1] == {letter} for x in everyone), sum(x[2] for x in out), sum(x[3] for x in out))
                shapley[part, letter] += len(out)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in rows.items()}


LONG = " ".join(f"w{i}" for i in range(250))
DOCS = [
    (5, LONG, "en"), (3, LONG, "de"), (7, LONG, "en"), (7, LONG, "en"), (3, LONG, None), (None, LONG, "en"), (None, None, "en"), (1, "", ""), (9, None, "de"), (2, LONG + " #", "en"),
    (4, "A B", "en"), (8, "a " * 300, "de"), (10, ("Word " * 300).upper() + "%", "de"), (11, "a b", "en"), (11, "A B", "en"), (12, LONG + "\x0b\x1c", "en"),
]
LABELS = [(5, 1, 0), (5, 0, 1), (7, 0, 1), (8, 1, 1), (None, 1, 1), (1, None, None), (99, 1, 1), (4, 1, 0)]


def rows_of(df) -> dict:
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def tables(spark, docs=DOCS, labels=LABELS):
    named = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"words": F.lit(1), "id": F.lit("x"), "bits": F.lit(2), "part": F.lit("p")})
    return named, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("t"))


@pytest.mark.parametrize("group", [10_000, 2])
def test_rows_of_every_kind(spark, monkeypatch, group):
    monkeypatch.setattr(filter_audit, "GROUP", group)  # hot groups are dealt into parts
    assert rows_of(filter_audit.audit(*tables(spark))) == plain_audit(DOCS, LABELS)


def test_hashes_that_are_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "BROADCAST_BYTES", 0)
    assert rows_of(filter_audit.audit(*tables(spark))) == plain_audit(DOCS, LABELS)


def test_empty_tables(spark):
    docs, labels = tables(spark)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert rows_of(filter_audit.audit(docs, labels.limit(0))) == plain_audit(DOCS, [])


def test_equal_hashes_of_other_texts(spark):
    """Texts are compared, whatever their hashes."""
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c")], "id long, text string").withColumn("_h", F.lit(0).cast("long"))
    assert sorted(r.id for r in filter_audit.repeated_rows(rows).collect()) == [3, 4]


def test_other_letters(spark):
    """Three conditions of one's own and six orders."""
    docs = spark.createDataFrame([(1, "ab", "x"), (2, "ab", "x"), (3, "b", "x")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    counts = filter_audit.combinations(docs, {"P": F.col("text").contains("a"), "Q": F.col("text").contains("z")}, "R", F.col("lang"), labels)
    assert sorted((r.failed, r.n) for r in counts.collect()) == [("", 1), ("P", 1), ("PR", 1)]
    found = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filter_audit.orders(counts, "PQR").collect()}
    assert len(found) == 18 and found["PQR", 1] == (1, 2, 0, 9) and found["RPQ", 2] == (1, 1, 1, 9) and found["PQR", 3] == (1, 0, 1, 3)
