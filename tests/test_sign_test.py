"""The binomial tail against exact sums, with very many trials, and outcomes compared line by line."""

from __future__ import annotations

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from quarry.operators import language_model
from quarry.sources import pages


def test_against_exact_sums(spark):
    rng = random.Random(1)
    cases = [(m, w) for m in range(12) for w in range(m + 2)] + [(m := rng.randrange(12, 400), rng.randrange(m + 1)) for _ in range(150)]
    df = spark.createDataFrame(cases, "m long, w long")
    for m, w, p in df.select("m", "w", language_model.sign_test(F.col("w"), F.col("m"))).collect():
        exact = sum(math.comb(m, k) for k in range(max(w, 0), m + 1)) / 2**m if w else 1.0
        assert p == pytest.approx(exact, rel=1e-9, abs=1e-300)


def test_a_billion_trials(spark):
    began = time.time()
    m = 1_000_000_000
    wins = [m // 2, m // 2 + 31_623, m // 2 - 31_623, m // 2 + 10_000_000, m]
    df = spark.createDataFrame([(w,) for w in wins], "w long")
    found = [r[0] for r in df.select(language_model.sign_test(F.col("w"), F.lit(m))).collect()]
    # By the normal distribution, half a trial less.
    for w, p in zip(wins[:3], found):
        assert p == pytest.approx(0.5 * math.erfc((w - 0.5 - m / 2) / math.sqrt(m / 2)), rel=1e-4)
    assert found[1] + found[2] == pytest.approx(1, abs=1e-4) and 0 <= found[4] <= found[3] < 1e-100 and time.time() - began < 60


def test_lines_keep_their_places(spark, tmp_path):
    values = [f"line {i}" for i in range(5_000)]
    for k in range(3):
        (tmp_path / f"part-{k}.txt").write_text("\n".join(values[k * 2_000 : (k + 1) * 2_000]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many blocks, the larger files first
    try:
        rows = pages.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.value for r in sorted(rows, key=lambda r: r.place)] == values and sorted(r.place for r in rows) == list(range(5_000))


def test_by_position(spark):
    a = spark.createDataFrame([(0, True), (1, True), (2, True), (3, False), (4, None), (5, True)], "place long, right boolean")
    b = spark.createDataFrame([(0, False), (1, False), (2, True), (3, True), (4, False)], "place long, right boolean")
    assert tuple(language_model.sign_test_by_position(a, b).first()) == (3, 2, 0.5, "")
    assert tuple(language_model.sign_test_by_position(a.limit(0), b).first()) == (0, 0, 1.0, "")
