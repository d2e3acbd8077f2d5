"""What patterns require, against matching; and rules by their rare grams, against trying all."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.functions.patterns import required
from quarry.operators import templates


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        ("stub$", ["stub"]), ("^IPA", ["ipa"]), ("(ring|gear)s?$", ["gear", "ring"]), ("ab", None), ("abc?", None), ("abcd?e", ["abc"]), ("abc+de", ["abc"]), ("a|bcd", None), ("x(?:abc|de)ylong", ["ylong"]), (r"a\.b c", ["a.b c"]),
        (r"\bcite", ["cite"]), ("[abc]def[^]x]", ["def"]), ("(?i)abc", None), ("(?=abc)d", None), (r"\x41bcd", None), ("abc{0,2}def", ["def"]), ("abc{2}", ["abc"]), ("", None), ("(abc", None), ("Ünter", ["Ünter"]), ("a.*long?er", ["lon"]),
    ],
)
def test_required(pattern, want):
    assert required(pattern) == want


def random_pattern(rng, depth=2):
    out = ""
    for _ in range(rng.randrange(1, 6)):
        kind = rng.random()
        if kind < 0.6 or depth == 0:
            out += rng.choice(["a", "B", "c", "ab", "bca", ".", "[ab]", r"\w", r"\.", "é"])
        elif kind < 0.8:
            out += rng.choice(["(", "(?:"]) + "|".join(random_pattern(rng, depth - 1) for _ in range(rng.randrange(1, 3))) + ")"
        else:
            out += rng.choice("abc")
        # Loops within loops would take too long to match.
        out += rng.choice(["", "", "?", "{2}", "{0,1}"] if out.endswith(")") else ["", "", "", "?", "*", "+", "{2}", "{0,1}", "+?"])
    return out


def test_what_is_required_is_there():
    rng = random.Random(12)
    known = 0
    for _ in range(6000):
        pattern = random_pattern(rng)
        found = required(pattern)
        if found is None:
            continue
        for _ in range(30):
            text = "".join(rng.choice("aAbBcC.é") for _ in range(rng.randrange(3, 14)))
            if re.search(pattern, text, re.I | re.A):
                known += 1
                assert any(f in text.lower() for f in found), (pattern, text)
    assert known > 300


def test_rules_against_trying_all(spark):
    rng = random.Random(13)
    names = sorted({"".join(rng.choice("abcAB ") for _ in range(rng.randrange(1, 9))) for _ in range(300)})
    rules = [(i, f"/{random_pattern(rng)}/" if rng.random() < 0.8 else rng.choice(names), rng.choice(["keep", "remove", "expand"])) for i in range(120)]
    want = {}
    for name in names:
        for _, pattern, action in rules:
            if name == pattern or len(pattern) > 2 and pattern[0] == pattern[-1] == "/" and re.search(pattern[1:-1], name, re.I | re.A):
                want[name] = action
                break
    table = spark.createDataFrame(rules, "ord int, pattern string, action string")
    known = spark.createDataFrame([(n,) for n in [*names, names[0], None]], "name string")
    assert {r.name: r.action for r in templates.resolve_rules(table, known).collect() if r.name in names} == want
    assert templates.resolve_rules(table.limit(0), known).count() == 0


def test_many_rules_meet_many_names_without_trying_all(spark):
    """Every rule has a gram of its own, so that pairs are as many as matches."""
    code = F.lpad(F.conv(F.col("id") * 7919 % 46656, 10, 36), 3, "0")
    names = spark.range(20_000).select(F.concat(F.lit("page "), code, F.lit(" x")).alias("name"))
    rules = spark.range(0, 20_000, 4).select(F.col("id").alias("ord"), F.concat(F.lit("/^page "), code, F.lit("/")).alias("pattern"), F.lit("keep").alias("action"))
    assert "NestedLoop" not in templates.resolve_rules(rules, names)._jdf.queryExecution().toString()
    assert templates.resolve_rules(rules, names).count() == 5_000
