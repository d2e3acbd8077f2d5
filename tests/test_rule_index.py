"""Rules with one pattern are tried once."""

from __future__ import annotations

from quarry.operators import templates


def test_rules_of_one_pattern_are_one_rule(spark, monkeypatch):
    tried = []
    possible_pairs = templates.possible_pairs
    monkeypatch.setattr(templates, "possible_pairs", lambda regex, names: (tried.append(regex.count()), possible_pairs(regex, names))[1])
    rows = [(k, ("/infobox/", "/x+/", "stub", "/^inf.*ox$/")[k % 4], f"a{k}") for k in range(400, 0, -1)] + [(401, None, "no")]
    rules = spark.createDataFrame(rows, "ord int, pattern string, action string")
    names = spark.createDataFrame([("Infobox",), ("stub",), ("xx",), ("other",)], "name string")
    out = {r.name: r.action for r in templates.resolve_rules(rules, names).collect()}
    # /infobox/ has ord 4, 8 ..., /x+/ 1, 5 ..., stub 2, 6 ...
    assert out == {"Infobox": "a1", "stub": "a2", "xx": "a1"}
    assert tried == [2]
