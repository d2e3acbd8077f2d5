"""The pipeline's stages against plain versions on a small corpus."""

from __future__ import annotations

import random
import re

import public_tokenizers
import pytest

from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import quality, registry


def words(r, n):
    return " ".join("".join(r.choice("aeiourstnl") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Tables with good and bad texts, copies, benchmark passages and secrets; ids repeat and lack."""
    r = random.Random(8)
    item = words(r, 14)
    rows, labels = [], []
    for i in range(240):
        text = words(r, r.randint(30, 80))
        if i % 4 == 3:
            text = " ".join(w + "###%%%" for w in text.split())
        elif i % 10 == 0 and len(rows) > 2:
            text = rows[-2][1]
        elif i % 10 == 1 and len(rows) > 2:
            text = " ".join(rows[-2][1].split()[:-1])
        elif i % 17 == 2:
            text += "\n" + item.upper() + " " + words(r, 5)
        elif i % 13 == 5:
            text += f'\ntoken = "{r.randrange(16**24):024x}" and AKIA{"Q7" * 8}'
        rows.append((i, text, "en", f"s{i % 5}", len(text)))
        labels.append((i, int(i % 4 != 3), 0))
    rows += [rows[0], rows[0], (4, rows[0][1], "en", "s1", None), (None, words(r, 40), "en", None, 7), (None, None, "en", "s1", None), (900, "", None, "s2", 0)]
    d = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "text", "lang", "source")) for r in df.collect()), key=repr)


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "secret_scans", "bpe_encoding"]
    steps = dict(corpus_pipeline.STAGES)

    good = steps[names[0]](spark, docs, corpus)
    assert good.columns == docs.columns
    model = quality.fit(docs, spark.read.parquet(f"{corpus}/labels.parquet")).open()
    assert rows_of(good) == [x for x in rows_of(docs) if model.score((x[1] or "").encode()) >= 0.7]
    assert sum("###" in (x[1] or "") for x in rows_of(good)) < 3 and good.count() > 170

    single = steps[names[1]](spark, good, corpus)
    sets = [(x, {tuple((x[1] or "").lower().split()[k : k + 5]) for k in range(max(1, len((x[1] or "").split()) - 4))} if (x[1] or "").split() else None) for x in rows_of(good)]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[root(i)] = root(j)
    groups = {}
    for i, (x, s) in enumerate(sets):
        groups.setdefault(root(i) if s else (i,), []).append(x)
    kept = rows_of(single)
    for members in groups.values():
        stay = [x for x in members if x in kept]
        ids = [x[0] for x in members if x[0] is not None]
        assert len({x for x in stay}) == 1 and stay[0][0] == (min(ids) if ids else None), members
    assert len(kept) == len(groups)

    clean = steps[names[2]](spark, single, corpus)
    item = spark.read.parquet(f"{corpus}/benchmark.parquet").where("text is not null").first().text.split()
    windows = [" ".join(item[k : k + 10]) for k in range(len(item) - 9)]
    assert rows_of(clean) == [x for x in kept if not any(f" {w} " in " " + " ".join(re.findall(r"[a-z0-9]+", (x[1] or "").lower())) + " " for w in windows)]
    assert len(rows_of(clean)) < len(kept)

    safe = steps[names[3]](spark, clean, corpus)
    hidden = rows_of(safe)
    assert len(hidden) == len(rows_of(clean)) and not any(re.search(r"[0-9a-f]{24}|AKIA", x[1] or "") for x in hidden) and any("[SECRET]" in (x[1] or "") for x in hidden)
    assert [x[0] for x in hidden if "[SECRET]" not in (x[1] or "")] == [x[0] for x in rows_of(clean) if "token" not in (x[1] or "")]
    assert all(r.n_chars == len(r.text) for r in safe.where("text is not null").collect())

    coded = {(r.doc_id, r.n_tokens): list(r.token_ids) for r in steps[names[4]](spark, safe, corpus).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert coded == {(x[0], len(ids)): ids for x in hidden for ids in [library.encode(x[1] or "", add_special_tokens=False).ids]}
    assert corpus_pipeline.run(spark, corpus).count() == len(hidden)


def test_registered(spark):
    names = registry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(registry.oracle_sql()) <= set(names)


def test_empty_tables(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
        assert docs.count() == 0

