"""Every registered query of the subpackage over whole tables: against its SQL, or against versions of its contract that share no code with it."""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
import zlib
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import connect, same  # noqa: E402

from quarry.llm import registry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    """doc_id to text, by descending id."""
    return dict(connect(SF).sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id DESC").fetchall())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def rows(spark, name, *columns):
    return [tuple(r[c] for c in columns) for r in registry.queries()[name](spark, SF).collect()]


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    assert same(registry.queries()[name](spark, SF), registry.oracle_sql()[name], connect(SF))


def test_op2(spark, documents):
    def form(t):
        return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t).casefold()).split())

    ids, found = list(documents), {r[0]: r[1:] for r in rows(spark, "op2_fingerprints", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
    assert sorted(found) == sorted(ids)
    prints, forms = {}, {}
    for i, d in enumerate(ids):
        text, other = documents[d], documents[ids[(i + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        n, edited_sha, own, changed, near_edited, near_next = found[d]
        assert (n, edited_sha, near_edited, near_next) == (len(text), sha(edited), float(form(edited) == form(text)), float(form(text) == form(other)))
        for f, p in ((form(text), own), (form(edited), changed)):
            assert prints.setdefault(f, p) == p and forms.setdefault(p, f) == f


def test_op3(spark, documents):
    seen, want = set(), []
    for d, text in reversed(documents.items()):
        b = text.encode()
        hit = bytearray(len(b))
        for p in range(len(b) - 99):
            w = hash(b[p : p + 100])
            if w in seen:
                hit[p : p + 100] = b"\1" * 100
            seen.add(w)
        want.append((d, len(b), sum(hit), len(re.findall(b"\1+", bytes(hit))), sha(bytes(x for x, h in zip(b, hit) if not h))))
    assert sorted(rows(spark, "op3_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == want and sum(w[2] for w in want) > 0


def test_op5(spark):
    import html

    pages = {p: (u, h) for p, u, h in connect(SF).sql("SELECT page_id, url, coalesce(html, '') FROM pages").fetchall()}
    found = rows(spark, "op5_html_extraction", "page_id", "url", "text", "n_chars")
    assert sorted(r[0] for r in found) == sorted(pages)
    for page, url, text, n in found:
        article = re.search(r"<article>(.*?)</article>", pages[page][1], re.S).group(1)
        blocks = re.split(r"</?(?:p|h1|h2|h3|ul|li|div|blockquote)\b[^>]*>", re.sub(r"<br\b[^>]*>", " ", article))
        folded = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert (url, text, n) == (pages[page][0], "\n".join(b for b in folded if b), len(text))


def test_op6(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(connect(sf).sql("SELECT doc_id, quality FROM labels").fetchall())
    found = [(r.doc_id, r.held_out, r.score, r.predicted) for r in registry.queries()["op6_quality"](spark, sf).collect()]
    assert sorted(r[0] for r in found) == sorted(x for x, in connect(sf).sql("SELECT doc_id FROM documents").fetchall())
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= s <= 1 and p == int(s >= 0.7) for d, h, s, p in found)
    held = [(p, labels[d]) for d, h, _, p in found if h and labels.get(d) is not None]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) > 0.9


def test_op7(spark, documents, library):
    want = []
    for d, t in documents.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        want.append((d, len(t.encode()), n, n > 512))
    assert sorted(rows(spark, "op7_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit")) == sorted(want)


def test_op8(spark, documents, library):
    want = []
    for d, t in documents.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(rows(spark, "op8_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == sorted(want)
