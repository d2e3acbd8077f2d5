"""Pages of markup as DataFrames of sections, nodes, template calls and marked lines."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import align
from quarry.functions import markup as wiki
from quarry.functions.lexer import Lexer

SECTIONS = {"title": pa.string(), "sec_idx": pa.int32(), "level": pa.int32(), "sec_title": pa.string(), "heading": pa.string(), "content": pa.string(), "n_par": pa.int32(), "error": pa.string()}
NODES = {"title": pa.string(), "node_id": pa.int32(), "parent_id": pa.int32(), "depth": pa.int32(), "cls": pa.string(), "tag": pa.string(), "is_block": pa.bool_(), "text": pa.string()}
SPARK_NAMES = {pa.string(): "string", pa.int32(): "int", pa.bool_(): "boolean"}


def _schema(columns: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{c} {SPARK_NAMES[t]}" for c, t in columns.items())


#: Nodes within nodes that can be followed; deeper pages give an error row.
DEEPEST = 200_000


def _each_page(pages: DataFrame, title: str, markup: str, columns: dict[str, pa.DataType], rows_of) -> DataFrame:
    """The rows that `rows_of(title, markup)` makes of every page that has markup."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(DEEPEST)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                rows = [r for t, m in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if m is not None for r in rows_of(t, m)]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(columns.items())))

    return pages.select(F.col(title).alias("title"), F.col(markup).alias("markup")).mapInArrow(run, _schema(columns))


def sections_of(pages: DataFrame, title: str = "title", markup: str = "markup", mode: str = "classify", rules: dict[str, wiki.Rule] | None = None) -> DataFrame:
    """The sections of every page in order. A page that can't be read gives one
    row with `error`; null markup gives no row. `rules` replace those of the mode."""

    def rows_of(name: str | None, text: str) -> list[dict]:
        try:
            return [{"title": name, "sec_title": s["title"], **{k: v for k, v in s.items() if k != "title"}} for s in wiki.sections(name or "", text, mode, rules)]
        except (ValueError, RecursionError) as e:
            return [{"title": name, "error": f"{type(e).__name__}: {e}"}]

    return _each_page(pages, title, markup, SECTIONS, rows_of)


def nodes_of(pages: DataFrame, title: str = "title", markup: str = "markup") -> DataFrame:
    """The tree of every page in pre-order, a row a node. A page that can't be read gives one node of class Error."""

    def rows_of(name: str | None, text: str) -> list[dict]:
        try:
            return [n | {"title": name} for n in wiki.nodes(name or "", text)]
        except (ValueError, RecursionError) as e:
            return [{"title": name, "node_id": 0, "parent_id": -1, "depth": 0, "cls": "Error", "tag": "", "is_block": False, "text": f"{type(e).__name__}: {e}"}]

    return _each_page(pages, title, markup, NODES, rows_of)


def aligned(pages: DataFrame) -> DataFrame:
    """(title, lines) from (title, markup, sentences): sentences of one's own with the marks of the article's first section put back. Null markup gives no lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sys.setrecursionlimit(DEEPEST)
        marks = wiki.Renderer("mark")
        for b in batches:
            rows = []
            for title, text, sentences in zip(b["title"], b["markup"], b["sentences"]):
                try:
                    tree = [] if text is None else align.article_tree(title or "", text)
                except (ValueError, RecursionError):  # such a page has no lines
                    tree = []
                rows.append((title, align.marked_sentences(tree[0], [s or "" for s in sentences], marks) if tree and sentences is not None else []))
            yield pd.DataFrame(rows, columns=["title", "lines"])

    return pages.select("title", "markup", "sentences").mapInPandas(run, "title string, lines array<string>")


def marked_lines(pages: DataFrame, language: str = "en") -> DataFrame:
    """(title, lines) from (title, markup, keep), where `keep` has sec_idx and
    whether a section is kept whole (else its heading only)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sys.setrecursionlimit(DEEPEST)
        lexer, plain, marks = Lexer(language), wiki.Renderer("segment"), wiki.Renderer("mark")
        for b in batches:
            rows = []
            for title, text, keep in zip(b["title"], b["markup"], b["keep"]):
                parts = dict((k["sec_idx"], k["whole"]) for k in keep)
                lines: list[str] = []
                try:
                    tree = align.article_tree(title or "", text)
                except (ValueError, RecursionError):  # such a page has no lines
                    tree = []
                for i, n in enumerate(tree):
                    if i not in parts:
                        continue
                    if not parts[i]:
                        lines.append(marks.heading(n))
                        continue
                    own = [c for c in (n.children if n.cls == "Article" else n.children[1:]) if c.cls != "Section"]
                    sentences = lexer.sentences(plain.title(n) + "\n" + "".join(map(plain.render, own)))
                    lines += align.marked_sentences(n, sentences, marks)
                rows.append((title, [align.new_lines(x) for x in align.tidy("\n".join(lines)).split("\n") if x.strip()]))
            yield pd.DataFrame(rows, columns=["title", "lines"])

    return pages.select("title", "markup", "keep").mapInPandas(run, "title string, lines array<string>")
