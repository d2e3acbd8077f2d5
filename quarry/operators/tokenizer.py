"""Tokens and sentences of a text column, by the lexer."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.lexer import Lexer
from quarry.functions.text import is_paragraph_break
from quarry.operators.common import short_batches

TOKENS = "array<struct<pos:int,type:string,text:string>>"


def tokens_of(language: str = "en", **options):
    """A pandas UDF: text to its tokens (pos, type, text); null stays null."""

    @F.pandas_udf(TOKENS)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexer = Lexer(language, **options)
        for s in texts:
            yield s.map(lambda t: None if t is None else [{"pos": i, "type": n, "text": x} for i, (n, x) in enumerate(lexer.tokens(t))])

    return run


def counts_of(language: str = "en", types: tuple[str, ...] = ("WORD", "NUMBER", "OTHER"), **options):
    """A pandas UDF: text to how many tokens of each of `types` it has and the length of its longest word; null stays null.

    No token leaves the worker, so that a text takes hardly more memory than its letters.
    """
    names = [*types, "longest"]

    @F.pandas_udf(", ".join(f"`{n}` long" for n in names))
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lexer = Lexer(language, **options)
        for s in texts:
            rows = []
            for t in s:
                found, longest = ({}, None) if t is None else lexer.counts(t)
                rows.append([*(found.get(n) for n in types), longest])
            yield pd.DataFrame(rows, columns=names, dtype="Int64")

    return run


def sentences_of(language: str = "en", **options):
    """A pandas UDF: text to its sentences; null stays null."""

    @F.pandas_udf("array<string>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexer = Lexer(language, **options)
        for s in texts:
            yield s.map(lambda t: None if t is None else lexer.sentences(t))

    return run


def segment(docs: DataFrame, text: str = "text", lang: str = "lang", more: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """`docs` with `sentences` in the lexer of each row's language; other languages are read as English. `more` has further abbreviations by language."""

    @F.pandas_udf("array<string>")
    def run(rows: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        lexers = {x: Lexer(x, more=(more or {}).get(x, ())) for x in ("en", "de", "ru")}
        for texts, langs in rows:
            yield pd.Series([None if t is None else lexers.get(x, lexers["en"]).sentences(t) for t, x in zip(texts, langs)], dtype=object)

    short_batches(docs.sparkSession)
    # Taken as deterministic, it would run twice where sentences are exploded: once for a filter of empty lists.
    return docs.withColumn("sentences", run.asNondeterministic()(F.col(text), F.col(lang)))


def token_lines(docs: DataFrame, key: str, text: str = "text", language: str = "en", lower: bool = False, separator: str = " ", **options) -> DataFrame:
    """(key, line_no, line): tokens joined by `separator`, a sentence a line."""
    out = docs.select(key, F.posexplode(F.transform(sentences_of(language, **options)(F.col(text)), lambda s: F.lower(s) if lower else s)).alias("line_no", "line"))
    words = F.filter(tokens_of(language, sentence_ends=False, **options)(F.col("line")), lambda t: ~t["type"].isin("HSPACE", "VSPACE"))
    return out.select(key, "line_no", F.array_join(F.transform(words, lambda t: t["text"]), separator).alias("line"))


def printed(
    docs: DataFrame, key: str, text: str = "text", language: str = "en", mode: str = "lines", mark: str = "<EOS />", separator: str = "\n", spaces: bool = False,
    line_ends: bool = False, paragraph_ends: bool = False, **options,
) -> DataFrame:
    """(key, out): a text's tokens in print.

    `mode` is "lines" (as they stand, with `mark` behind each sentence),
    "single" (each token behind the other with `separator`; with `spaces` also
    blanks, as one blank each, and paragraph breaks), "paragraphs" (the lines of
    a paragraph as one) or "sentences" (one a line). In the last two `spaces`
    puts an empty line between paragraphs. With `line_ends` every line break
    ends a sentence, with `paragraph_ends` two and more. Null stays null.
    """
    tokens = tokens_of(language, **options)(F.col(text))
    kind, own = lambda t: t["type"], lambda t: t["text"]
    space, paragraph = lambda t: kind(t) == "VSPACE", lambda t: (kind(t) == "VSPACE") & is_paragraph_break(own(t))
    ends = F.lit(False)
    ends_at = lambda t: (kind(t) == "EOS") | (space(t) if line_ends else paragraph(t) if paragraph_ends else ends)
    if mode == "lines":
        say = lambda t: F.concat(F.when(ends_at(t), mark).otherwise(""), own(t))
    elif mode == "single":
        gap = F.lit(separator)
        blank = lambda t: F.when(kind(t) == "HSPACE", F.concat(F.lit(" "), gap) if spaces else F.lit(""))
        end = lambda t: F.when(ends_at(t), F.concat(F.lit(mark), gap)).otherwise("")
        say = lambda t: blank(t).when(kind(t) == "EOS", end(t)).when(space(t), F.concat(end(t), F.when(paragraph(t), F.lit("\n\n") if spaces else F.lit("")).otherwise(""))).otherwise(F.concat(own(t), gap))
    elif mode in ("paragraphs", "sentences"):
        between = F.lit("\n\n" if spaces else "\n")
        stop = F.lit("\n") if mode == "sentences" else F.lit(mark)
        say = lambda t: F.when(paragraph(t), between).when(space(t), F.lit("\n" if line_ends and mode == "sentences" else " ")).when(kind(t) == "EOS", stop).when(kind(t) == "HSPACE", F.lit(" ")).otherwise(own(t))
    else:
        raise ValueError(mode)
    out = F.array_join(F.transform(tokens, say), "")
    if mode in ("paragraphs", "sentences"):
        out = F.regexp_replace(F.regexp_replace(out, "\n +", "\n"), r"\A\s+|\s+\z", "")
    return docs.select(key, F.when(F.col(text).isNotNull(), out).alias("out"))
