"""Column functions on text."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: All line ends that Unicode text can have.
LINE_END = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"
#: Word boundaries of sentences in plain text: end marks, closing marks, white space, then a capital or digit.
SENTENCE_END = r"([.!?]+)([\"')\]}>]*)\s+([A-Z0-9])"
ISLAND = "\u0001"


def normalised_heading(heading: Column) -> Column:
    """`_` as `-` and line breaks as blanks, so that headings can stand in `_`-separated files."""
    return F.translate(heading, "_\n", "- ")


def characters(text: Column) -> Column:
    """The code points of a text."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def symbol(c: Column) -> Column:
    """An ASCII character as it is; another as its escape: two, four or eight hex digits."""
    code = F.ascii(c)
    digits = F.lower(F.hex(code))
    wide = F.when(code < 256, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0"))).when(code < 65536, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
    return F.when(code < 128, c).otherwise(wide.otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0"))))


def exploded(text: Column) -> Column:
    """Characters with blanks between them, non-ASCII ones as escapes. Null stays null."""
    return F.array_join(F.transform(characters(text), symbol), " ")


@F.pandas_udf(StringType())
def unexploded(text: pd.Series) -> pd.Series:
    """The text that `exploded` was made of; one leading blank is dropped."""

    def back(s: str | None) -> str | None:
        if s is None:
            return None
        s = s[1:] if s[:1].isspace() and len(s) > 1 and not s[1:2].isspace() else s
        out, i = [], 0
        sizes = {"x": 4, "u": 6, "U": 10}
        while i < len(s):
            n = sizes.get(s[i + 1 : i + 2], 1) if s[i] == "\\" else 1
            part = s[i : i + n]
            if n > 1:
                try:
                    part = chr(int(part[2:], 16))
                except (ValueError, OverflowError):
                    n, part = 1, s[i]
            out.append(part)
            i += n + 1
        return "".join(out)

    return text.map(back)


def lines(text: Column) -> Column:
    """The lines of a text, as Unicode has them; a line end at the end starts no line."""
    parts = F.split(text, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def is_paragraph_break(space: Column) -> Column:
    """Whether white space holds two line breaks or more."""
    return F.length(F.regexp_replace(space, "[^\n]", "")) >= 2


def simple_sentences(text: Column) -> Column:
    """Sentences by end marks before a capital or digit, without abbreviations."""
    return F.split(F.regexp_replace(text, SENTENCE_END, f"$1$2{ISLAND}$3"), ISLAND)


def without_sentence_id(line: Column) -> Column:
    return F.regexp_replace(line, r"^\[\d+\] \|", "")


def joined_lines(text: Column) -> Column:
    return F.regexp_replace(text, "\n", " ")


def html_headings_to_wiki(text: Column) -> Column:
    """`<h2>x</h2>` to `== x ==`, for all six levels and in either case of letters."""
    for n in range(1, 7):
        text = F.regexp_replace(text, rf"(?is)<h{n}>(.*?)</h{n}>", f"{'=' * n} $1 {'=' * n}")
    return text


#: The 252 named references of HTML 4.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()}


def decode_entities(text: Column, names: tuple[str, ...] = ("lt", "gt", "quot", "copy", "middot", "nbsp")) -> Column:
    """Some named references, natively; `&amp;` comes last, so that nothing is decoded twice."""
    for name in names:
        text = F.replace(text, F.lit(f"&{name};"), F.lit(ENTITIES[name]))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


#: A reference: a number in hexadecimal or decimal digits, or a name.
REFERENCE = r"&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);"


def code_point(code: Column) -> Column:
    """The character of a number; null beyond Unicode, for 0 and for halves of pairs."""
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def entity_decoder(unknown: str = "keep", replacement: str = "", latin1: bool = False) -> Callable[[Column], Column]:
    """A native function of a column for all named and numeric references.

    `unknown` references are kept, skipped, or replaced; so are numbers that no character has. With `latin1`
    characters beyond U+00FF count as unknown.
    """
    names = F.create_map(*(F.lit(x) for pair in ENTITIES.items() if not latin1 or ord(pair[1]) < 256 for x in pair))

    def one(ref: Column, known: Column) -> Column:
        digits = F.regexp_replace(F.regexp_extract(ref, "^&#[xX]?0*([0-9a-fA-F]*);$", 1), "^$", "0")
        number = F.when(F.length(digits) > 8, "0").when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        if latin1:
            number = F.when(number < 256, number).otherwise(0)
        found = F.when(ref.startswith("&#"), code_point(number)).otherwise(F.try_element_at(known, F.substring(ref, 2, F.length(ref) - 2)))
        return F.coalesce(found, {"keep": ref, "skip": F.lit(""), "replace": F.lit(replacement)}[unknown])

    def decode(text: Column) -> Column:
        parts, refs = F.split(text, REFERENCE, -1), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
        before = F.concat(F.array(F.lit(None).cast("string")), refs)
        # The names are bound once, not made again for each reference.
        whole = lambda known: F.array_join(F.zip_with(parts, before, lambda p, r: F.when(r.isNull(), p).otherwise(F.concat(one(r, known), p))), "")
        return F.get(F.transform(F.array(names), whole), F.lit(0))

    return decode


def base25(n: int) -> str:
    """A number in digits a to y."""
    digits = chr(97 + n % 25)
    while n >= 25:
        n //= 25
        digits = chr(97 + n % 25) + digits
    return digits


def from_base25(s: str) -> int:
    n = 0
    for c in s:
        n = 25 * n + ord(c) - 97
    return n


MASK_PATTERN = r"\{\(.*?\)\}"


def masked_items(text: Column, pattern: str = MASK_PATTERN) -> Column:
    """What `masked` would hide, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def masked(text: Column, pattern: str = MASK_PATTERN) -> Column:
    """`text` with each match of `pattern` as `zzzz<number in base 25>zzzz`, natively."""
    digit = lambda n: F.char(F.lit(97) + n % 25)
    # Seven digits hold every index that an array can have.
    powers = F.array(*(F.lit(25**k) for k in range(6, 0, -1)))
    code = lambda i: F.concat(F.aggregate(powers, F.lit(""), lambda s, p: F.when(i >= p, F.concat(s, digit(F.floor(i / p)))).otherwise(s)), digit(i))
    parts = F.split(text, pattern, -1)
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("zzzz"), code(i - 1), F.lit("zzzz"), p))), "")


def unmasked(text: Column, items: Column) -> Column:
    """The text that `masked` hid the items of; marks without an item stay."""
    mark = "zzzz([a-y]+)zzzz"
    parts, marks = F.split(text, mark, -1), F.regexp_extract_all(text, F.lit(mark), F.lit(1))
    value = lambda s: F.aggregate(characters(s), F.lit(0), lambda n, c: n * 25 + F.ascii(c) - 97)
    item = lambda own, s: F.coalesce(F.get(own, value(s)), F.concat(F.lit("zzzz"), s, F.lit("zzzz")))
    # Marks and items are bound once, not worked out again for each mark.
    before = F.concat(F.array(F.lit(None).cast("string")), marks)
    whole = lambda own: F.array_join(F.zip_with(parts, before, lambda p, m: F.when(m.isNull(), p).otherwise(F.concat(item(own, m), p))), "")
    return F.get(F.transform(F.array(items), whole), F.lit(0))


def hms(seconds: Column) -> Column:
    """Seconds as h:mm:ss."""
    s = seconds.cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
