"""Texts in the single-byte charsets of the tokenizer's language variants: columns by built-in functions alone, and whole tables in one pass."""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Language and charset of each variant.
VARIANTS = {
    "de": ("de", "iso8859-1"), "de-win": ("de", "cp1252"), "de-u8": ("de", "utf-8"),
    "en": ("en", "iso8859-1"), "en-win": ("en", "cp1252"), "en-u8": ("en", "utf-8"),
    "ru": ("ru", "iso8859-5"), "ru-win": ("ru", "cp1251"), "ru-u8": ("ru", "utf-8"),
}
#: What stands for characters that a charset doesn't have.
LOST = "?"


def upper_half(charset: str) -> str:
    """The characters of bytes 128 to 255; a byte without one is the control character of its number."""
    one = lambda b: bytes([b]).decode(charset, "ignore") or chr(b)
    return "".join(map(one, range(128, 256)))


def decoded(content: Column, charset: str) -> Column:
    """The text of bytes in a charset. UTF-8 that isn't valid has U+FFFD in place of what can't be read."""
    if charset == "utf-8":
        return F.decode(content, "UTF-8")
    return F.translate(F.decode(content, "ISO-8859-1"), "".join(map(chr, range(128, 256))), upper_half(charset))


def encoded(text: Column, charset: str) -> Column:
    """The bytes of a text in a charset, LOST for each character that it doesn't have."""
    if charset == "utf-8":
        return F.encode(text, "UTF-8")
    own = upper_half(charset)
    kept = F.regexp_replace(text, f"[^\\x00-\\x7f{own}]", LOST)
    return F.encode(F.translate(kept, own, "".join(map(chr, range(128, 256)))), "ISO-8859-1")


def is_kept(text: Column, charset: str) -> Column:
    """Whether a charset has all characters of a text."""
    return F.lit(True) if charset == "utf-8" else ~text.rlike(f"[^\\x00-\\x7f{upper_half(charset)}]")


@cache
def _tables(charset: str):
    """The character of each byte, and the map of characters to bytes."""
    characters = "".join(map(chr, range(128))) + upper_half(charset)
    return characters, codecs.charmap_build(characters)


def encode_text(text: str, charset: str) -> bytes:
    """As `encoded`, of one text."""
    return text.encode() if charset == "utf-8" else codecs.charmap_encode(text, "replace", _tables(charset)[1])[0]


def decode_text(content: bytes, charset: str) -> str:
    """As `decoded`, of the bytes of one text."""
    return content.decode("utf-8", "replace") if charset == "utf-8" else codecs.charmap_decode(content, "strict", _tables(charset)[0])[0]


def there_and_back(docs: DataFrame, charsets: list[str], key: str, text: str = "text") -> DataFrame:
    """(key, charset, n_bytes, same): each text in each charset and read again. Null counts as empty.

    One pass by Python's codecs: built-in functions take characters one by one, as often as there are charsets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, same = [], []
            for t in b.column(1):
                t = t.as_py() or ""
                for c in charsets:
                    content = encode_text(t, c)
                    size.append(len(content))
                    same.append(decode_text(content, c) == t)
            keys = b.column(0).take(pa.array([i for i in range(b.num_rows) for _ in charsets], pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(charsets * b.num_rows, pa.string()), pa.array(size, pa.int64()), pa.array(same, pa.bool_())], [key, "charset", "n_bytes", "same"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, charset string, n_bytes long, same boolean")
