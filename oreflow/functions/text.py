"""Tokenising, hashtag extraction and string hashing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _split_trimmed(text: Column, separator: str) -> Column:
    """Split on one literal character; trailing empty parts are dropped.

    Empty text gives one empty part, text made of separators only gives none.
    """
    trimmed = F.rtrim(text, F.lit(separator))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, separator))
    )


def split_words(text: Column) -> Column:
    """Words of a one-line text, split on single spaces."""
    return _split_trimmed(text, " ")


def hashtags(text: Column) -> Column:
    """Hashtags of a message in order of appearance, without the leading ``#``.

    Tags glued together as in ``#a#b`` count separately.
    """
    words = split_words(F.replace(text, F.lit("\n"), F.lit(" ")))
    marked = F.filter(words, lambda w: F.startswith(w, F.lit("#")))
    return F.flatten(F.transform(marked, lambda w: _split_trimmed(F.substring(w, 2, 2147483647), "#")))


def jvm_hash(text: Column) -> Column:
    """Signed 32-bit polynomial hash (base 31) over the UTF-16 units of ``text``."""
    mask = F.lit(0xFFFFFFFF).cast("bigint")

    def unit(acc: Column, code: Column) -> Column:
        return (acc * F.lit(31) + code).bitwiseAND(mask)

    def fold(acc: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")
        offset = code - F.lit(0x10000)
        high = F.shiftright(offset, 10) + F.lit(0xD800)
        low = offset.bitwiseAND(F.lit(0x3FF).cast("bigint")) + F.lit(0xDC00)
        return F.when(code > 0xFFFF, unit(unit(acc, high), low)).otherwise(unit(acc, code))

    # split(..., "") yields one part per character; empty text hashes to zero.
    unsigned = F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), fold)
    wrapped = F.when(unsigned > 2147483647, unsigned - F.lit(1 << 32)).otherwise(unsigned)
    return F.when(text == "", F.lit(0)).otherwise(wrapped).cast("int")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units (a character outside the basic plane counts twice)."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("bigint")


def label_of(items: Column) -> Column:
    """An itemset rendered as ``(a, b)``."""
    return F.concat(F.lit("("), F.concat_ws(", ", items), F.lit(")"))
