"""Column helpers shared by the text operators: words, lines, byte lengths.

All are native expressions and null-safe: a NULL text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two word classes, written as their separators.
SPACE_RE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
NON_WORD_RE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def text_of(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does just that on pure ASCII
    text; other text goes through the slower ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def _split_words(c: Column, sep: str) -> Column:
    """Words between separators. Only a separator at either end of the text
    makes an empty piece, so one filter on the whole array is enough."""
    return F.filter(F.split(c, sep, -1), lambda w: w != "")


def space_words(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text."""
    return _split_words(c, SPACE_RE)


def plain_words(c: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a non-null text."""
    return _split_words(c, NON_WORD_RE)


def packed(df: DataFrame, drop: tuple[str, ...] = ()) -> Column:
    """All columns of ``df`` but ``drop`` as one struct ``_doc``, so that no
    working column can clash with a name of the input; ``_doc.*`` unpacks it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in drop]).alias("_doc")
