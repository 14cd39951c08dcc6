"""Words of a text as array columns, and keys of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, between: str = SPACE) -> Column:
    """The pieces between runs of ``between``; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def digest(text: Column) -> Column:
    """64-bit digest that tells a null text from an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())
