"""Words of a text as column expressions: runs of ``[^\\x20\\x09-\\x0D]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words in order; none for a null text."""
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(plain, " "), "")


def chars_without(text: Column, characters: str) -> Column:
    """Number of code points of a text that are none of ``characters``."""
    return F.length(F.translate(text, characters, ""))


def chars_of(text: Column, characters: str) -> Column:
    """Number of code points of a text that are one of ``characters``."""
    return F.length(text) - chars_without(text, characters)
