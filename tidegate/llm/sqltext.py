"""Native text expressions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Everything but letters and digits of ASCII (lower case) and characters beyond ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else; null stays null."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words(text: Column) -> Column:
    """Words of a lower-cased text; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), NOT_WORD)
    # The pattern is greedy, so only the first and the last part can be empty.
    return F.filter(parts, lambda word: word != "")


def spaced(text: Column) -> Column:
    """Words of a lower-cased text with one space before, between and after them."""
    return F.concat(F.lit(" "), F.array_join(words(text), " "), F.lit(" "))


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so (in any case)."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name
