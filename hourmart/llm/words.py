"""Words of the phrase and window operators: runs of digits, letters a-z and non-ASCII characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourmart.llm.common import ascii_lower

# Fixed value: everything ASCII that is not a digit or a small letter separates.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column, lowered: bool = False) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    text = F.coalesce(text, F.lit(""))
    return F.array_remove(F.split(text if lowered else ascii_lower(text), SEPARATORS, -1), "")
