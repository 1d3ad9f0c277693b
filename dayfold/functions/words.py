"""Words of a text column, by pattern."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters and digits, in any script.
WORD_PATTERN = r"[\p{L}\p{N}]+"


def words_of(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Array of the words of a text in lower case, in order; NULL for a NULL text."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
