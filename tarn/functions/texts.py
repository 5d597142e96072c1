"""Text columns: cleaning, counting, keyword tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a web or mail address inside a text.
URL = r"http\S+|www\.\S+"
ADDRESS = r"\S+@\S+\.\S+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Lower case, addresses removed, only a-z and 0-9 kept, blanks squeezed; NULL gives ''."""
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    for pattern in (URL, ADDRESS, r"[^a-z0-9\s]"):
        text = F.regexp_replace(text, pattern, " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def word_count(c: str | Column) -> Column:
    return F.size(F.split(_col(c), r"\s+"))


def contains_any(c: str | Column, words: Sequence[str], ignore_case: bool = True) -> Column:
    """Substring test for any of the words; NULL text is no match."""
    text = F.lower(_col(c)) if ignore_case else _col(c)
    any_word = "|".join(rf"\Q{w.lower() if ignore_case else w}\E" for w in words)
    return F.coalesce(F.rlike(text, F.lit(any_word)), F.lit(False))


def parse_bool(c: str | Column) -> Column:
    """Text to boolean: the listed spellings are true, any other text false, NULL stays NULL."""
    return F.lower(_col(c)).isin("true", "t", "1", "yes")


def file_extension(c: str | Column) -> Column:
    """Part after the last dot, '' when there is none."""
    return F.regexp_extract(_col(c), r"\.([^.]+)$", 1)
