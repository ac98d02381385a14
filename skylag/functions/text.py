"""Word matching for the text fields of a search."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what separates words, for Spark and for query values alike.
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Distinct lower-case words of a text column."""
    parts = F.split(F.lower(text), NOT_A_WORD)
    return F.array_distinct(F.filter(parts, lambda w: w != ""))


def query_words(value: str) -> list[str]:
    """Distinct lower-case words of a query value, in order."""
    found = re.findall(r"[^\W_]+", value.lower())
    return list(dict.fromkeys(found))


def matched_words(text: Column, value: str) -> Column:
    """How many words of the query value occur in the text."""
    wanted = F.array(*[F.lit(w) for w in query_words(value)]).cast("array<string>")
    return F.coalesce(F.size(F.array_intersect(words(text), wanted)), F.lit(0))
