"""Words, alikeness and canonical keys of strings, as JVM-side expressions.

A word is a maximal run of letters or digits in lower case. Two strings are alike when they are
equal in lower case with everything but letters and digits left out. Null stays null throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: The same class for Python's re.
PY_WORD = r"[^\W_]+"


def words(text: Column) -> Column:
    """array<string>: the words in order; empty for a text without any."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def alike_key(text: Column) -> Column:
    """What is equal for alike strings and only for them."""
    return F.regexp_replace(F.lower(text), NOT_WORD, "")


def spaced_key(text: Column) -> Column:
    """Lower case, only letters, digits and white space, runs of white space as one blank, trimmed."""
    kept = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s\p{Z}]+", "")
    return F.btrim(F.regexp_replace(kept, r"[\s\p{Z}]+", " "))
