"""Token-set similarity of short texts, 0 to 100."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(a: str, b: str) -> int:
    """Twice the matching characters over all characters, in percent; 0 if a text is empty."""
    return round(100 * SequenceMatcher(None, a, b, autojunk=False).ratio()) if a and b else 0


def combined(a: str, b: str) -> tuple[str, str, str]:
    """Shared tokens, then shared + own tokens of each side, for two canonical texts."""
    left, right = set(a.split()), set(b.split())
    shared = sorted(left & right)
    return (
        " ".join(shared),
        " ".join(shared + sorted(left - right)),
        " ".join(shared + sorted(right - left)),
    )


def score_canonical(a: str, b: str) -> int:
    if not a or not b:
        return 0
    shared, one, two = combined(a, b)
    return max(ratio(shared, one), ratio(shared, two), ratio(one, two))


def canonical_tokens(col: Column) -> Column:
    """Distinct lower-case words in order, joined by blanks."""
    words = F.split(F.trim(F.regexp_replace(F.lower(col), r"(?U)\W+", " ")), " ")
    return F.array_join(F.sort_array(F.array_distinct(words)), " ")


@F.pandas_udf(T.IntegerType())
def _score_batch(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([score_canonical(x or "", y or "") for x, y in zip(a, b)], dtype="int32")


def token_set_ratio(a: Column, b: Column) -> Column:
    """Score of two text columns of the same row."""
    return _score_batch(canonical_tokens(a), canonical_tokens(b))
