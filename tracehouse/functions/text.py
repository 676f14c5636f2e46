"""Column functions for cleaning and slicing text keys.

Everything but ``html_unescape`` is a built-in expression and stays inside code generation.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Precomposed letters and their base letters, by canonical decomposition up to U+ABFF."""
    accented, base = [], []
    for code in range(0x80, 0xAC00):
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")
        if len(plain) == 1 and plain != char:
            accented.append(char)
            base.append(plain)
    return "".join(accented), "".join(base)


def strip_accents(col: Column) -> Column:
    """Remove diacritics. Letters that do not decompose (ø, ß, ł, æ) stay as they are."""
    accented, base = _accent_table()
    plain = F.regexp_replace(F.translate(col, accented, base), r"\p{Mn}+", "")
    # the table is looked up per character, so pure ASCII text (one byte each) skips it
    return F.when(F.octet_length(col) != F.length(col), plain).otherwise(col)


def strip_quotes(col: Column) -> Column:
    # two byte-wise passes are faster than one translate, which works character by character
    return F.replace(F.replace(col, F.lit("'"), F.lit("")), F.lit('"'), F.lit(""))


def trim_lower(col: Column) -> Column:
    return F.trim(F.lower(col))


def normalise_name(col: Column, order: str = "quotes_first") -> Column:
    """Lower-case, trimmed, quote-free, accent-free text.

    ``quotes_first`` drops quotes before trimming, so a blank behind an edge quote goes too;
    ``trim_first`` drops them last and keeps that blank. Both sides of a join must agree.
    """
    if order == "quotes_first":
        return strip_accents(trim_lower(strip_quotes(col)))
    if order == "trim_first":
        return strip_quotes(strip_accents(trim_lower(col)))
    raise ValueError(f"order must be 'quotes_first' or 'trim_first', got {order!r}")


@F.pandas_udf(T.StringType())
def _unescape_batch(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def html_unescape(col: Column) -> Column:
    """Resolve HTML entities. All named entities are covered, so this one needs Python.

    A condition around a Python function does not keep rows from it, so texts without an ampersand
    are sent as nulls and taken from the column itself.
    """
    return F.coalesce(_unescape_batch(F.when(col.contains("&"), col)), col)


def concat_skip_null(cols: Iterable[Column | str]) -> Column:
    """Join texts, treating nulls as empty (``concat`` would give null)."""
    return F.concat_ws("", *cols)


def slice_text(col: Column, start: int | None = None, stop: int | None = None) -> Column:
    """Characters ``start`` to ``stop``, both included, counted from 1; negative counts from the end."""
    length = F.length(col)

    def position(bound: int) -> Column:
        return F.lit(bound) if bound >= 0 else length + F.lit(bound + 1)

    first = F.greatest(position(1 if start is None else start), F.lit(1))
    last = position(-1 if stop is None else stop)
    return F.substring(col, first, F.greatest(last - first + 1, F.lit(0)))


def char_at(col: Column, index: int) -> Column:
    return slice_text(col, index, index)


def flag_from_text(col: Column, yes: str = "y") -> Column:
    """True for ``yes`` or a true boolean, else false; null counts as false."""
    text = F.lower(col.cast("string"))
    return F.coalesce(text.isin(yes, "true"), F.lit(False))


def vintage_or_default(col: Column, default: int = 9999) -> Column:
    """Integer vintage; null and the text 'null' become ``default``."""
    text = col.cast("string")
    return F.when(text.isNull() | (text == "null"), F.lit(default)).otherwise(text.cast("int"))


def plain_path(uri: Column, encoded: bool) -> Column:
    """One form of a file's path: as its folders are named, without the scheme of local files.

    ``_metadata.file_path`` comes percent-encoded, the path of ``binaryFile`` does not.
    """
    # decoding a URL turns + into a blank, a path keeps it
    named = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))) if encoded else uri
    return F.regexp_replace(named, "^file:/*", "/")


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]+$", "")


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def child_path(directory: Column, name: str) -> Column:
    return F.concat(directory, F.lit("/" + name))
