"""Quality rules, lines first: lines that fail a rule are removed, then texts that lose too much.

A line fails as punctuation (symbols crowd it, or exclamations follow its words), as shouting (no
lower-case letter in several words), as navigation (separators between most of its words) or as
boilerplate (a stock phrase of web pages in a short line). A text is rejected if the failing lines hold
more than MAX_LOST percent of its word characters, or if it fails the base rules. Everything is built
from column functions.

Defined results: a null or text without words has zero counts and fails (too few words); repeated
rows, null ids and further columns are kept, except those with the measures' own names; an empty table
gives no rows. Five-word windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.columns import free_name
from tracehouse.llm.common import words

MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words in repeated windows
WINDOW = 5
MAX_LOST = 40  # percent of word characters in failing lines

SYMBOLS = "#*$%&|<>"
BLANK_CHARS = " \t\n\x0b\f\r"
MAX_SYMBOLS = 8  # percent of a line's characters other than blanks
MAX_EXCLAMATIONS = 40  # for 100 words of a line
MAX_SEPARATORS = 40
SHORT_LINE = 20  # words; stock phrases in longer lines are prose about them
LOUD_WORDS = 3
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "clean_text",
    "base_failed", "kept",
)

# Stock phrases of web pages.
BOILERPLATE = (
    "all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy",
    "accept cookies", "enable javascript", "click here", "subscribe to our newsletter", "sign up now",
    "read more", "back to top", "skip to content", "share this", "log in to",
)
# phrases by their first letters, so that most places of a text are left after one look
_BY_LETTER = [(a, [p[1:] for p in own]) for a, own in groupby(sorted(BOILERPLATE), key=lambda p: p[0])]
BOILERPLATE_PATTERN = f"(?i)(?:{'|'.join(f'{a}(?:{"|".join(rest)})' for a, rest in _BY_LETTER)})"
SEPARATORS = "|»›•"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _share(count: Column, whole: Column, percent: int) -> Column:
    return count * 100 > whole * percent


def _has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))


def line_fails(line: Column) -> Column:
    """Whether a line (with a word) fails a rule.

    Each rule needs a sign, a line without lower-case letters, or a stock phrase; few lines have one of them, and only
    these are counted.
    """
    signs = F.rlike(line, F.lit(f"[{SYMBOLS}!{SEPARATORS}]"))
    stock = F.rlike(line, F.lit(BOILERPLATE_PATTERN))
    return F.when(signs | ~F.rlike(line, F.lit(r"\p{Ll}")) | stock, _counted_fails(line)).otherwise(F.lit(False))


def _counted_fails(line: Column) -> Column:
    packed = F.length(_without(line, BLANK_CHARS))
    count = F.length(F.regexp_replace(F.trim(F.translate(line, BLANK_CHARS, " " * 6)), " +", " "))
    spaces = count - packed  # single blanks between words
    n_words = spaces + 1
    symbols = F.length(line) - F.length(_without(line, SYMBOLS))
    exclamations = F.length(line) - F.length(_without(line, "!"))
    separators = F.length(line) - F.length(_without(line, SEPARATORS))
    punctuation = _share(symbols, packed, MAX_SYMBOLS) | _share(exclamations, n_words, MAX_EXCLAMATIONS)
    navigation = (separators >= 3) & _share(separators, n_words, MAX_SEPARATORS)
    loud = (n_words >= LOUD_WORDS) & F.rlike(line, F.lit(r"\p{Lu}")) & ~F.rlike(line, F.lit(r"\p{Ll}"))
    stock = (n_words <= SHORT_LINE) & F.rlike(line, F.lit(BOILERPLATE_PATTERN))
    return punctuation | navigation | loud | stock


def _repeated_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more; only texts with such windows pay for the sort."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(sorted_windows: Column) -> Column:
        again = F.filter(
            sorted_windows,
            lambda x, k: F.coalesce(x["h"] == F.get(sorted_windows, k - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(sorted_windows, k + 1)["h"], F.lit(False)),
        )
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda s, p: F.struct(
                (p + WINDOW).alias("end"), (s["n"] + WINDOW - F.greatest(F.lit(0), s["end"] - p)).alias("n")
            ),
            lambda s: s["n"],
        )

    once = F.get(F.transform(F.array(placed), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), once).otherwise(F.lit(0).cast("long"))


def line_quality(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with the base measures, ``base_failed``, ``kept`` and ``clean_text`` (passing lines)."""
    body = F.coalesce(F.col(text), F.lit(""))
    own_words, own_lines, own_windows, own_tested = own = [
        free_name([*docs.columns, *MEASURES], name) for name in ("words", "lines", "windows", "tested")
    ]
    # a word is hashed once, a window from the hashes of its words
    hashes = F.transform(words(F.col(text)), lambda w: F.xxhash64(w))
    split = docs.withColumn(own_words, hashes).withColumn(own_lines, F.split(body, "\n"))
    n = F.size(own_words)
    window = lambda i: F.xxhash64(*[F.get(F.col(own_words), i + k) for k in range(WINDOW)])
    windows = F.when(
        n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)
    ).otherwise(F.array().cast("array<long>"))
    counted = split.withColumn(own_windows, windows).withColumn(
        own_tested,
        F.transform(
            F.filter(own_lines, _has_word), lambda x: F.struct(x.alias("line"), line_fails(x).alias("fails"))
        ),
    )
    lines = F.transform(own_tested, lambda x: x["line"])
    lost = F.aggregate(
        F.filter(own_tested, lambda x: x["fails"]),
        F.lit(0).cast("long"),
        lambda s, x: s + F.length(_without(x["line"], BLANK_CHARS)),
    )
    measured = counted.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(_without(body, BLANK_CHARS)).cast("long"),
            "n_symbols": (F.length(body) - F.length(_without(body, SYMBOLS))).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": _repeated_words(F.col(own_windows)),
            "lost_chars": lost,
            "clean_text": F.array_join(
                F.transform(F.filter(own_tested, lambda x: ~x["fails"]), lambda x: x["line"]), "\n"
            ),
        }
    ).drop(*own)
    failed = (F.col("n_words") < MIN_WORDS) | _share(F.col("n_repeat_words"), F.col("n_words"), MAX_REPEATED)
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & ~_share(F.col("lost_chars"), F.col("word_chars"), MAX_LOST)
    )
