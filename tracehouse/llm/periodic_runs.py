"""Periodic runs of words, by seeds and diagonals.

A run is a stretch with smallest period q and at least max(LEAST, REPEATS * q) words that no neighbouring word extends.
Its words equal those q further on, so on the diagonal of lag q it holds at least (REPEATS - 1) * q matches in a row.

* Seeds: for lags from L = 2**j to 2L - 1, that overlap is at least k = (REPEATS - 1) * L words (LEAST - 1 for lag 1).
  The k-grams of a text are indexed by exact names, built by doubling: the name of 2m words is that of the pair of
  its halves. A k-gram is not shorter than the lags it stands for, so the occurrences of one k-gram inside a run are
  exactly q apart, and only pairs of successive occurrences are seeds: their number grows with the text, not with its
  square. Positions whose gram occurs once in their text are left out of all longer grams.
* Extension: a seed is extended both ways on its diagonal by comparing words. Seeds of a lag are visited in the order
  of their positions, and those in front of the furthest match covered on that lag are skipped.

A stretch found this way has no smaller period: otherwise its seed would not have been a pair of successive occurrences.

Defined results: a null or empty text, or one of blanks only, has no words, no runs and an empty collapsed text; null
ids, repeated rows and further columns are kept, except columns with the names of the results; an empty table gives no
rows. Texts are handled whole, in batches of bounded size; a longer text is a batch of its own. Of runs with equal
length/period, the best is the one with the smallest start, then period.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracehouse.llm.common import pieces_by_bytes, words

LEAST = 6  # words of a run
REPEATS = 4  # periods of a run
COMPARED = 64  # matches looked at by the first step of an extension; later steps double


class Grams:
    """Exact names of the grams of several texts laid end to end; NONE where a gram occurs once in its text."""

    NONE = -1

    def __init__(self, symbols: np.ndarray, text_of: np.ndarray):
        # words of different texts are different, so no gram of one occurs in another
        self.ones = self._named(np.arange(len(symbols)), text_of, symbols, len(symbols))

    def _named(self, at: np.ndarray, first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
        """Names of the pairs (first, second) at positions ``at``, for pairs that occur again."""
        names = np.full(size, self.NONE, np.int64)
        if len(at):
            key = first.astype(np.int64) * (int(second.max()) + 1) + second
            _, name, count = np.unique(key, return_inverse=True, return_counts=True)
            again = count[name] > 1
            names[at[again]] = name[again]
        return names

    def joined(self, left: np.ndarray, m: int, right: np.ndarray) -> np.ndarray:
        """Names of grams made of a gram of ``m`` words, named in ``left``, and the one behind it."""
        size = len(left)
        at = np.flatnonzero(left[: max(size - m, 0)] != self.NONE)
        at = at[right[at + m] != self.NONE]
        return self._named(at, left[at], right[at + m], size)


def _seeds(names: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
    """(lag, first, last) of successive occurrences of a gram, ``low`` to ``high`` apart, at adjacent positions."""
    at = np.flatnonzero(names != Grams.NONE)
    at = at[np.argsort(names[at], kind="stable")]
    same = names[at[1:]] == names[at[:-1]]
    left, lag = at[:-1][same], (at[1:] - at[:-1])[same]
    fits = (lag >= low) & (lag <= high)
    left, lag = left[fits], lag[fits]
    order = np.lexsort((left, lag))
    left, lag = left[order], lag[order]
    begins = np.ones(len(left), bool)
    begins[1:] = (lag[1:] != lag[:-1]) | (left[1:] != left[:-1] + 1)
    ends = np.ones(len(left), bool)
    ends[:-1] = begins[1:]
    return list(zip(lag[begins].tolist(), left[begins].tolist(), left[ends].tolist(), strict=True))


def _matches_ahead(symbols: np.ndarray, at: int, lag: int, stop: int) -> int:
    """First position from ``at`` whose word differs from the one ``lag`` further on; ``stop`` is the text's end."""
    step, end = COMPARED, stop - lag
    while at < end:
        to = min(at + step, end)
        differs = symbols[at:to] != symbols[at + lag : to + lag]
        if differs.any():
            return at + int(differs.argmax())
        at, step = to, 2 * step
    return end


def _matches_back(symbols: np.ndarray, at: int, lag: int, start: int) -> int:
    """First position of the matches in front of ``at`` without a gap; ``start`` is the text's beginning."""
    step = COMPARED
    while at > start:
        low = max(start, at - step)
        differs = symbols[low:at] != symbols[low + lag : at + lag]
        if differs.any():
            return at - int(differs[::-1].argmax())
        at, step = low, 2 * step
    return start


def find_runs(symbols: np.ndarray, ends: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text that has any, by start, then period.

    ``symbols`` numbers the words of all texts, ``ends`` says where each text ends. Starts count from the text's own.
    """
    sizes = np.diff(ends, prepend=0)
    # texts that are too short for the lags of a level take no further part
    longest = int(sizes.max(initial=0))
    if longest < LEAST:
        return {}
    text_of = np.repeat(np.arange(len(ends)), sizes)
    grams = Grams(symbols, text_of)
    by_length = {1: grams.ones}
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    low = 1
    while REPEATS * low <= longest:
        half = by_length[low]
        twice = by_length[2 * low] = grams.joined(half, low, half)
        if low == 1:
            # LEAST - 1 words: four and one more
            four = grams.joined(twice, 2, twice)
            seeds = _seeds(grams.joined(four, 4, half), 1, 1)
        else:
            seeds = _seeds(grams.joined(twice, 2 * low, half), low, 2 * low - 1)
        covered: dict[int, int] = {}  # lag -> end of the furthest matches on its diagonal
        for lag, first, last in seeds:
            if last < covered.get(lag, 0):
                continue
            text = int(text_of[first])
            stop = int(ends[text])
            start = stop - int(sizes[text])
            to = _matches_ahead(symbols, last, lag, stop)
            since = _matches_back(symbols, first, lag, start)
            covered[lag] = to
            length = to - since + lag
            if length >= max(LEAST, REPEATS * lag):
                runs[text].append((since - start, length, lag))
        if not (twice != Grams.NONE).any():
            break
        by_length.pop(low // 2, None)
        low *= 2
    for found in runs.values():
        found.sort(key=lambda r: (r[0], r[2]))
    return runs


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length/period; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def kept_words(size: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word stays when every run keeps its first period only."""
    change = np.zeros(size + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:-1] == 0


def periodic_runs(
    docs: DataFrame,
    *,
    text: str = "text",
    n_words: str = "n_words",
    runs: str = "runs",
    best: str = "best",
    collapsed: str = "collapsed",
) -> DataFrame:
    """``docs`` without their texts, with each whole text's words, runs, best run (null: none) and collapsed text."""
    results = {text, n_words, runs, best, collapsed}
    keep = [i for i, f in enumerate(docs.schema) if f.name not in results]
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType(
        [
            *(docs.schema[i] for i in keep),
            T.StructField(n_words, T.LongType()),
            T.StructField(runs, T.ArrayType(run)),
            T.StructField(best, run),
            T.StructField(collapsed, T.StringType()),
        ]
    )
    at = docs.columns.index(text)
    arrow_run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def as_struct(rows: list[tuple[int, int, int]]) -> pa.Array:
        columns = np.array(rows, np.int64).reshape(-1, 3)
        return pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], fields=list(arrow_run))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_by_bytes(whole, text):
                split = [[] if t is None else t.split() for t in batch.column(at).cast(pa.binary()).to_pylist()]
                sizes = np.fromiter(map(len, split), np.int64, len(split))
                number: dict[bytes, int] = {}
                symbols = np.fromiter(
                    (number.setdefault(w, len(number)) for own in split for w in own), np.int64, int(sizes.sum())
                )
                found = find_runs(symbols, np.cumsum(sizes))
                texts = [
                    b" ".join([w for w, k in zip(own, kept_words(len(own), found[i]), strict=True) if k])
                    if i in found
                    else b" ".join(own)
                    for i, own in enumerate(split)
                ]
                listed = [found.get(i, []) for i in range(len(split))]
                counts = np.concatenate([[0], np.cumsum([len(x) for x in listed])])
                bests = [best_run(x) if x else None for x in listed]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i) for i in keep),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(counts, pa.int32()), as_struct([r for x in listed for r in x])),
                        pa.array(
                            [b if b is None else dict(zip(("start", "length", "period"), b, strict=True)) for b in bests],
                            arrow_run,
                        ),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=schema.names,
                )

    return docs.mapInArrow(scan, schema)


def planted(docs: DataFrame, number: Column, *, text: str = "text") -> DataFrame:
    """``docs`` with a run put into a tenth of the texts: those whose ``number`` h is divisible by 10.

    With g = h // 10 and n words, words from a = g % n on repeat the p = 1 + (n - a) // (3 + g % 8) words there. A text
    without words, or whose number is null, stays as it is.
    """
    own = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]
    hold = "words of " + "_".join(docs.columns)  # no column is named like this
    g = F.floor(number / 10)
    split = docs.select(*own, F.when(number % 10 == 0, words(F.col(text))).alias(hold))
    w = F.col(f"`{hold.replace('`', '``')}`")
    n = F.size(w)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), n - a)
    repeated = F.array_join(F.concat(F.slice(w, F.lit(1), a), again), " ")
    changed = F.when(n > 0, repeated).otherwise(F.col(text)).alias(text)
    return split.select(*[changed if name == text else c for name, c in zip(docs.columns, own, strict=True)])


def run_lines(runs: Column) -> Column:
    """``start,length,period`` of every run, each with a line feed."""

    def line(run: Column) -> Column:
        fields = [run[name].cast("string") for name in ("start", "length", "period")]
        return F.concat(F.concat_ws(",", *fields), F.lit("\n"))

    return F.array_join(F.transform(runs, line), "")
