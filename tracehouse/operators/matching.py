"""Best fuzzy match of every left text among the right texts.

The score of two texts is ``functions.scoring.token_set_ratio``; the best right text wins, the
earlier one on a tie. The result is exact, without caps:

* copies collapse first: both sides keep one row per canonical text;
* few texts are dealt to a grid of blocks of bounded size, so every pair meets once, in one task, and only the
  best right text of each left one leaves a block, never the pairs;
* of many texts, a left one first meets the right ones that share its rarest pieces of words. The best score found
  is one that its match has to reach, and so allows only so many edits. Each edit spoils one of several pieces that
  do not overlap, so one piece more than that, of the rarest, is in every right text that can still win. A right text
  that scores by being a part of the left one has one of its rarest words in it. Both are joins by pieces and words;
* left texts whose pieces are too common, too few, or without a good match go through the grid against all;
* pairs that meet are bounded by their common letters, then by their longest common subsequence, for many pairs at
  once: a bit row of one text in a machine word, one letter of the other text a step;
* what still can win is aligned, best bound first, until no bound can win any more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property
from math import ceil, floor, isqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracehouse.functions.columns import free_name, named
from tracehouse.functions.scoring import canonical_tokens, combined, ratio
from tracehouse.sources.staging import staged

MIN_SCORE = 76
BLOCK = 2_000  # texts of each side compared by one task at a time
_LETTERS = 64  # bins of letters: letters that share one only loosen a bound
_SEEN = 12  # occurrences of a letter that are told apart
_WORD = 64  # letters of a text that fit a machine word
_PAIRS = 100_000  # pairs whose subsequences are computed together
_GRID_TASKS = 64  # tasks that a grid is dealt to before its blocks grow
_PIECES = (8, 6, 5, 4, 3)  # letters of a piece
_TOGETHER = 1 << 19  # letters of texts whose pieces are made together
_BINS = 1 << 21  # bins in which pieces are counted: those that share one only look more common
_SEEDS, _SEED_PAIRS = 6, 64  # pieces that look for a first match, and right texts that they may meet
_TRIED = 4  # right texts with most of these pieces that are aligned first
_TEXTS = 10_000  # texts of a task at most, on average
_WIDER = 4  # times more right texts than a block's and fewer left ones are compared at a time: each left one is a step
_FEW = 32  # of how many pairs one is left by marks if the letters of each such pair are compared on their own
_SLOTS = 1 << 26  # bits of the keys that are looked for: those that share one are only carried along


def _flat(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, code) of all letters of texts, in order."""
    sizes = np.array([len(t) for t in texts], np.int64)
    rows = np.repeat(np.arange(len(texts)), sizes)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    return rows, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes), codes


def _binned(rows: np.ndarray, codes: np.ndarray, count: int, bins: int) -> np.ndarray:
    """How often each text's codes fall into each bin."""
    return np.bincount(rows * bins + codes % bins, minlength=count * bins).reshape(count, bins)


def _marks(texts: Sequence[str]) -> np.ndarray:
    """128 bits of each text's letters: texts differ in at least as many letters as bits, as a letter sets one bit each time."""
    rows, _, codes = _flat(texts)
    order = np.argsort(rows << 21 | codes, kind="stable")
    rows, codes = rows[order], codes[order]
    begins = np.flatnonzero(np.diff(rows << 21 | codes, prepend=-1))
    times = np.arange(len(codes)) - np.repeat(begins, np.diff(begins, append=len(codes)))
    bits = codes + 26 * times & 127  # a letter's repeats are kept off the other letters of the alphabet
    marks = np.zeros((len(texts), 2), np.uint64)
    np.bitwise_or.at(marks, (rows, bits >> 6), np.uint64(1) << (bits & 63).astype(np.uint64))
    return marks


class _Texts:
    """Canonical texts of one side of a block, prepared for bounds."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.lengths = np.array([len(t) for t in texts], np.int64)

    @cached_property
    def letters(self) -> np.ndarray:
        rows, _, codes = _flat(self.texts)
        return _binned(rows, codes, len(self.texts), _LETTERS).astype(np.int32)

    @cached_property
    def marks(self) -> np.ndarray:
        return np.ascontiguousarray(_marks(self.texts).T)

    @cached_property
    def seen(self) -> np.ndarray:
        """Column (letter, k) is set if the text has the letter more than k times."""
        return (self.letters[:, :, None] > np.arange(_SEEN)).reshape(len(self.texts), -1).astype(np.float32)

    @cached_property
    def holders(self) -> dict[str, list[int]]:
        """Places of the texts that have a word, in order."""
        held: dict[str, list[int]] = {}
        for at, text in enumerate(self.texts):
            for token in text.split():
                held.setdefault(token, []).append(at)
        return held

    def common_letters(self, other: _Texts) -> np.ndarray:
        """No pair of texts has more letters in common than this."""
        used = np.flatnonzero(self.seen.any(axis=0) & other.seen.any(axis=0))
        told = self.seen[:, used] @ other.seen[:, used].T
        beyond = (np.maximum(t.letters - _SEEN, 0).sum(axis=1) for t in (self, other))
        return told.astype(np.int64) + np.minimum.outer(*beyond)

    def near(self, other: _Texts, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of texts whose marks allow a score of ``least``, which each text has."""
        limits: dict[tuple[int, int], np.ndarray] = {}
        (low, high), (lows, highs) = self.marks, other.marks
        found = []
        for k, about in enumerate(zip(least.tolist(), self.lengths.tolist())):
            if about not in limits:
                limits[about] = np.clip((201 - 2 * about[0]) * (about[1] + other.lengths) // 200, 0, 128).astype(np.uint8)
            differ = np.bitwise_count(lows ^ low[k])
            differ += np.bitwise_count(highs ^ high[k])
            found.append(np.flatnonzero(differ <= limits[about]))
        i = np.repeat(np.arange(len(found)), [len(f) for f in found])
        return i, np.concatenate([np.empty(0, np.int64), *found])


def _score(matching, total):
    """Score of texts of ``total`` characters of which ``matching`` are matched on each side."""
    return np.rint(100 * (2.0 * matching / total)).astype(np.int64)


def common_subsequence(one: str, two: str) -> int:
    """Length of the longest common subsequence, by sums of whole bit rows."""
    places: dict[str, int] = {}
    for at, char in enumerate(one):
        places[char] = places.get(char, 0) | 1 << at
    every = (1 << len(one)) - 1
    row = every
    for char in two:
        found = row & places.get(char, 0)
        row = ((row + found) | (row - found)) & every
    return len(one) - row.bit_count()


def _subsequences(one: list[str], two: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``common_subsequence`` of all pairs (one[i], two[j]); texts beyond a machine word are done one by one."""
    if not len(i):
        return np.empty(0, np.int64)
    (some, i), (others, j) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
    one, two = [one[k] for k in some.tolist()], [two[k] for k in others.tolist()]
    rows, at, char = _flat(one)
    of_two, place, other = _flat(two)
    known = np.intersect1d(char, other)
    unknown = len(known)
    held = (at < _WORD) & np.isin(char, known)
    places = np.zeros((len(one), unknown + 1), np.uint64)  # bits of each letter's places; none of other letters
    where = rows[held], np.searchsorted(known, char[held])
    np.bitwise_or.at(places, where, np.uint64(1) << at[held].astype(np.uint64))
    lengths = np.array([len(t) for t in two], np.int64)
    codes = np.full((len(two), int(lengths.max(initial=0))), unknown, np.int32)
    codes[of_two, place] = np.where(np.isin(other, known), np.searchsorted(known, other), unknown)
    sizes = np.array([len(t) for t in one], np.int64)
    every = np.array([(1 << min(n, _WORD)) - 1 for n in sizes.tolist()], np.uint64)

    out = np.empty(len(i), np.int64)
    order = np.argsort(-lengths[j], kind="stable")  # long ones first: those still running are in front
    for start in range(0, len(order), _PAIRS):
        mine = order[start : start + _PAIRS]
        left, right = i[mine], j[mine]
        row = every[left]
        ends = -lengths[right]
        for step in range(int(lengths[right[0]])):
            running = int(np.searchsorted(ends, -step))
            own = row[:running]
            found = own & places[left[:running], codes[right[:running], step]]
            row[:running] = ((own + found) | (own - found)) & every[left[:running]]
        out[mine] = np.minimum(sizes[left], _WORD) - np.bitwise_count(row)
    for k in np.flatnonzero(sizes[i] > _WORD).tolist():
        out[k] = common_subsequence(one[i[k]], two[j[k]])
    return out


def _shared_scores(left: _Texts, right: _Texts, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """(left, rights, scores) of texts with shared tokens; no rights if no score can be ``least``, which each left has.

    The shared tokens begin both combined texts, so their ratios need no alignment.
    """
    holders, shortest = right.holders, int(right.lengths.min(initial=1 << 30))
    shared = np.zeros(len(right.texts), np.int64)
    for i, (text, wanted) in enumerate(zip(left.texts, least.tolist())):
        held = [t for t in text.split() if t in holders]
        if not held:
            continue
        most = sum(map(len, held)) + len(held) - 1
        if 200 * most < (wanted - 0.5) * (most + min(shortest, len(text))) - 1e-6:
            yield i, None, None
            continue
        for t in held:
            shared[holders[t]] += len(t) + 1
        some = np.flatnonzero(shared)
        length = shared[some] - 1
        shared[some] = 0
        yield i, some, _score(length, length + np.minimum(right.lengths[some], len(text)))


def _own_parts(left: list[str], right: list[str], i: np.ndarray, j: np.ndarray, share: np.ndarray):
    """(lefts, rights, i, j, shared): texts without the tokens that a pair shares, and the length that these take.

    A pair's combined texts begin with the shared tokens, so their longest common subsequence is that beginning and the
    one of what follows it. Pairs without shared tokens keep their whole texts.
    """
    lefts, rights = list(left), list(right)
    numbers: tuple[dict[str, int], dict[str, int]] = ({}, {})
    i, j, begin = i.copy(), j.copy(), np.zeros(len(i), np.int64)

    def number(text: str, side: int, texts: list[str]) -> int:
        if text not in numbers[side]:
            numbers[side][text] = len(texts)
            texts.append(text)
        return numbers[side][text]

    for k in np.flatnonzero(share).tolist():
        shared, a, b = combined(left[i[k]], right[j[k]])
        begin[k] = len(shared)
        i[k], j[k] = number(a[len(shared) :], 0, lefts), number(b[len(shared) :], 1, rights)
    return lefts, rights, i, j, begin


def _improved(one: _Texts, two: _Texts, best: np.ndarray) -> np.ndarray:
    """Places of the texts of ``two`` that beat the ``best`` scores, which they replace; -1 where none does."""
    at = np.full(len(one.texts), -1)
    sharing, untold = [np.empty(0, np.int64)], np.zeros(len(one.texts), bool)
    for i, some, scores in _shared_scores(one, two, best + 1):
        if some is None:
            untold[i] = True
            continue
        k = int(scores.argmax())  # the first of equal ones
        if scores[k] > best[i]:
            best[i], at[i] = scores[k], some[k]
        sharing.append(i * len(two.texts) + some)

    i, j = one.near(two, np.maximum(best + (at < 0), 1))
    if len(i) * _FEW > len(one.texts) * len(two.texts):
        common = one.common_letters(two)[i, j]
    else:
        common = np.minimum(one.letters[i], two.letters[j]).sum(axis=1, dtype=np.int64)
    open_ = _can_win(_score(common, one.lengths[i] + two.lengths[j]), i, j, best, at)
    i, j = i[open_], j[open_]
    if len(i):
        share = np.isin(i * len(two.texts) + j, np.concatenate(sharing))
        for k in np.flatnonzero(untold[i]).tolist():
            share[k] = not set(one.texts[i[k]].split()).isdisjoint(two.texts[j[k]].split())
        _align(one, two, i, j, share, best, at)
    return at


def _best_in_block(left: list[str], right: list[tuple], least: int | np.ndarray, block: int = BLOCK) -> list[tuple]:
    """Best right text of each left text within one block, as (canon, score, position, match).

    ``right`` holds (position, canon, match). Left texts whose best score is below ``least``, of all or of each, are left
    out. ``block`` squared pairs are compared at a time.
    """
    right = sorted(right)
    few, many = max(1, block // _WIDER), block * _WIDER
    parts = [_Texts(left[a : a + few]) for a in range(0, len(left), few)]
    best = np.zeros(len(left), np.int64) + least - 1
    won = np.full(len(left), -1)
    for b in range(0, len(right), many):
        two = _Texts([canon for _, canon, _ in right[b : b + many]])
        for a, one in zip(range(0, len(left), few), parts):
            at = _improved(one, two, best[a : a + few])  # best is a view: later parts have to beat it
            found = np.flatnonzero(at >= 0)
            won[a + found] = b + at[found]
    return [(left[k], int(best[k]), right[won[k]][0], right[won[k]][2]) for k in np.flatnonzero(won >= 0).tolist()]


def _can_win(bound: np.ndarray, i: np.ndarray, j: np.ndarray, best: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A bound has to beat the best score, or to equal it at an earlier place."""
    return (bound > best[i]) | ((bound == best[i]) & (j < at[i]))


def _align(one: _Texts, two: _Texts, i: np.ndarray, j: np.ndarray, share: np.ndarray, best: np.ndarray, at: np.ndarray):
    """Take the pairs (i, j) into the ``best`` scores and the places ``at`` which they are; ``share``: with shared tokens."""
    lefts, rights, own_i, own_j, begin = _own_parts(one.texts, two.texts, i, j, share)
    bound = _score(begin + _subsequences(lefts, rights, own_i, own_j), one.lengths[i] + two.lengths[j])
    open_ = _can_win(bound, i, j, best, at)
    i, j, bound = i[open_], j[open_], bound[open_]
    for k in np.lexsort((j, -bound, i)).tolist():
        text, place = int(i[k]), int(j[k])
        if bound[k] < best[text] or (bound[k] == best[text] and place > at[text]):
            continue
        _, a, b = combined(one.texts[text], two.texts[place])
        score = ratio(a, b)
        if score > best[text] or (score == best[text] and place < at[text]):
            best[text], at[text] = score, place


def _best_of_pairs(pairs: list[tuple]) -> list[tuple]:
    """Best right text of each left text among the pairs (canon, floor, position, right canon, match).

    As ``_best_in_block``; left texts whose best score is below their ``floor`` are left out.
    """
    floors = {canon: least for canon, least, *_ in pairs}
    numbers = {canon: k for k, canon in enumerate(floors)}
    right = sorted({tuple(r) for _, _, *r in pairs})
    held = {r: k for k, r in enumerate(right)}
    left = list(floors)
    one, two = _Texts(left), _Texts([r[1] for r in right])
    best, at = np.array(list(floors.values()), np.int64) - 1, np.full(len(left), -1)
    met = np.unique(np.array([(numbers[canon], held[tuple(r)]) for canon, _, *r in pairs], np.int64), axis=0)
    i, j = met[:, 0], met[:, 1]
    words = [set(text.split()) for text in left], [set(text.split()) for text in two.texts]
    size = np.array([sum(map(len, s)) + len(s) for s in (words[0][a] & words[1][b] for a, b in met.tolist())], np.int64)
    share = size > 0
    scores = np.zeros(len(i), np.int64)
    scores[share] = _score(size[share] - 1, size[share] - 1 + np.minimum(one.lengths[i], two.lengths[j])[share])
    for k in np.lexsort((j, -scores, i)).tolist():
        if scores[k] > best[i[k]]:
            best[i[k]], at[i[k]] = scores[k], j[k]
    common = np.minimum(one.letters[i], two.letters[j]).sum(axis=1, dtype=np.int64)
    open_ = _can_win(_score(common, one.lengths[i] + two.lengths[j]), i, j, best, at)
    _align(one, two, i[open_], j[open_], share[open_], best, at)
    return [(left[k], int(best[k]), right[at[k]][0], right[at[k]][2]) for k in np.flatnonzero(at >= 0).tolist()]


def _pieces(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, letters, place) of all pieces of the texts' words, text by text."""
    rows, at, codes = _flat([f"{text} " for text in texts])
    blanks = np.flatnonzero(codes == ord(" "))
    room = np.repeat(blanks, np.diff(blanks, prepend=-1)) - np.arange(len(codes))  # letters up to the end of the word
    found, key = [], np.zeros(len(codes), np.uint64)
    for size in range(1, max(_PIECES) + 1):
        key = key[: len(codes) - size + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[size - 1 :].astype(np.uint64)
        key ^= key >> np.uint64(29)
        if size in _PIECES:
            starts = np.flatnonzero(room[: len(key)] >= size)
            found.append((rows[starts], (key[starts] * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.int64), size, at[starts]))
    text, keys, starts = (np.concatenate([f[k] for f in found]) for k in (0, 1, 3))
    sizes = np.repeat([f[2] for f in found], [len(f[0]) for f in found])
    order = np.argsort(text, kind="stable")
    return text[order], keys[order], sizes[order], starts[order]


def _word_key(word: str) -> int:
    """A word as a whole; keys that meet another's by chance only give pairs that cannot win."""
    return crc32(f" {word}".encode())


def _rarest(pieces: list[tuple[int, int, int, int]], need: int) -> list[tuple[int, int]]:
    """(count, key) of up to ``need`` pieces (count, letters, place, key) that do not overlap, rare ones first."""
    used, chosen = 0, []
    for count, size, start, key in pieces:
        mask = ((1 << size) - 1) << start
        if not used & mask:
            used |= mask
            chosen.append((count, key))
            if len(chosen) == need:
                break
    return chosen


def _counted(texts: Sequence[str], counts: np.ndarray) -> Iterator[list[tuple[int, int, int, int]]]:
    """Pieces (count, letters, place, key) of each text, rare ones first."""
    rows, keys, sizes, starts = _pieces(texts)
    found = counts[keys % _BINS].astype(np.int64)
    order = np.lexsort((starts, sizes, found, rows))
    ends = np.searchsorted(rows, np.arange(len(texts) + 1)).tolist()
    columns = [column[order].tolist() for column in (found, sizes, starts, keys)]
    for begin, end in zip(ends, ends[1:]):
        yield list(zip(*(column[begin:end] for column in columns)))


def _seeds(pieces: list[tuple[int, int, int, int]]) -> list[int]:
    """Keys of rare pieces, by which a text looks for a first match."""
    keys, met = [], 0
    for count, key in _rarest([p for p in pieces if p[0]], _SEEDS):
        met += count
        if keys and met > _SEED_PAIRS:
            break
        keys.append(key)
    return keys


def _needed(
    text: str, least: int, counts: np.ndarray, most: int, longest: int | None = None, pieces: list | None = None
) -> list[int] | None:
    """Keys of which every right text of a score of ``least`` or more holds one; None if more than ``most`` texts may.

    Such a right text has at most ``edits`` letters more and less in all, if the text is not longer by words it lacks;
    ``longest`` bounds the letters of right texts, ``pieces`` are the text's, if known. Pieces come first in the result,
    rare ones first, then all words.
    """
    rate = (least - 0.5) / 100
    edits = 2 * len(text) * (1 - rate) / rate
    if longest is not None:
        edits = min(edits, (len(text) + longest) * (1 - rate))
    edits = floor(edits + 1e-9)
    if edits * min(_PIECES) >= len(text):
        return None
    pieces, found = pieces or next(_counted([text], counts)), []
    for letters in _PIECES:
        chosen = _rarest([p for p in pieces if p[1] <= letters], edits + 1)
        if len(chosen) > edits:
            found.append((sum(count for count, _ in chosen), [key for _, key in chosen]))
            if not edits:
                break  # the rarest of all
    if not found:
        return None
    met, keys = min(found)
    words = [_word_key(word) for word in text.split()]
    met += sum(int(counts[key % _BINS]) for key in words)
    return [*keys, *words] if met <= most else None


def _shortest(text: str, least: int, pieces: int) -> list[int]:
    """Letters from which on a right text may spoil all pieces before, for each of so many: shorter ones hold one of those."""
    rate = (least - 0.5) / 100
    return [max(0, ceil(k / (1 - rate) - len(text) - 1e-6)) for k in range(pieces)]


def _all_postings(texts: Sequence[str], counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, upto) by which right texts are found for scores up to ``upto``: their pieces and their rarest words.

    A text that scores by words that all are in the left text lacks few others: its rarest words of that length are not
    all among them.
    """
    rows, keys, _, _ = _pieces(texts)
    held = []
    for row, text in enumerate(texts):
        size, without = len(text), 0
        words = sorted((int(counts[key % _BINS]), -len(w), key) for w in text.split() for key in [_word_key(w)])
        for _, letters, key in words:
            upto = floor(100 * (2 * size - 2 * without) / (2 * size - without) + 0.5 + 1e-9) if without < size else 0
            if upto < least:
                break
            held.append((row, key, 100 - min(upto, 100)))
            without += 1 - letters
    more = np.array(held, np.int64).reshape(-1, 3).T
    codes = np.sort(np.concatenate([rows << 39 | keys << 7, more[0] << 39 | more[1] << 7 | more[2]]))
    codes = codes[np.diff(codes >> 7, prepend=-1) > 0]  # a key's highest score
    return codes >> 39, codes >> 7 & 0xFFFFFFFF, 100 - (codes & 127)


def _postings(text: str, counts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """``_all_postings`` of one text, as (key, upto)."""
    _, keys, uptos = _all_postings([text], counts, least)
    return list(zip(keys.tolist(), uptos.tolist()))


def _bin_counts(keys: DataFrame) -> np.ndarray:
    """How many rows have a ``key`` in each of the bins."""
    table = keys.groupBy((F.col("key") % _BINS).cast("int").alias("bin")).count().toArrow()
    counts = np.zeros(_BINS, np.int32)
    counts[table.column("bin").to_numpy()] = table.column("count").to_numpy()
    return counts


def _wanted(keys: DataFrame) -> np.ndarray:
    """One bit for each ``key``, in words of 64."""
    word = (F.col("key") % _SLOTS / 64).cast("int").alias("word")
    bits = F.bit_or(F.expr("shiftleft(1L, cast(key % 64 AS int))")).alias("bits")
    table = keys.groupBy(word).agg(bits).toArrow()
    wanted = np.zeros(_SLOTS // 64, np.int64)
    wanted[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return wanted.view(np.uint64)


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    slots = keys.astype(np.uint64) % np.uint64(_SLOTS)
    return (wanted[slots // np.uint64(64)] >> slots % np.uint64(64) & np.uint64(1)).astype(bool)


def _per_texts(df: DataFrame, columns, schema: str) -> DataFrame:
    """Columns that ``columns`` makes of ``df``'s columns, the first of which are texts, some texts at a time."""
    kinds = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            share = np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False)) // _TOGETHER
            begins = np.flatnonzero(np.diff(share, prepend=-1)).tolist()
            for begin, end in zip(begins, [*begins[1:], batch.num_rows]):
                made = columns(*batch.slice(begin, end - begin).columns)
                yield pa.RecordBatch.from_arrays([pa.array(v, k.type) for v, k in zip(made, kinds, strict=True)], schema=kinds)

    return df.mapInArrow(run, schema)


def _posted(texts: DataFrame, word_counts: np.ndarray, min_score: int, wanted: np.ndarray | None) -> DataFrame:
    """Postings of the texts (canon, number), of wanted keys only; without ``wanted``, all their keys alone."""

    def of_texts(canons, numbers):
        canons = canons.to_pylist()
        rows, keys, uptos = _all_postings(canons, word_counts, min_score)
        if wanted is None:
            return [keys]
        chosen = np.flatnonzero(_among(keys, wanted))
        rows = rows[chosen]
        sizes, marks = np.array([len(c) for c in canons], np.int64), _marks(canons).view(np.int64)
        return [keys[chosen], uptos[chosen], numbers.to_numpy()[rows], sizes[rows], marks[rows, 0], marks[rows, 1]]

    schema = "key long" if wanted is None else "key long, upto int, number long, size long, low long, high long"
    return _per_texts(texts, of_texts, schema)


def _may_win(exhaustive: bool) -> Column:
    """Whether a probe and a posting of its key may be a pair of a score of ``floor``, by their letters.

    ``exhaustive``: what is decided by aligned letters is found by pieces, and so is what is scored by words that all are in
    a longer right text; what is scored by words that all are in the left text is found by these. Whole numbers, exact.
    """
    differ = F.bit_count(F.col("low").bitwiseXOR(F.col("own_low"))) + F.bit_count(F.col("high").bitwiseXOR(F.col("own_high")))
    size, own_size, least, word = (F.col(c) for c in ("size", "own_size", "floor", "word"))
    both = size + own_size
    aligned = differ * 200 <= both * (201 - least * 2)
    contained = (both - differ) * (401 - least * 2) >= F.least(size, own_size) * (least * 4 - 2)
    if not exhaustive:
        return aligned | contained
    by_piece = ~word & (size >= F.col("shortest")) & (aligned | (size > own_size) & contained)
    return (least <= F.col("upto")) & (by_piece | word & (size <= own_size) & contained)


def _by_pieces(
    left_texts: DataFrame, right_texts: DataFrame, schema: str, min_score: int, most: int, sizes: tuple[int, int]
) -> tuple[DataFrame, DataFrame]:
    """(best matches of left texts found by their rare pieces, left texts (canon, floor) for which these do not suffice)."""
    spark = left_texts.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(sum(sizes) / _TEXTS))
    # small rows cost much work each, so their number decides on the tasks, not their size
    numbered = staged(right_texts.repartition(tasks).withColumn("number", F.monotonically_increasing_id()), "right")
    same = numbered.select("canon", F.col("number").alias("same"))
    lefts = staged(
        left_texts.join(same, "canon", "left").repartition(tasks).withColumn("own", F.monotonically_increasing_id()), "left"
    )
    words = numbered.select(F.explode(F.split("canon", " ")).alias("word"))
    word_counts = _bin_counts(words.select(F.crc32(F.concat(F.lit(" "), "word").cast("binary")).alias("key")))
    longest = numbered.agg(F.max(F.length("canon"))).first()[0]
    texts = numbered.select("canon", "number").repartition(tasks)
    counts = _bin_counts(_posted(texts, word_counts, min_score, None))
    places = schema.replace("match string", "number long")
    kinds = to_arrow_schema(T._parse_datatype_string(places))
    probe = "key long, own long, floor int, known long, own_size long, own_low long, own_high long, shortest int, word boolean, canon string"

    def met(probes: DataFrame, exhaustive: bool) -> DataFrame:
        """Pairs of probes and right texts that may win; only postings of the probes' keys are made."""
        postings = _posted(texts, word_counts, min_score, _wanted(probes))
        # postings are many more than their texts' size tells
        pairs = probes.repartition(tasks, "key").join(postings.hint("merge"), "key").where(_may_win(exhaustive))
        return pairs.where(~F.col("number").eqNullSafe(F.col("known"))).select("own", "number", "floor")

    def best(pairs: DataFrame) -> DataFrame:
        """Best of the pairs (own, number, floor)."""
        rights = numbered.select("number", "position", F.col("canon").alias("other"))
        named_ = pairs.repartition(tasks, "number").join(rights, "number")
        named_ = named_.repartition(tasks, "own").join(lefts.select("own", "canon"), "own")

        def run(batches):
            for batch in batches:
                rows = _best_of_pairs(list(zip(*[c.to_pylist() for c in batch.columns]))) if batch.num_rows else []
                columns = zip(*rows) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(list(v), k.type) for v, k in zip(columns, kinds)], schema=kinds)

        return named_.select("canon", "floor", "position", "other", "number").mapInArrow(run, places)

    def probes(canons, owns, floors, known, found):
        """Columns of the probes (text, key, shortest, word) and of the texts without any."""
        rows, keys, shortest, word = (list(c) for c in zip(*found)) if found else ([], [], [], [])
        left = pa.array([canons[row] if key is None else None for row, key in zip(rows, keys)], pa.string())
        rows = pa.array(rows, pa.int64())
        sizes, marks = [len(c) for c in canons], _marks(canons).view(np.int64)
        about = [owns, floors, known, pa.array(sizes, pa.int64()), pa.array(marks[:, 0]), pa.array(marks[:, 1])]
        return [keys, *(column.take(rows) for column in about), shortest, word, left]

    def seeds(canons, owns):
        canons = canons.to_pylist()
        found = [(row, key, 0, False) for row, p in enumerate(_counted(canons, counts)) for key in _seeds(p)]
        floors = pa.array([min_score] * len(canons), pa.int32())
        return probes(canons, owns, floors, pa.nulls(len(canons), pa.int64()), found)

    others = lefts.where("same IS NULL").select("canon", "own").repartition(tasks)
    sharing = met(staged(_per_texts(others, seeds, probe), "seeds"), exhaustive=False)
    ranked = sharing.groupBy("own", "number").count().groupBy("own").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("rank"), "number"))), 1, _TRIED).alias("tried")
    )
    tried = ranked.select("own", F.explode("tried.number").alias("number"), F.lit(min_score).alias("floor"))
    first = best(tried).groupBy("canon").agg(F.min(F.struct((-F.col("score")).alias("rank"), "position", "number")).alias("one"))
    first = staged(first.select("canon", (-F.col("one.rank")).alias("score"), "one.position", "one.number"), "first")
    known = lefts.join(first, "canon", "left").select(
        "canon", "own", F.when(F.col("same").isNotNull(), 100).otherwise(F.coalesce("score", F.lit(min_score))).alias("floor"),
        F.coalesce("same", "number").alias("known"),
    )

    def all_probes(canons, owns, floors, known):
        canons, leasts, found = canons.to_pylist(), floors.to_pylist(), []
        for row, (canon, least, pieces) in enumerate(zip(canons, leasts, _counted(canons, counts), strict=True)):
            keys = _needed(canon, least, counts, most, longest, pieces)
            if keys is None:
                found.append((row, None, None, None))
                continue
            by_piece = len(keys) - len(canon.split())
            found += [(row, key, n, False) for key, n in zip(keys, _shortest(canon, least, by_piece))]
            found += [(row, key, 0, True) for key in keys[by_piece:]]
        return probes(canons, owns, floors, known, found)

    probed = staged(_per_texts(known.repartition(tasks, "canon"), all_probes, probe), "probes")
    others = best(met(probed.where("key IS NOT NULL"), exhaustive=True).distinct())
    found = others.unionByName(first).select("canon", "score", "number").join(numbered.drop("canon"), "number")
    equal = lefts.where("same IS NOT NULL").join(numbered, "canon").withColumn("score", F.lit(100))
    columns = ["canon", "score", "position", "match"]
    return found.select(columns).unionByName(equal.select(columns)), probed.where("key IS NULL").select("canon", "floor")


def _by_blocks(
    left_texts: DataFrame, right_texts: DataFrame, schema: str, block: int, sizes: tuple[int, int]
) -> DataFrame:
    """Best matches of the left texts (canon, floor) among all right ones, of scores from ``floor`` on, by a grid of blocks.

    The more texts, the larger the blocks, up to ten times ``block`` a side, as each copies its texts once for a row or
    column of the grid. Large ones have fewer right texts, which take longer to prepare; a task goes through one in parts.
    """
    side = min(10 * block, max(block, isqrt(sizes[0] * sizes[1] // _GRID_TASKS)))
    r_side = max(block, side // 4)
    l_blocks, r_blocks = max(1, ceil(sizes[0] / (side * side // r_side))), max(1, ceil(sizes[1] / r_side))

    def dealt(texts: DataFrame, own: str, blocks: int, other: str, copies: int):
        mine = F.pmod(F.xxhash64("canon"), F.lit(blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        copied = texts.withColumn(own, mine).withColumn(other, every)
        # told by their number, as blocks of few bytes are much work: their shuffle would be coalesced by size
        return copied.repartition(min(l_blocks * r_blocks, 1_000), "l_block", "r_block").groupBy("l_block", "r_block")

    kinds = to_arrow_schema(T._parse_datatype_string(schema))

    def best_of_block(one: pa.Table, two: pa.Table) -> pa.Table:
        candidates = list(zip(*[two.column(c).to_pylist() for c in ("position", "canon", "match")], strict=True))
        floors = one.column("floor").to_numpy().astype(np.int64)
        rows = _best_in_block(one.column("canon").to_pylist(), candidates, floors, block)
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.table([pa.array(list(v), k.type) for v, k in zip(columns, kinds, strict=True)], schema=kinds)

    return (
        dealt(left_texts, "l_block", l_blocks, "r_block", r_blocks)
        .cogroup(dealt(right_texts, "r_block", r_blocks, "l_block", l_blocks))
        .applyInArrow(best_of_block, schema)
    )


def best_match(
    left: DataFrame, right: DataFrame, left_text: str, right_text: str, right_order: str, *,
    min_score: int = MIN_SCORE, fallback: bool = False, block: int = BLOCK,
) -> DataFrame:
    """Left rows with the best right text (``match``) and its ``score``.

    ``right_order`` decides ties. Left rows whose best score is below ``min_score`` keep a null
    match, or with ``fallback`` the first right text and score 0. Together with a ``min_score`` of 1
    that gives every left row its best match, at the price of aligning nearly all pairs. Rows with equal
    texts are compared once. The rows of both sides are counted, and texts and pieces of many written, while the query is
    built.
    """
    canon = free_name([*left.columns, "position", "match", "score"], "canon")
    keyed = left.withColumn(canon, canonical_tokens(F.coalesce(named(left_text), F.lit(""))))
    left_texts = keyed.select(F.col(canon).alias("canon")).distinct()
    right_texts = (
        right.where(named(right_text).isNotNull())
        .groupBy(canonical_tokens(named(right_text)).alias("canon"))
        .agg(F.min(F.struct(named(right_order).alias("position"), named(right_text).alias("match"))).alias("first"))
        .select("canon", "first.position", "first.match")
    )
    sizes = left.count(), right.count()  # of rows, at least as many as texts
    if sizes[0] * sizes[1] > block**2:
        left_texts, right_texts = staged(left_texts, "left_texts"), staged(right_texts, "right_texts")
        sizes = left_texts.count(), right_texts.count()
    # texts without words go here: a filter on what is staged would make each canonical text twice
    left_texts, right_texts = left_texts.where("canon != ''"), right_texts.where("canon != ''")
    position = right_texts.schema["position"].dataType.simpleString()
    schema = f"canon string, score int, position {position}, match string"
    if sizes[0] * sizes[1] <= block**2:
        found = _by_blocks(left_texts.withColumn("floor", F.lit(min_score)), right_texts, schema, block, sizes)
    else:
        found, rest = _by_pieces(left_texts, right_texts, schema, min_score, max(block, sizes[1] // 64), sizes)
        remaining = rest.count()
        if remaining:
            found = found.unionByName(_by_blocks(rest, right_texts, schema, block, (remaining, sizes[1])))
    won = free_name([*left.columns, canon, "match", "score"], "won")
    best = found.groupBy(F.col("canon").alias(canon)).agg(
        F.min(F.struct((-F.col("score")).alias("rank"), "position", "match")).alias(won)
    )
    joined = keyed.join(best, canon, "left")
    match: Column = F.col(won)["match"]
    score = -F.col(won)["rank"]
    if fallback:
        first = right.agg(F.min_by(named(right_text), named(right_order))).scalar()
        match, score = F.coalesce(match, first), F.coalesce(score, F.lit(0))
    return joined.select(*map(named, left.columns), match.alias("match"), score.alias("score"))
