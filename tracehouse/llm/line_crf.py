"""Quality of texts from a linear-chain conditional random field over their lines.

Each line (with a word) is good or bad. A line's score comes from its own features and from those of the
lines before and behind it; transition weights tie neighbours together. Labels exist for texts only: lines
of good texts count as good; in bad texts all lines start as bad, and in ROUNDS passes those that the
field itself finds good are given up, except each text's worst one. A text's quality is the mean of its
lines' forward-backward marginals, weighted by length and fitted to the labels by a logistic curve.

The field is fitted on a bounded sample, PER_CLASS texts of each label chosen by a hash of the id; tasks turn
them into features, the driver fits a few hundred weights. Every text is scored as a whole.

Defined results: a null or empty text, or one of blanks, has no lines and gets the share of good texts in the
sample; if nothing can be learned, every score is that share (0.5 without any label). Null ids, repeated rows and
further columns are kept; an empty table gives no rows. Several labels of one id each count as a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER_CLASS = 3_000
ROUNDS = 2
STEPS = 60
RATE = 0.15
DECAY = 1e-3
BINS = 8
GROUPS = 12
FEATURES = GROUPS * BINS + 1  # the last one marks a missing neighbour
EDGE = GROUPS * BINS

_SYMBOLS = b"#*$%&|<>@^~\\{}[]=_+"
_BLANKS = b" \t\n\x0b\f\r"


def _grade(value: float, limits: tuple[float, ...]) -> int:
    return sum(value > x for x in limits)


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """One bin a feature group for each line with a word, and the lines' lengths in characters."""
    rows: list[list[int]] = []
    lengths: list[int] = []
    seen: set[bytes] = set()
    for line in (text or "").split("\n"):
        raw = line.encode("utf-8", "surrogatepass")
        words = raw.split()
        n = len(words)
        if not n:
            continue
        size = len(raw.translate(None, _BLANKS))
        distinct = len(set(words))
        follow = sum(a == b for a, b in zip(words, words[1:], strict=False)) if distinct < n else 0
        symbols = size - len(raw.translate(None, _SYMBOLS + _BLANKS))
        digits = size - len(raw.translate(None, b"0123456789" + _BLANKS))
        bins = (
            _grade(symbols / size, (0.0, 0.01, 0.03, 0.08, 0.15, 0.3)),
            _grade(raw.count(b"|") / n, (0.0, 0.05, 0.2, 0.4, 0.7)),
            _grade(raw.count(b"!") / n, (0.0, 0.05, 0.2, 0.5, 1.0)),
            (line.isupper() and n > 1) + 2 * line.islower(),
            _grade(distinct / n, (0.2, 0.4, 0.6, 0.75, 0.9, 0.999)),
            min(int(math.log2(n)), BINS - 1),
            _grade(len(line) / n, (3.0, 4.5, 6.0, 8.0, 11.0, 16.0)),
            _grade(digits / size, (0.0, 0.02, 0.1, 0.3, 0.6)),
            line.rstrip()[-1:] in ".!?\"')" and line.rstrip()[-1:] != "",
            raw in seen,
            _grade(follow / n, (0.0, 0.05, 0.2, 0.5)),
            _grade(max(map(len, words)), (4.0, 8.0, 16.0, 25.0, 40.0, 80.0)),
        )
        seen.add(raw)
        rows.append([g * BINS + int(b) for g, b in enumerate(bins)])
        lengths.append(len(line))
    return np.array(rows, np.int32).reshape(-1, GROUPS), np.array(lengths, np.int64)


class LineField:
    """Weights: own, previous and next line's features (good against bad), transitions, logistic curve."""

    def __init__(self):
        self.own, self.previous, self.next = np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES)
        self.turn = np.zeros((2, 2))  # from, to
        self.curve = (0.0, 0.0)
        self.prior = 0.5
        self.fitted = False

    def line_scores(self, bins: np.ndarray) -> np.ndarray:
        scores = self.own[bins].sum(axis=1)
        if len(bins):
            to_next, to_previous = self.previous[bins].sum(axis=1), self.next[bins].sum(axis=1)
            scores[1:] += to_next[:-1]
            scores[:-1] += to_previous[1:]
            scores[0] += self.previous[EDGE]
            scores[-1] += self.next[EDGE]
        return scores

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        """Probability that each line of one text is good, by forward-backward."""
        good = [math.exp(min(max(s, -30.0), 30.0)) for s in scores]
        (bb, bg), (gb, gg) = np.exp(self.turn).tolist()
        forward: list[tuple[float, float]] = []
        b, g = 1.0, good[0]
        for t, e in enumerate(good):
            if t:
                b, g = b * bb + g * gb, (b * bg + g * gg) * e
            total = b + g
            b, g = b / total, g / total
            forward.append((b, g))
        out = np.empty(len(good))
        back_b = back_g = 1.0
        for t in range(len(good) - 1, -1, -1):
            b, g = forward[t]
            b, g = b * back_b, g * back_g
            out[t] = g / (b + g)
            e = good[t]
            back_b, back_g = bb * back_b + bg * e * back_g, gb * back_b + gg * e * back_g
            total = back_b + back_g
            back_b, back_g = back_b / total, back_g / total
        return out

    def mean(self, bins: np.ndarray, lengths: np.ndarray) -> float:
        return float(np.average(self.marginals(self.line_scores(bins)), weights=lengths))

    def score(self, text: str | None) -> float:
        bins, lengths = line_features(text)
        if not len(bins) or not self.fitted:
            return self.prior
        slope, offset = self.curve
        return 1 / (1 + math.exp(-min(max(slope * self.mean(bins, lengths) + offset, -30.0), 30.0)))

    # --- fitting ------------------------------------------------------------------------------------

    def fit(self, texts: list[tuple[np.ndarray, np.ndarray]], quality: list[int]) -> LineField:
        if texts or quality:
            self.prior = sum(quality) / len(quality)
        pairs = [(b, n, q) for (b, n), q in zip(texts, quality, strict=True) if len(b)]
        if len({q for *_, q in pairs}) < 2:
            return self
        pairs.sort(key=lambda x: -len(x[0]))
        lines = [np.full(len(b), q) for b, _, q in pairs]
        for turn in range(ROUNDS + 1):
            self._climb([b for b, *_ in pairs], lines, STEPS if turn == 0 else STEPS // 2)
            if turn < ROUNDS:
                for i, (b, _, q) in enumerate(pairs):
                    if q == 0:
                        good = self.marginals(self.line_scores(b))
                        lines[i] = (good > 0.5).astype(int)
                        lines[i][np.argmin(good)] = 0
        means = np.array([self.mean(b, n) for b, n, _ in pairs])
        labels = np.array([q for *_, q in pairs], float)
        self.curve = _logistic(means, labels)
        self.fitted = True
        return self

    def _climb(self, bins: list[np.ndarray], lines: list[np.ndarray], steps: int) -> None:
        """Gradient ascent (Adam) on the likelihood of the lines' labels; texts come longest first."""
        sizes = np.array([len(b) for b in bins])
        starts = np.concatenate(([0], np.cumsum(sizes)))
        flat, labels = np.concatenate(bins), np.concatenate(lines)
        text = np.repeat(np.arange(len(bins)), sizes)
        within = np.arange(len(flat)) - starts[text]
        before = np.where(within[:, None] > 0, np.roll(flat, 1, axis=0), EDGE)
        behind = np.where((within < sizes[text] - 1)[:, None], np.roll(flat, -1, axis=0), EDGE)
        # an edge counts once, not once a group
        before[within == 0, 1:] = -1
        behind[within == sizes[text] - 1, 1:] = -1
        deepest = int(sizes[0])
        active = np.array([(sizes > t).sum() for t in range(deepest)])
        weights = [self.own, self.previous, self.next, self.turn]
        layers = (flat, before, behind)

        def total(w: np.ndarray, layer: np.ndarray) -> np.ndarray:
            return np.append(w, 0.0)[layer].sum(axis=1)

        def counted(values: np.ndarray, layer: np.ndarray) -> np.ndarray:
            return np.bincount(
                np.where(layer < 0, FEATURES, layer).ravel(), np.repeat(values, layer.shape[1]), FEATURES + 1
            )[:FEATURES]

        observed = np.zeros((2, 2))
        inner = within > 0
        np.add.at(observed, (np.roll(labels, 1)[inner], labels[inner]), 1)
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        n = len(flat)
        for step in range(1, steps + 1):
            score = sum(total(w, layer) for w, layer in zip(weights[:3], layers, strict=True))
            emit = np.stack([np.ones(n), np.exp(np.clip(score, -30, 30))], axis=1)
            move = np.exp(self.turn)
            forward, back = np.empty((n, 2)), np.ones((n, 2))
            for t in range(deepest):
                at = starts[: active[t]] + t
                f = emit[at] if t == 0 else (forward[at - 1] @ move) * emit[at]
                forward[at] = f / f.sum(axis=1, keepdims=True)
            expected = np.zeros((2, 2))
            for t in range(deepest - 2, -1, -1):
                at = starts[: active[t + 1]] + t
                ahead = emit[at + 1] * back[at + 1]
                b = ahead @ move.T
                back[at] = b / b.sum(axis=1, keepdims=True)
                joint = forward[at][:, :, None] * move * ahead[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            good = forward * back
            off = labels - good[:, 1] / good.sum(axis=1)
            slopes = [counted(off, layer) for layer in layers] + [observed - expected]
            for k, (w, g) in enumerate(zip(weights, slopes, strict=True)):
                g = g / n - DECAY * w
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w += RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by damped Newton steps with a small ridge."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - 0.01 * w
        bend = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        w = w + move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def _features_frame(rows: DataFrame) -> DataFrame:
    """(quality, bins flat, lengths) of (quality, text)."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(v.as_py()) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([b.ravel() for b, _ in found], pa.list_(pa.int32())),
                    pa.array([n for _, n in found], pa.list_(pa.int64())),
                ],
                names=["quality", "bins", "lengths"],
            )

    return rows.mapInArrow(extract, "quality int, bins array<int>, lengths array<long>")


def learn_quality(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", quality: str = "quality", per_class: int = PER_CLASS
) -> LineField:
    """A field fitted on at most ``per_class`` texts of each label (0 and 1).

    The texts are those with the smallest hashes of id and text, however the rows are partitioned; rows without an id
    are not learned from.
    """
    few = None
    for label in (0, 1):
        own = labels.where((F.col(quality) == label) & F.col(key).isNotNull()).select(
            F.col(key).alias("__id"), F.col(quality).cast("int").alias("quality")
        )
        own = own.orderBy(F.xxhash64("__id"), "__id").limit(per_class)
        # at most per_class ids; an id with several texts may bring more
        texts = docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))
        sample = texts.join(F.broadcast(own), F.col("__key") == F.col("__id"))
        sample = sample.orderBy(F.xxhash64("__id", "text"), "__id", "text").limit(per_class).select("quality", "text")
        few = sample if few is None else few.unionByName(sample)
    rows = _features_frame(few).collect()
    rows.sort(key=lambda r: (r["quality"], r["bins"]))
    texts = [
        (np.array(r["bins"], np.int32).reshape(-1, GROUPS), np.array(r["lengths"], np.int64)) for r in rows
    ]
    return LineField().fit(texts, [r["quality"] for r in rows])


def score_quality(docs: DataFrame, field: LineField, *, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in the column ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = [c for c in docs.columns if c != into]
    schema = T.StructType([docs.schema[n] for n in names] + [T.StructField(into, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            scores = [field.score(v.as_py()) for v in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores, pa.float64())], names=schema.names
            )

    return docs.mapInArrow(score, schema)


def held_out(crc: Column) -> Column:
    return crc % 5 == 0
