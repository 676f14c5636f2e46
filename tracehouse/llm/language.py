"""Language of a text by rank-order profiles.

A profile is the list of a language's PROFILE most frequent n-grams of letters (one to three, with a
mark at word edges). A text gets the language whose ranks differ least from its own ranks, summed
over the text's most frequent n-grams; an n-gram missing in the profile counts PROFILE. Equal counts
share their mean rank.

Profiles are learned from a bounded sample, PER_LANGUAGE texts of each language, chosen by a hash of
the id. Every text is predicted as a whole.

Defined results: a null text, or one without letters, is ``und`` with score 0; so is every text if
nothing could be learned. Equal distances go to the language that sorts first. Null ids, repeated rows
and further columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER_LANGUAGE = 2_000  # texts a language's profile is learned from
PROFILE = 400
LANES = 64  # parts of a language; each keeps its lowest hashes before they meet
UNKNOWN = "und"
EDGE, OTHER = 0, 1  # codes of a word's edge and of letters in no profile


def _grams(text: str) -> Iterator[str]:
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    for word in letters.split():
        yield from word
        padded = f" {word} "
        for size in (2, 3):
            yield from (padded[i : i + size] for i in range(len(padded) - size + 1))


def learn_profiles(
    labelled: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE
) -> dict[str, list[str]]:
    """Profiles by language. One row a language and its n-grams come to the driver, nothing else."""
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("__h"))
    lane = Window.partitionBy("lang", "__lane").orderBy("__h")
    order = Window.partitionBy("lang").orderBy("__h")
    # a language's lowest hashes are among its lanes' lowest: no task gets more than LANES * per_language of one
    cuts = (
        rows.select("lang", "__h", F.pmod("__h", F.lit(LANES)).alias("__lane"))
        .withColumn("__n", F.row_number().over(lane))
        .where(F.col("__n") <= per_language)
        .withColumn("__n", F.row_number().over(order))
        .where(F.col("__n") <= per_language)
        .groupBy("lang")
        .agg(F.max("__h").alias("__cut"))
    )
    # one row a language
    sample = rows.join(F.broadcast(cuts), "lang").where(F.col("__h") <= F.col("__cut")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter[str]] = {}
        for batch in batches:
            for language, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(language, Counter()).update(_grams(body))
        for language, grams in seen.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [language] * len(grams), "gram": list(grams), "n": list(grams.values())}
            )

    counted = sample.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("r", F.row_number().over(best)).where(F.col("r") <= PROFILE)
    profiles: dict[str, list[str]] = {}
    for row in top.orderBy("lang", "r").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class RankOrder:
    """Profiles as arrays, for texts as arrays of letter codes."""

    def __init__(self, profiles: dict[str, list[str]]):
        self.languages = sorted(profiles)
        letters = sorted({c for grams in profiles.values() for g in grams for c in g if c != " "})
        code = {" ": EDGE} | {c: i + 2 for i, c in enumerate(letters)}
        self.base = len(letters) + 2
        self.codes = np.zeros(0x110000, np.int32)
        for point in range(0x110000):
            if chr(point).isalpha():
                self.codes[point] = OTHER
        for c in letters:
            self.codes[ord(c)] = code[c]

        def number(gram: str) -> int:
            value = 0
            for c in gram:
                value = value * self.base + code[c]
            return value + self._offset(len(gram))

        known = sorted({number(g) for grams in profiles.values() for g in grams})
        self.known = np.array(known, np.int64)
        at = {g: i for i, g in enumerate(known)}
        # missing n-grams are told apart by their rank, which no n-gram has
        self.ranks = np.full((len(self.languages), len(known)), -1.0)
        for row, language in enumerate(self.languages):
            for rank, gram in enumerate(profiles[language]):
                self.ranks[row, at[number(gram)]] = rank

    def _offset(self, size: int) -> int:
        return {1: 0, 2: self.base, 3: self.base + self.base**2}[size]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.empty(len(points) + 2, np.int64)
        codes[0] = codes[-1] = EDGE
        codes[1:-1] = self.codes[points]
        inside = codes != EDGE
        if not inside.any():
            return UNKNOWN, 0.0
        keep = inside.copy()
        keep[1:] |= inside[:-1]  # one edge behind each word
        codes = np.concatenate(([EDGE], codes[keep]))
        two = codes[:-1] * self.base + codes[1:] + self._offset(2)
        three = (codes[:-2] * self.base + codes[1:-1]) * self.base + codes[2:] + self._offset(3)
        grams = np.concatenate((codes[codes != EDGE], two, three[codes[1:-1] != EDGE]))
        grams.sort()
        first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
        counts = np.diff(np.append(first, len(grams)))
        grams = grams[first]
        if len(grams) > PROFILE:
            # with all n-grams that are as frequent as the last one
            least = np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
            grams, counts = grams[counts >= least], counts[counts >= least]
        order = np.argsort(-counts, kind="stable")
        ordered = -counts[order]
        low = np.searchsorted(ordered, ordered, "left")
        high = np.searchsorted(ordered, ordered, "right")
        own = np.empty(len(grams))
        own[order] = (low + high - 1) / 2
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        found = self.known[at] == grams
        ranks = self.ranks[:, at[found]]
        apart = np.where(ranks < 0, PROFILE, np.minimum(np.abs(ranks - own[found]), PROFILE))
        distance = apart.sum(axis=1) + PROFILE * (len(grams) - found.sum())
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (PROFILE * len(grams)))


_ready: list[tuple[dict, RankOrder]] = []


def _rank_order(profiles: dict[str, list[str]]) -> RankOrder:
    """The arrays of these profiles, built once a worker."""
    if not _ready or _ready[0][0] != profiles:
        _ready[:] = [(profiles, RankOrder(profiles))]
    return _ready[0][1]


def predict_language(docs: DataFrame, profiles: dict[str, list[str]], *, text: str = "text") -> DataFrame:
    """``docs`` without their texts, with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    names = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    schema = T.StructType(
        [docs.schema[n] for n in names] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _rank_order(shared.value)
        for batch in batches:
            found = [model.predict(v.as_py()) for v in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(predict, schema)


def held_out(crc: Column) -> Column:
    return crc % 4 == 2
