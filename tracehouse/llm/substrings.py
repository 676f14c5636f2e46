"""Passages of WINDOW words that a text with a smaller id already holds, removed through suffix automata.

A suffix automaton of every reference text, sent to every task, would grow with the corpus. Here automata
are built of small reference shards, and each meets only the passages that need it:

* Anchors: of each window's ANCHOR-word runs the one with the smallest hash. Equal windows have equal
  anchors, and only about one word in (WINDOW - ANCHOR) / 2 starts one. Anchors that two texts share tell
  which windows can repeat at all; for those, an aggregate finds the first text that holds each window.
* Shards: a first text's shared windows, in blocks of BLOCK window starts. The automaton of a shard's passages
  reads the passages of other texts that were dealt to it; where its matching statistic reaches WINDOW words,
  the last WINDOW words are removed. The words themselves decide, hashes only route. Shards that many texts
  need are built in several tasks.
* Texts with the very same words as an earlier one are settled by their digest, and take no further part.

Defined results: a null text has no words; texts shorter than a window lose nothing; rows with equal ids do
not affect each other, nor do rows with null ids; further columns are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.llm.common import Stage, mix, powers, word_hashes

WINDOW = 50
ANCHOR = 20
BLOCK = 4096  # window starts in a reference shard
PIECES_PER_TASK = 1_000  # passages read by one copy of a shard's automaton

_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))


class SuffixAutomaton:
    """Automaton of all substrings of the passages fed to it (lists of words)."""

    def __init__(self):
        self.follow: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.passages = 0

    def feed(self, passage: list[bytes]) -> None:
        last = 0
        self.passages += 1
        # a mark of its own in front keeps matches from running across passages
        for word in (self.passages, *passage):
            last = self._extend(last, word)

    def _extend(self, last: int, word) -> int:
        follow, link, length = self.follow, self.link, self.length
        if word in follow[last]:
            q = follow[last][word]
            return q if length[q] == length[last] + 1 else self._split(last, q, word)
        new = len(length)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and word not in follow[p]:
            follow[p][word] = new
            p = link[p]
        if p != -1:
            q = follow[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, q, word)
        return new

    def _split(self, p: int, q: int, word) -> int:
        copy = len(self.length)
        self.follow.append(self.follow[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p != -1 and self.follow[p].get(word) == q:
            self.follow[p][word] = copy
            p = self.link[p]
        return copy

    def matching(self, passage: list[bytes]) -> Iterator[int]:
        """Matching statistic at each word: length of the longest suffix up to it that was fed."""
        follow, link, length = self.follow, self.link, self.length
        state = size = 0
        for word in passage:
            while state and word not in follow[state]:
                state = link[state]
                size = length[state]
            if word in follow[state]:
                state = follow[state][word]
                size += 1
            else:
                size = 0
            yield size

    def long_spans(self, passage: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal spans (start, end) covered by matches of ``least`` words or more."""
        spans: list[tuple[int, int]] = []
        for at, size in enumerate(self.matching(passage)):
            if size >= least:
                start, end = at + 1 - least, at + 1
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((start, end))
        return spans


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, from sums over all words before."""
    n = len(hashes)
    if n < size:
        return np.empty(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers(n, _FACTOR), dtype=np.uint64)))
    return mix((sums[size:] - sums[:-size]) * powers(n - size + 1, _INVERSE))


def _anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ANCHOR-word runs, and for each window the place of its smallest one."""
    runs = _runs(hashes, ANCHOR)
    span = WINDOW - ANCHOR + 1
    if len(runs) < span:
        return runs, np.empty(0, np.int64)
    inside = np.lib.stride_tricks.sliding_window_view(runs, span)
    return runs, np.arange(len(inside)) + inside.argmin(axis=1)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, anchors = [], [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            words = text.encode().split()
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            runs, places = _anchors(word_hashes(text))
            anchors.append(np.unique(runs[places]).view(np.int64) if len(places) else np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc"),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(anchors, pa.list_(pa.int64())),
            ],
            names=["row", "doc", "n_words", "digest", "anchors"],
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows whose anchor is shared: (window, row, doc, place)."""
    for batch in batches:
        for row, doc, text, shared in zip(
            batch.column("row").to_pylist(), batch.column("doc").to_pylist(), batch.column("text"), batch.column("shared"), strict=True
        ):
            hashes = word_hashes(text.as_py())
            runs, places = _anchors(hashes)
            wanted = shared.values.to_numpy().view(np.uint64)
            at = np.flatnonzero(np.isin(runs[places], wanted))
            found = _runs(hashes, WINDOW)[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.view(np.int64)),
                    pa.array(np.full(len(at), row, np.int64)),
                    pa.array(np.full(len(at), doc, np.int64)),
                    pa.array(at.astype(np.int32)),
                ],
                names=["window", "row", "doc", "place"],
            )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of neighbouring windows with one shard: passages to read, and those to build it from."""
    names = ["doc", "block", "role", "row", "start", "words"]
    for batch in batches:
        out: list[tuple] = []
        columns = (batch.column(n).to_pylist() for n in ("row", "doc", "text"))
        for row, doc, text, found in zip(*columns, batch.column("found"), strict=True):
            words = text.encode().split()
            held = found.values
            place, first, block = (held.field(i).to_numpy() for i in range(3))
            order = np.argsort(place, kind="stable")
            place, first, block = place[order], first[order], block[order]
            cuts = np.flatnonzero((np.diff(place) != 1) | (np.diff(first) != 0) | (np.diff(block) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)], strict=True):
                start = int(place[a])
                passage = b" ".join(words[start : int(place[b - 1]) + WINDOW]).decode()
                role = 0 if first[a] == doc else 1
                out.append((int(first[a]), int(block[a]), role, row, start, passage))
        yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], _PIECE)


_PIECE = pa.schema(
    [("doc", pa.int64()), ("block", pa.int32()), ("role", pa.int32()), ("row", pa.int64()), ("start", pa.int32()), ("words", pa.string())]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of each shard through its automaton: (row, start, end) to remove."""
    current, automaton = None, SuffixAutomaton()
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        columns = (batch.column(n).to_pylist() for n in ("doc", "block", "part", "role", "row", "start", "words"))
        for doc, block, part, role, row, start, words in zip(*columns, strict=True):
            if (doc, block, part) != current:
                current, automaton = (doc, block, part), SuffixAutomaton()
            passage = words.encode().split(b" ")
            if role == 0:
                automaton.feed(passage)
            else:
                out += [(row, start + a, start + b) for a, b in automaton.long_spans(passage, WINDOW)]
        rows, starts, ends = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            names=["row", "start", "end"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, removed = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            words = text.as_py().encode().split()
            merged: list[list[int]] = []
            for span in sorted((s["start"], s["end"]) for s in spans.as_py()):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                else:
                    merged.append(list(span))
            kept, at = [], 0
            for start, end in merged:
                kept += words[at:start]
                at = end
            kept += words[at:]
            counts.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            removed.append([{"start": a, "end": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            names=["row", "n_removed", "kept_sha256", "removed"],
        )


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, n_words, n_removed, kept_sha256, removed): word spans to remove, one row for each row of ``docs``."""
    stage = Stage(docs.sparkSession, "substrings")
    body = F.coalesce(F.col(text), F.lit(""))
    # equal rows have equal results, so a hash of id and text names a row
    rows = docs.select(F.xxhash64(F.col(key), body).alias("row"), F.col(key).cast("long").alias("doc"), body.alias("text"))
    surveyed = stage(
        rows.mapInArrow(_survey, "row long, doc long, n_words long, digest string, anchors array<long>")
    )
    # the first of the texts with the very same words stands for all
    firsts = stage(
        surveyed.where(F.col("doc").isNotNull() & (F.col("n_words") >= WINDOW))
        .groupBy("digest")
        .agg(F.min(F.struct("doc", "row")).alias("f"), F.first("anchors").alias("anchors"))
        .select("digest", F.col("f.doc").alias("doc"), F.col("f.row").alias("row"), "anchors")
    )
    anchors = firsts.select("doc", "row", F.explode("anchors").alias("anchor"))
    shared = stage(
        anchors.groupBy("anchor")
        .agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
        .where(F.col("lo") < F.col("hi"))
        .select("anchor")
    )
    touched = stage(
        anchors.join(shared, "anchor").groupBy("row", "doc").agg(F.collect_set("anchor").alias("shared"))
    )
    texts = stage(
        rows.select("row", "text").join(touched, "row").dropDuplicates(["row"]).select("row", "doc", "text", "shared")
    )
    stage.drop(shared, touched)
    windows = stage(texts.mapInArrow(_windows, "window long, row long, doc long, place int"))
    held = stage(
        windows.groupBy("window")
        .agg(F.min(F.struct("doc", "place")).alias("f"), F.max("doc").alias("hi"))
        .where(F.col("f.doc") < F.col("hi"))
        .select("window", F.col("f.doc").alias("first"), (F.col("f.place") / BLOCK).cast("int").alias("block"))
    )
    found = (
        windows.join(held, "window")
        .groupBy("row")
        .agg(F.collect_list(F.struct("place", "first", "block")).alias("found"))
    )
    pieces = stage(
        texts.select("row", "doc", "text")
        .join(found, "row")
        .mapInArrow(_pieces, "doc long, block int, role int, row long, start int, words string")
    )
    stage.drop(windows, held)
    sizes = stage(
        pieces.where("role = 1")
        .groupBy("doc", "block")
        .agg(F.ceil(F.count("*") / PIECES_PER_TASK).alias("parts"))
    )
    sized = pieces.join(sizes, ["doc", "block"])
    part = F.when(F.col("role") == 1, F.array(F.pmod(F.xxhash64("row", "start"), F.col("parts")))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    )
    dealt = (
        sized.withColumn("part", F.explode(part))
        .repartition("doc", "block", "part")
        .sortWithinPartitions("doc", "block", "part", "role")
    )
    spans = dealt.mapInArrow(_read, "row long, start int, end int")
    by_row = stage(spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    stage.drop(pieces, sizes)
    cut = stage(
        texts.select("row", "text")
        .join(by_row, "row")
        .mapInArrow(
            _cut, "row long, n_removed long, kept_sha256 string, removed array<struct<start:int,end:int>>"
        )
    )
    stage.drop(texts, by_row)
    settled = stage(
        firsts.select("row", F.col("digest").alias("__digest"), F.col("doc").alias("__first"))
        .join(cut, "row", "left")
        .drop("row")
    )
    stage.drop(firsts, cut)
    copy = F.col("doc") > F.col("__first")
    joined = surveyed.drop("anchors", "row").join(
        settled, (F.col("digest") == F.col("__digest")) & F.col("doc").isNotNull(), "left"
    )
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return joined.select(
        F.col("doc").alias(key),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("kept_sha256", "digest"))
        .alias("kept_sha256"),
        F.when(copy, everything).otherwise(F.coalesce("removed", nothing)).alias("removed"),
    )
