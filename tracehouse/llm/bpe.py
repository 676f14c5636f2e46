"""Byte-pair encoding and decoding with a pair occurrence index.

The distinct pieces of a batch are laid out as one chain of symbols. The index maps each pair of
neighbouring symbols to all its positions; the lowest rank present is applied at all of them, which
removes and adds positions of the neighbouring pairs, until no pair with a rank is left. A worker
remembers what it has encoded, the parts that it met most often beyond a limit.

Defined results: a null text is encoded as the empty one (no ids, empty decoded text); null ids,
repeated rows and further columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tracehouse.llm.common import pieces_by_bytes
from tracehouse.llm.merge_replay import DECODE_IDS, Memory, ranges
from tracehouse.llm.token_counts import STABLE, load_tokenizer

BATCH_BYTES = 4 << 20  # text handled together
INDEX_BYTES = 1 << 20  # new pieces that share one index; a longer piece has one of its own
REMEMBERED = 200_000  # parts, and pieces, that a worker remembers
_CONTROL_BLANKS = re.compile("[\x1c-\x1f]")  # blanks for Python, but not for the tokenizer
NONE = -1


def byte_symbols() -> list[str]:
    """Character that stands for each byte: printable ones for themselves, others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class PairIndex:
    """Merges of a vocabulary, applied to many pieces at once."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], end: str):
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + end] for s in symbols], np.int64)
        self.width = max(vocab.values()) + 1
        self.rank: dict[int, int] = {}
        self.pairs: list[int] = []
        self.merged: list[int] = []
        made: dict[int, int] = {}
        for r, (a, b) in enumerate(merges):
            left, right, new = vocab[a], vocab[b], vocab[a + b]
            if max(made.get(left, NONE), made.get(right, NONE)) >= r:
                raise ValueError("a merge uses a symbol that a later merge makes")
            made.setdefault(new, r)
            self.rank[left * self.width + right] = r
            self.pairs.append(left * self.width + right)
            self.merged.append(new)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces (bytes, not empty), one after the other, and their number for each piece."""
        ids, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        start = 0
        while start < len(pieces):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + INDEX_BYTES, "right")))
            found, counts = self._merged(pieces[start:stop])
            ids.append(found)
            sizes.append(counts)
            start = stop
        return np.concatenate(ids), np.concatenate(sizes)

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same through one index."""
        width, rank = self.width, self.rank
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        starts = np.concatenate([[0], ends[:-1]])
        size = len(data)
        symbols = self.inner[data]
        symbols[ends - 1] = self.final[data[ends - 1]]
        follows, leads = np.arange(1, size + 1), np.arange(-1, size - 1)
        follows[ends - 1] = leads[starts] = NONE
        symbol, after, before = symbols.tolist(), follows.tolist(), leads.tolist()

        where: dict[int, list[int]] = {}  # rank -> positions of its pair's left symbol
        pairs, kind = np.unique(symbols[:-1] * width + symbols[1:], return_inverse=True)
        ranks = np.array([rank.get(p, NONE) for p in pairs.tolist()], np.int64)[kind]
        ranks[ends[:-1] - 1] = NONE
        at = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks == NONE) :]
        if len(at):
            found, cuts = np.unique(ranks[at], return_index=True)
            where = {r: p.tolist() for r, p in zip(found.tolist(), np.split(at, cuts[1:]), strict=True)}
        active = list(where)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            pair, new = self.pairs[r], self.merged[r]
            left, right = divmod(pair, width)
            for at in sorted(where.pop(r)):
                follower = after[at]
                # stale entries: one of the two symbols has been merged since
                if symbol[at] != left or follower == NONE or symbol[follower] != right:
                    continue
                symbol[at], symbol[follower] = new, NONE
                beyond = after[at] = after[follower]
                if beyond != NONE:
                    before[beyond] = at
                    q = rank.get(new * width + symbol[beyond])
                    if q is not None:
                        if q in where:
                            where[q].append(at)
                        else:
                            where[q] = [at]
                            heapq.heappush(active, q)
                ahead = before[at]
                if ahead != NONE:
                    q = rank.get(symbol[ahead] * width + new)
                    if q is not None:
                        if q in where:
                            where[q].append(ahead)
                        else:
                            where[q] = [ahead]
                            heapq.heappush(active, q)
        symbols = np.array(symbol, np.int32)
        stays = symbols != NONE
        return symbols[stays], np.add.reduceat(stays, starts, dtype=np.int64)


class WordBpe:
    """Encoder and decoder of a tokenizer definition of the word-end family."""

    def __init__(self, definition: str):
        parts = json.loads(definition)
        model = parts["model"]
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        if (
            model["type"] != "BPE"
            or kinds != ["NFC", "Replace", "Lowercase"]
            or parts["decoder"] is not None
            or not model["end_of_word_suffix"]
        ):
            raise ValueError("not a tokenizer of the lower-casing word-end family without decoder")
        self.index = PairIndex(
            model["vocab"],
            [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]],
            model["end_of_word_suffix"],
        )
        self.library = load_tokenizer(definition)  # cuts texts with characters of recent Unicode versions
        self.pattern = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"]):
            raise ValueError("only plain added tokens are supported")
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        # names of all ids, each with a blank behind it
        names = {i: (name + " ").encode() for name, i in chain(model["vocab"].items(), self.special.items())}
        every = [names.get(i, b" ") for i in range(max(names) + 1)]
        self.name_sizes = np.fromiter(map(len, every), np.int64, len(every))
        self.name_starts = np.cumsum(self.name_sizes) - self.name_sizes
        self.names = np.frombuffer(b"".join(every), np.uint8)
        self.parts, self.known = Memory(), Memory()

    def pieces(self, part: str) -> list[str]:
        """Normalised pieces of a text."""
        if STABLE.fullmatch(part) is None:
            text = self.library.normalizer.normalize_str(part)
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        text = unicodedata.normalize("NFC", part)
        # character by character: the tokenizer knows no final sigma
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return self.pattern.findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number for each text.

        All texts' new pieces go through one index. A special string is a part of its own: no other part holds one.
        """
        numbers = self.parts.numbers
        cut = []
        for text in texts:
            if self.marks.search(text):
                segments, at = [], 0
                for mark in self.marks.finditer(text):
                    segments += [*self._parts(text[at : mark.start()]), mark[0]]
                    at = mark.end()
                segments += self._parts(text[at:])
            else:
                segments = self._parts(text)
            cut.append(np.fromiter(map(numbers.__getitem__, segments), np.int32, len(segments)))
        self._learn()
        asked = np.concatenate([*cut, np.empty(0, np.int32)])
        self.parts.asked += np.bincount(asked, minlength=len(self.parts.asked))
        ids, sizes = self.parts.of(asked)
        totals = np.bincount(np.repeat(np.arange(len(cut)), [len(c) for c in cut]), sizes, len(cut)).astype(np.int64)
        self.parts.forget(REMEMBERED)
        self.known.forget(REMEMBERED)
        return ids, totals

    def _learn(self) -> None:
        """Encode the parts that were met for the first time."""
        known, counts, numbers = self.known, [], []
        for part in self.parts.numbers.fresh:
            found = [part] if part in self.special else self.pieces(part)
            counts.append(len(found))
            numbers += map(known.numbers.__getitem__, found)
        fresh = known.numbers.fresh
        special = np.array([self.special.get(p, NONE) for p in fresh], np.int64)
        ids, sizes = self.index.encode([p.encode() for p in fresh if p not in self.special])
        lengths = np.ones(len(fresh), np.int64)
        lengths[special == NONE] = sizes
        every = np.empty(int(lengths.sum()), np.int32)
        plain = np.repeat(special == NONE, lengths)
        every[plain], every[~plain] = ids, special[special != NONE]
        known.learn(every, lengths)
        asked = np.array(numbers, np.int64)
        np.add.at(known.asked, asked, 1)
        flat, sizes = known.of(asked)
        of_part = np.zeros(len(counts), np.int64)
        np.add.at(of_part, np.repeat(np.arange(len(counts)), counts), sizes)
        self.parts.learn(flat, of_part)

    @staticmethod
    def _parts(text: str) -> list[str]:
        # pieces hold no blanks, so the text may be cut at them
        return [text] if _CONTROL_BLANKS.search(text) else text.split()

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """Texts of consecutive ids, ``lengths`` for each text.

        Without a decoder, the library joins the tokens' names by blanks.
        """
        parts = [
            self.names[ranges(self.name_starts[own], self.name_sizes[own])]
            for own in (ids[i : i + DECODE_IDS] for i in range(0, len(ids), DECODE_IDS))
        ]
        data = np.concatenate([*parts, np.empty(0, np.uint8)])
        at = np.concatenate([[0], np.cumsum(self.name_sizes[ids])])[np.concatenate([[0], np.cumsum(lengths)])]
        texts = pa.Array.from_buffers(
            pa.binary(), len(lengths), [None, pa.array(at, pa.int32()).buffers()[1], pa.py_buffer(data.tobytes())]
        )
        return pc.binary_slice(texts, 0, -1).cast(pa.string())


_coders: dict[str, WordBpe] = {}


def coder_of(definition: str) -> WordBpe:
    """One coder a worker: its memory serves all tasks."""
    if definition not in _coders:
        _coders.clear()
        _coders[definition] = WordBpe(definition)
    return _coders[definition]


def encode_decode(
    docs: DataFrame, tokenizer_path: str, *, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``docs`` without their texts, with each whole text's ids and the text that these decode to."""
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    coder_of(definition)  # a wrong definition fails here
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    keep = [f for f in docs.schema if f.name not in (text, ids, decoded)]
    schema = T.StructType(
        [*keep, T.StructField(ids, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded, T.StringType())]
    )
    names = [f.name for f in keep]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared.value)
        for whole in batches:
            for batch in pieces_by_bytes(whole, text, BATCH_BYTES):
                found, sizes = coder.encode(["" if t is None else t for t in batch.column(text).to_pylist()])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32()))
                back = coder.decode(found, sizes)
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), lists, back], names=schema.names)

    return docs.mapInArrow(code, schema)
