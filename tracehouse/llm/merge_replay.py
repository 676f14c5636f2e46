"""Byte-level BPE encoding and decoding by replaying all merges over the words of the corpus.

Each task takes its share of the corpus in stretches. The words of a stretch that its worker does not know yet
are laid out as one chain of bytes. An inverted index maps the rank of every pair of neighbours to the positions of
that pair; merges are applied in the order of their ranks, each at all of its positions, and only the neighbours of a
merged pair are looked at again. Texts are then put together from the ids of their words, and ids are decoded by
gathering the bytes of their tokens. Texts are never shuffled.

Two properties of rank files are kept. A word that is a token itself is that token, whatever its merges give. And a
merge may make a pair of a lower rank than its own: the word then waits until that pair has been merged.

Defined results: a null text is encoded as the empty one (no ids, no bytes); null ids, repeated rows and further columns
are kept as they are, except columns with the names of the results; an empty table gives no rows. Texts of any length
are encoded whole. Null ids lists decode to null, and an id without a token fails.
"""

from __future__ import annotations

import base64
import heapq
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tracehouse.llm.common import pieces_by_bytes
from tracehouse.llm.token_counts import STABLE

STRETCH_BYTES = 8 << 20  # text whose new words share one index; a longer text is a stretch of its own
KNOWN = 400_000  # parts of texts a worker remembers, and as many words
LONGEST = 64  # longer ones are forgotten after their stretch
DECODE_IDS = 1 << 18  # ids decoded together

NONE = -1
_DOUBLE = re.compile(r" (?=\s|\Z)")  # blanks that may belong together with what follows
# A blank may be cut off in front of its word if no other blank could join it there.
_CUT = re.compile(r"(?<=\S) | (?=\S)")
_STABLE_CHARACTER = re.compile(STABLE.pattern.removesuffix("*"))


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start … start+length-1 of every item, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class Merges:
    """Tokens of a rank file and the pairs that make them."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)) or min(ranks.values()) < 0:
            raise ValueError("a byte has no token, or a rank is negative")
        if len(set(ranks.values())) != len(ranks):
            raise ValueError("two tokens share a rank")
        self.ranks = ranks
        self.width = max(ranks.values()) + 1
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.made: dict[int, int] = {}  # pair of tokens -> the token that they make
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.made[left * self.width + right] = rank
        self.first = np.full((256, 256), NONE, np.int64)  # the same for two bytes
        for token, rank in ranks.items():
            if len(token) == 2:
                self.first[token[0], token[1]] = rank
        lengths = np.full(self.width, NONE, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        self.lengths = lengths
        self.starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
        self.bytes = np.frombuffer(b"".join(t for t, _ in sorted(ranks.items(), key=lambda x: x[1])), np.uint8)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (not empty, no tokens themselves), one after the other, and their number for each word."""
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        width, made = self.width, self.made
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        starts = (ends - sizes).tolist()
        size = len(data)
        follows = np.arange(1, size + 1)
        follows[ends - 1] = NONE
        leads = np.arange(-1, size - 1)
        leads[starts] = NONE
        symbol, after, before = self.of_byte[data].tolist(), follows.tolist(), leads.tolist()

        # inverted index: rank -> positions of the left symbols of its pairs
        ranks = self.first[data[:-1], data[1:]]
        ranks[ends[:-1] - 1] = NONE
        at = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks == NONE) :]
        found, cuts = np.unique(ranks[at], return_index=True)
        where = {r: p.tolist() for r, p in zip(found.tolist(), np.split(at, cuts[1:]), strict=True)} if len(at) else {}
        active = list(where)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            positions = where.pop(rank, None)
            if positions is None:
                continue
            positions.sort()
            resume = 0  # positions below belong to a word that waits
            for left in positions:
                if left < resume:
                    where.setdefault(rank, []).append(left)
                    continue
                right = after[left]
                # entries go stale when one of the two symbols is merged with another one
                if right == NONE or symbol[left] == NONE or made.get(symbol[left] * width + symbol[right]) != rank:
                    continue
                symbol[left], symbol[right] = rank, NONE
                beyond = after[left] = after[right]
                waits = False
                if beyond != NONE:
                    before[beyond] = left
                    new = made.get(rank * width + symbol[beyond])
                    if new is not None:
                        if new in where:
                            where[new].append(left)
                        else:
                            where[new] = [left]
                            heapq.heappush(active, new)
                        waits = new < rank
                ahead = before[left]
                if ahead != NONE:
                    new = made.get(symbol[ahead] * width + rank)
                    if new is not None:
                        if new in where:
                            where[new].append(ahead)
                        else:
                            where[new] = [ahead]
                            heapq.heappush(active, new)
                        waits = waits or new < rank
                if waits:
                    word = bisect_right(starts, left)
                    resume = starts[word] if word < len(starts) else size
            if rank in where:
                heapq.heappush(active, rank)
        symbols = np.array(symbol, np.int32)
        left = symbols != NONE
        return symbols[left], np.add.reduceat(left, starts, dtype=np.int64)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, one after the other, and their number for each id."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.width or self.lengths[ids].min() < 0):
            raise ValueError("an id has no token")
        lengths = self.lengths[ids]
        parts = [
            self.bytes[ranges(self.starts[ids[i : i + DECODE_IDS]], lengths[i : i + DECODE_IDS])]
            for i in range(0, len(ids), DECODE_IDS)
        ]
        return np.concatenate(parts) if parts else np.empty(0, np.uint8), lengths


class Numbered(dict):
    """Numbers of texts' parts, given in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []
        self.next = 0

    def __missing__(self, part: str) -> int:
        number = self[part] = self.next
        self.next += 1
        self.fresh.append(part)
        return number


class Memory:
    """Ids of numbered parts. Beyond a limit, those asked for most often stay."""

    def __init__(self):
        self.numbers = Numbered()
        self.starts = self.lengths = self.asked = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def learn(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Ids of the fresh parts, in their order."""
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.asked = np.concatenate([self.asked, np.zeros(len(lengths), np.int64)])
        self.numbers.fresh = []

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, one after the other, and their number for each part."""
        lengths = self.lengths[numbers]
        return self.ids[ranges(self.starts[numbers], lengths)], lengths

    def forget(self, limit: int = KNOWN) -> None:
        """Drop long parts, and beyond ``limit`` the rarer half; what stays counts half from now on."""
        numbers = self.numbers
        stays = np.fromiter((len(part) <= LONGEST for part in numbers), bool, len(numbers))
        if len(numbers) > limit:
            rank = np.empty(len(numbers), np.int64)
            rank[np.argsort(-self.asked, kind="stable")] = np.arange(len(numbers))
            stays &= rank < limit // 2
        if stays.all():
            return
        kept = np.flatnonzero(stays)
        again = Numbered()
        again.update(zip((p for p, s in zip(numbers, stays.tolist(), strict=True) if s), range(len(kept)), strict=True))
        again.next = len(kept)
        self.ids, lengths = self.of(kept)
        self.numbers, self.lengths, self.starts = again, lengths, np.cumsum(lengths) - lengths
        self.asked = self.asked[kept] // 2


class ByteBpe:
    """Encoder and decoder of one rank file; what it has encoded serves all tasks of a worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges = Merges(ranks)
        self.source = pattern
        self.pattern = regex.compile(pattern)
        self.parts, self.heads, self.words = Memory(), Memory(), Memory()
        self.classes: dict[int, str] = {}

    def _learn_classes(self, text: str) -> None:
        """Ask the library for the class of characters that Unicode versions may tell apart otherwise.

        A character joins a letter, a digit or a sign in front of it only if it is one itself; with the joined text as a
        token of its own, the library's ids show whether it did.
        """
        import tiktoken

        new = sorted({c for c in text if ord(c) not in self.classes and not _STABLE_CHARACTER.fullmatch(c)})
        if not new:
            return
        ranks = {bytes([b]): b for b in range(256)}
        for kind in "a1!":
            for c in new:
                ranks.setdefault((kind + c).encode(), len(ranks))
        probe = tiktoken.Encoding("classes", pat_str=self.source, mergeable_ranks=ranks, special_tokens={})
        for c in new:
            self.classes[ord(c)] = next((k for k in "a1!" if len(probe.encode_ordinary(k + c)) == 1), " ")

    def split(self, text: str) -> list[str]:
        """Matches of the pattern, with the library's classes of characters."""
        if STABLE.fullmatch(text) is not None:
            return self.pattern.findall(text)
        self._learn_classes(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.classes))]

    def _encode_parts(self, memory: Memory, lead: str) -> None:
        """Learn the fresh parts of a memory; a part is preceded by ``lead``."""
        words, ranks = self.words, self.merges.ranks
        counts, numbers = [], []
        for part in memory.numbers.fresh:
            found = self.split(lead + part)
            counts.append(len(found))
            numbers += map(words.numbers.__getitem__, found)
        fresh = [w.encode() for w in words.numbers.fresh]
        whole = [ranks.get(w, NONE) for w in fresh]
        ids, lengths = self.merges.replay([w for w, token in zip(fresh, whole, strict=True) if token == NONE])
        # put replayed words and words that are tokens back into their order
        token = np.array(whole, np.int64)
        sizes = np.ones(len(fresh), np.int64)
        sizes[token == NONE] = lengths
        every = np.empty(int(sizes.sum()), np.int32)
        replayed = np.repeat(token == NONE, sizes)
        every[replayed] = ids
        every[~replayed] = token[token != NONE]
        words.learn(every, sizes)
        asked = np.array(numbers, np.int64)
        np.add.at(words.asked, asked, 1)
        flat, sizes = words.of(asked)
        of_part = np.zeros(len(counts), np.int64)
        np.add.at(of_part, np.repeat(np.arange(len(counts)), counts), sizes)
        memory.learn(flat, of_part)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number for each text."""
        heads, parts = self.heads, self.parts
        first = np.empty(len(texts), np.int64)
        rest = []
        for i, text in enumerate(texts):
            # a blank starts its word, so texts may be cut in front of single blanks
            head, *tail = _CUT.split(text) if _DOUBLE.search(text) else text.split(" ")
            first[i] = heads.numbers[head]
            rest.append(np.fromiter(map(parts.numbers.__getitem__, tail), np.int32, len(tail)))
        self._encode_parts(heads, "")
        self._encode_parts(parts, " ")
        counts = np.fromiter(map(len, rest), np.int64, len(rest))
        inner = np.concatenate(rest) if rest else np.empty(0, np.int32)
        parts.asked += np.bincount(inner, minlength=len(parts.asked))
        head_ids, head_sizes = heads.of(first)
        inner_ids, inner_sizes = parts.of(inner)
        # interleave: the head of a text, then its parts
        is_head = np.zeros(len(texts) + len(inner), bool)
        is_head[np.cumsum(counts + 1) - counts - 1] = True
        sizes = np.empty(len(is_head), np.int64)
        sizes[is_head], sizes[~is_head] = head_sizes, inner_sizes
        ids = np.empty(int(sizes.sum()), np.int32)
        from_head = np.repeat(is_head, sizes)
        ids[from_head], ids[~from_head] = head_ids, inner_ids
        totals = np.add.reduceat(sizes, np.flatnonzero(is_head)) if texts else np.empty(0, np.int64)
        self.heads = Memory()  # first words are rarely seen again
        self.parts.forget()
        self.words.forget()
        return ids, totals


_coders: dict[tuple[int, str], ByteBpe] = {}


def coder_of(ranks: dict[bytes, int], pattern: str) -> ByteBpe:
    """One coder a worker: its memory serves all tasks."""
    key = (hash(frozenset(ranks.items())), pattern)
    if key not in _coders:
        _coders.clear()
        _coders[key] = ByteBpe(ranks, pattern)
    return _coders[key]


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())


def _decoded(merges: Merges, ids: np.ndarray, lengths: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Binary values of consecutive ids; ``lengths`` ids belong to each value."""
    data, sizes = merges.decode(ids)
    at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lengths)])]
    valid = None if missing is None else pa.array(~missing).buffers()[1]
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [valid, pa.array(at, pa.int32()).buffers()[1], pa.py_buffer(data.tobytes())]
    )


def _columns(df: DataFrame, drop: set[str], add: list[T.StructField]) -> tuple[T.StructType, list[int]]:
    keep = [i for i, f in enumerate(df.schema) if f.name not in drop]
    return T.StructType([*(df.schema[i] for i in keep), *add]), keep


def encode_decode(
    docs: DataFrame, ranks_path: str, pattern: str, *, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``docs`` without their texts, with each whole text's ids and the bytes that these decode to."""
    ranks = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    Merges(ranks)  # a wrong file fails here
    schema, keep = _columns(
        docs,
        {text, ids, decoded},
        [T.StructField(ids, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded, T.BinaryType())],
    )
    at = docs.columns.index(text)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared.value, pattern)
        for whole in batches:
            for batch in pieces_by_bytes(whole, text, STRETCH_BYTES):
                found, lengths = coder.encode(["" if t is None else t for t in batch.column(at).to_pylist()])
                lists = pa.ListArray.from_arrays(_offsets(lengths), pa.array(found, pa.int32()))
                back = _decoded(coder.merges, found, lengths)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), lists, back], names=schema.names)

    return docs.mapInArrow(code, schema)


def decode(rows: DataFrame, ranks_path: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that their lists of ids stand for."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema, keep = _columns(rows, {decoded}, [T.StructField(decoded, T.BinaryType())])
    at = rows.columns.index(ids)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(shared.value)
        for batch in batches:
            lists = batch.column(at)
            lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), np.int64)
            flat = lists.flatten()
            if flat.null_count:
                raise ValueError("an id is null")
            back = _decoded(merges, np.asarray(flat, np.int64), lengths, np.asarray(lists.is_null()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), back], names=schema.names)

    return rows.mapInArrow(code, schema)
