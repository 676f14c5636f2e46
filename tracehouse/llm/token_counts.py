"""Token counts of whole texts through two tiers of known lengths.

A byte-level tokenizer cuts a text into pre-tokens and encodes each alone, so a text has as many
tokens as its parts between blanks have together. The lengths of the corpus's frequent parts are
broadcast as one table of at most ``TABLE_SIZE`` entries; every worker encodes the others once and
remembers them. Parts are never shuffled: only each task's few most frequent ones are, to choose
the table's entries.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows, null ids and further
columns are kept as they are; an empty table gives no rows. A special string inside a text is one
token, as the library has it by default.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_SIZE = 1 << 15  # entries of the broadcast table, each at most LONGEST characters
TASK_FREQUENT = 1 << 12  # parts a task proposes for it
TASK_COUNTERS = 1 << 18  # parts a task counts at a time; rare ones are forgotten beyond that
WORKER_CACHE = 300_000  # lengths a worker remembers, each tier
LONGEST = 64  # longer parts are encoded anew each time

# Fixed value: the public pre-token pattern of this family of tokenizers.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRE_TOKEN = regex.compile(PRE_TOKEN)
# Blocks whose letters, digits and blanks have been the same for many Unicode versions. Parts with
# other characters are left to the library as a whole.
STABLE = re.compile("[\x00-՗ऀ-౛‐-⁯₠-⏿　-꓏가-힣]*")
# A blank may be cut off in front of its part if no other blank could join it there.
_CUT = re.compile(r"(?<=\S) | (?=\S)")


class _Loose(Exception):
    """A part starts with a blank: this text needs the careful cut."""


class PartLengths(dict):
    """Tokens of " " + part, for parts between single blanks."""

    def __init__(self, tokenizer, frequent: dict[str, int]):
        super().__init__(frequent)
        self.encode, self.frequent = tokenizer.encode, frequent
        self.pieces: dict[str, int] = {}

    def count(self, text: str) -> int:
        return len(self.encode(text, add_special_tokens=False).ids)

    def __missing__(self, part: str) -> int:
        if not part or part[0].isspace():
            raise _Loose
        n = self.of(" " + part)
        if len(part) <= LONGEST:
            if len(self) >= len(self.frequent) + WORKER_CACHE:
                self.clear()
                self.update(self.frequent)
            self[part] = n
        return n

    def of(self, text: str) -> int:
        """Second tier: pre-token by pre-token."""
        if STABLE.fullmatch(text) is None:
            return self.count(text)
        total = 0
        for piece in _PRE_TOKEN.findall(text):
            n = self.pieces.get(piece)
            if n is None:
                n = self.count(piece)
                if len(piece) <= LONGEST:
                    if len(self.pieces) >= WORKER_CACHE:
                        self.pieces.clear()
                    self.pieces[piece] = n
            total += n
        return total


def text_tokens(lengths: PartLengths, text: str, special: list[str]) -> int:
    """Tokens of a text; the strings in ``special`` are one token each."""
    for i, mark in enumerate(special):
        if mark in text:
            parts = text.split(mark)
            return len(parts) - 1 + sum(text_tokens(lengths, p, special[i + 1 :]) for p in parts)
    if not text:
        return 0
    parts = text.split(" ")
    try:
        return lengths.of(parts[0]) + sum(map(lengths.__getitem__, parts[1:]))
    except _Loose:
        first, *rest = _CUT.split(text)
        return lengths.of(first) + sum(
            lengths.of(" " + p) if not p or p[0].isspace() else lengths[p] for p in rest
        )


_loaded: dict[str, object] = {}


def load_tokenizer(definition: str):
    """The tokenizer of a JSON text, once per worker."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _loaded:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[key] = tokenizer
    return _loaded[key]


def _special_strings(tokenizer) -> list[str]:
    added = tokenizer.get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
        raise ValueError("only plain added tokens are supported")
    return sorted((t.content for t in added), key=len, reverse=True)


def frequent_parts(docs: DataFrame, text: str = "text") -> list[str]:
    """The corpus's most frequent parts between blanks, TABLE_SIZE at most.

    Each task counts all its texts with bounded memory and proposes its most frequent parts; a part
    missed here is only encoded by workers instead, so counts need not be exact.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                if value.is_valid:
                    seen.update(value.as_py().split(" "))
                    if len(seen) > TASK_COUNTERS:
                        seen = Counter(dict(seen.most_common(TASK_COUNTERS // 4)))
        best = [(p, n) for p, n in seen.most_common(TASK_FREQUENT) if p and len(p) <= LONGEST and not p[0].isspace()]
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([p for p, _ in best], pa.string()), "n": pa.array([n for _, n in best], pa.int64())}
        )

    proposed = docs.select(F.col(text)).mapInArrow(count, "part string, n long")
    top = proposed.groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(TABLE_SIZE)
    return [row["part"] for row in top.collect()]


def token_counts(
    docs: DataFrame, tokenizer_path: str, *, text: str = "text", into: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the number of tokens of each whole text in the column ``into``."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    tokenizer = load_tokenizer(definition)
    special = _special_strings(tokenizer)
    driver = PartLengths(tokenizer, {})
    table = {p: driver.of(" " + p) for p in frequent_parts(docs, text) if not any(s in p for s in special)}
    shared = spark.sparkContext.broadcast((definition, table))
    at = docs.columns.index(text)
    schema = T.StructType([f for f in docs.schema if f.name != into] + [T.StructField(into, T.LongType())])
    keep = [i for i, f in enumerate(docs.schema) if f.name != into]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, table = shared.value
        lengths = PartLengths(load_tokenizer(definition), table)
        for batch in batches:
            counted = [
                text_tokens(lengths, v.as_py(), special) if v.is_valid else 0 for v in batch.column(at)
            ]
            columns = [batch.column(i) for i in keep] + [pa.array(counted, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(count, schema)
