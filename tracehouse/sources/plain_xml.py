"""Plain method documents, read a batch at a time from the places of their tags.

``from_xml`` builds a row for each element, which costs more than the text does. Here the tags of
many documents are arrays: told apart by their text, nested by running counts, matched level by
level. A document is plain if that reading is certain to be what ``from_xml`` gives; every other
one (comments, CDATA, references, mixed text, attributes or letter case that matter, repeated or
missing parts, broken nesting …) is left to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa

BATCH_BYTES = 1 << 20
MAX_DEPTH = 60

# the names on the way down to one parameter, below any root
CONTAINERS = ("Doc", "Content", "MethodConfiguration", "MethodDescription", "Section", "Section", "Table", "Row", "Parameter")
SECTION, TABLE, ROW, PARAMETER = 7, 8, 9, 10  # their levels; the root's is 1
SINGLE = range(2, SECTION)
NAMES = {name: number for number, name in enumerate(dict.fromkeys((*CONTAINERS, "Name", "Value")))}
_FOLDED = {name.lower() for name in NAMES}

START, END, EMPTY, DECLARATION, OTHER = range(5)
_STEP = np.array([1, -1, 0, 0, 0], dtype=np.int32)

_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*(?::[A-Za-z_][A-Za-z0-9_.-]*)?"
_ATTRIBUTE = rf"[ \t\n]+({_NAME})[ \t\n]*=[ \t\n]*(?:\"[^\"]*\"|'[^']*')"
_OPENING = re.compile(rf"({_NAME})((?:{_ATTRIBUTE})*)[ \t\n]*(/?)")
_CLOSING = re.compile(rf"/({_NAME})[ \t\n]*")
_XML = re.compile(r'\?xml version="1\.0"(?: encoding="(?i:utf-8)")?[ \t\n]*\?')

PARAMETERS = pa.list_(pa.struct([("Name", pa.string()), ("Value", pa.string())]))
ROWS = pa.list_(pa.struct([("Parameter", PARAMETERS)]))


@lru_cache(maxsize=1 << 14)
def _form(tag: str) -> tuple[int, str, bool]:
    """Kind, name and whether there are no attributes, of the text between ``<`` and ``>``."""
    if closing := _CLOSING.fullmatch(tag):
        return END, closing[1], True
    if opening := _OPENING.fullmatch(tag):
        name, attributes = opening[1], [a[1] for a in re.finditer(_ATTRIBUTE, opening[2])]
        local = name.rpartition(":")[2]
        if len(set(attributes)) == len(attributes) and (name in NAMES or local.lower() not in _FOLDED):
            return EMPTY if opening[4] else START, name, not attributes
    return DECLARATION if _XML.fullmatch(tag) else OTHER, "", True


def _pieces(buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.StringArray:
    """The texts from each start to its stop; they come in order and do not overlap."""
    cuts = np.zeros(2 * len(starts) + 1, dtype=np.int32)
    cuts[0:-1:2], cuts[1::2], cuts[-1] = starts, stops, stops[-1] if len(stops) else 0
    both = pa.StringArray.from_buffers(2 * len(starts), pa.py_buffer(cuts), pa.py_buffer(buffer))
    return both.take(pa.array(np.arange(0, 2 * len(starts), 2)))


class _Tags:
    """The tags of the documents between ``offsets`` of a buffer, and which documents are plain."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray):
        self.buffer, self.offsets = buffer, offsets
        self.good = np.ones(len(offsets) - 1, dtype=bool)
        # controls, "\r", references, the first byte of U+FFFE and U+FFFF
        odd = ((buffer < 32) & (buffer != 9) & (buffer != 10)) | (buffer == ord("&")) | (buffer == 0xEF)
        if odd.any():
            self.good[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = False
        marks = np.flatnonzero((buffer == ord("<")) | (buffer == ord(">")))
        counts = np.diff(np.searchsorted(marks, offsets))
        self.good &= (counts > 0) & (counts % 2 == 0)
        if not self.good.all():
            marks = marks[np.repeat(self.good, counts)]
        self.lt, self.gt = marks[0::2], marks[1::2]
        self.doc = np.repeat(np.arange(len(self.good), dtype=np.int32), np.where(self.good, counts // 2, 0))
        self._heads()
        self.reject((buffer[self.lt] != ord("<")) | (buffer[self.gt] != ord(">")))
        self.reject(self.head[self.lt[self.head] != offsets[self.doc[self.head]]])
        self._drop("lt", "gt", "doc")
        self._name()
        self._nest()
        self._texts()

    def reject(self, tags: np.ndarray) -> None:
        """The documents of these tags (numbers or a mask) are not plain."""
        if len(tags) and (tags.dtype != bool or tags.any()):
            self.good[self.doc[tags]] = False

    def _heads(self) -> None:
        edges = np.searchsorted(self.doc, np.arange(len(self.good) + 1, dtype=np.int32))
        filled = edges[1:] > edges[:-1]
        self.head, self.last = edges[:-1][filled], edges[1:][filled] - 1

    def _drop(self, *columns: str) -> None:
        if not self.good[self.doc[self.head]].all():
            kept = self.good[self.doc]
            for column in columns:
                setattr(self, column, getattr(self, column)[kept])
            self._heads()

    def _name(self) -> None:
        coded = _pieces(self.buffer, self.lt + 1, self.gt).dictionary_encode()
        numbers = dict(NAMES)
        forms = [_form(tag) for tag in coded.dictionary.to_pylist()]
        codes = coded.indices.to_numpy().astype(np.intp)
        self.kind = np.array([f[0] for f in forms], dtype=np.uint8)[codes]
        self.name = np.array([numbers.setdefault(f[1], len(numbers)) for f in forms], dtype=np.int32)[codes]
        self.odd = np.array([not f[2] for f in forms], dtype=bool)[codes]
        declared = self.kind == DECLARATION
        declared[self.head] = False
        self.reject(declared | (self.kind == OTHER))

    def _nest(self) -> None:
        """Opening and closing tags by level, the root's 1; the root closes last, and once."""
        step = _STEP[self.kind]
        depth = np.cumsum(step, dtype=np.int32)
        depth -= np.repeat(depth[self.head] - step[self.head], self.last + 1 - self.head)
        closed = depth <= 0
        closed[self.head] &= self.kind[self.head] != DECLARATION
        closed[self.last] = depth[self.last] != 0
        self.reject(closed | (depth > MAX_DEPTH))
        # levels and kinds fit one byte
        self.level = (depth + (step <= 0)).astype(np.uint8)
        self.level[self.kind == DECLARATION] = 0
        self._drop("lt", "gt", "doc", "kind", "name", "odd", "level")
        # within a level, every opening tag is followed by its closing one
        paired = np.flatnonzero(self.kind <= END)
        levels = self.level[paired]
        order = paired[np.argsort(levels, kind="stable")]
        self.opening, self.closing = order[0::2], order[1::2]
        self.reject(self.opening[self.name[self.opening] != self.name[self.closing]])
        self.bounds = np.append(0, np.cumsum(np.bincount(levels, minlength=PARAMETER + 2) // 2))
        self.empty = np.flatnonzero(self.kind == EMPTY)

    def _texts(self) -> None:
        """Where the text after each tag stops; outside elements without children it is white space."""
        self.stop = np.append(self.lt[1:], 0)
        self.stop[self.last] = self.offsets[self.doc[self.last] + 1]
        self.leaf = self.kind == START
        self.leaf[:-1] &= self.kind[1:] == END
        stray = np.flatnonzero((self.stop > self.gt + 1) & ~self.leaf)
        if len(stray):
            coded = _pieces(self.buffer, self.gt[stray] + 1, self.stop[stray]).dictionary_encode()
            blank = np.array([not t.strip(" \t\n") for t in coded.dictionary.to_pylist()], dtype=bool)
            self.reject(stray[~blank[coded.indices.to_numpy()]])
        # an empty element's text is none
        self.stop[self.empty] = self.gt[self.empty] + 1

    def opened(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The opening and closing tags of a level."""
        here = slice(self.bounds[level], self.bounds[level + 1])
        return self.opening[here], self.closing[here]

    def children(
        self, parents: tuple[np.ndarray, np.ndarray], level: int, name: str, single: bool = False
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Elements of that name below the parents, their closing tags, their parents' places."""
        found, closing = self.opened(level)
        here = self.name[found] == NAMES[name]
        found, closing = found[here], closing[here]
        if len(self.empty):
            empty = self.empty[(self.level[self.empty] == level) & (self.name[self.empty] == NAMES[name])]
            if len(empty):
                found, closing = np.append(found, empty), np.append(closing, empty)
                order = np.argsort(found)
                found, closing = found[order], closing[order]
        if not len(parents[0]):
            return found[:0], found[:0], found[:0]
        place = np.searchsorted(parents[0], found) - 1
        inside = (place >= 0) & (found < parents[1][place])
        if not inside.all():
            found, closing, place = found[inside], closing[inside], place[inside]
        self.reject(found[self.odd[found]])
        if single:
            self.reject(found[1:][place[1:] == place[:-1]])
        return found, closing, place

    def leaves(self, parents: tuple[np.ndarray, np.ndarray], level: int, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Children that hold text alone, one a parent, and their parents' places."""
        found, _, place = self.children(parents, level, name, single=True)
        self.reject(found[~self.leaf[found] & (self.kind[found] != EMPTY)])
        # ends that trimming could take
        starts, stops = self.gt[found] + 1, self.stop[found]
        for edge in (self.buffer[starts], self.buffer[stops - 1]):
            self.reject(found[(stops > starts) & ((edge <= 32) | (edge >= 127))])
        return found, place

    def texts(self, elements: np.ndarray) -> pa.StringArray:
        return _pieces(self.buffer, self.gt[elements] + 1, self.stop[elements])

    def having(self, tags: np.ndarray) -> None:
        """Only documents of these tags stay plain."""
        held = np.zeros(len(self.good), dtype=bool)
        held[self.doc[tags]] = True
        self.good &= held


def _lists(counts: np.ndarray, values: pa.Array, missing: np.ndarray | None = None) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=None if missing is None else pa.array(missing))


def _read(buffer: np.ndarray, offsets: np.ndarray, section: str, tables: Sequence[int]) -> tuple[np.ndarray, list[pa.Array]]:
    tags = _Tags(buffer, offsets)
    path = {1: tags.opened(1)}
    parent = {}
    for level, name in enumerate(CONTAINERS, 2):
        *path[level], parent[level] = tags.children(path[level - 1], level, name, single=level in SINGLE)
    for found, _ in path.values():
        tags.reject(found[tags.leaf[found] | (tags.kind[found] == EMPTY)])
    tags.leaves(path[TABLE], TABLE + 1, "Name")
    titles, titled = tags.leaves(path[SECTION], SECTION + 1, "Name")
    same = tags.texts(titles).to_numpy(zero_copy_only=False) == section
    _, first = np.unique(tags.doc[titles[same]], return_index=True)
    pumps = titled[same][first]
    path = {level: found for level, (found, _) in path.items()} | {0: path[PARAMETER]}
    tags.having(path[SECTION][pumps])
    named = {}
    for name in ("Name", "Value"):
        found, place = tags.leaves(path[0], PARAMETER + 1, name)
        named[name] = np.full(len(path[PARAMETER]), -1)
        named[name][place] = found

    def below(level: int, places: np.ndarray) -> np.ndarray:
        """Places, among the elements of a level, of the children of these of the level above."""
        chosen = np.zeros(len(path[level - 1]), dtype=bool)
        chosen[places] = True
        return np.flatnonzero(chosen[parent[level]])

    of_pumps = below(TABLE, pumps)
    section_of = parent[TABLE][of_pumps]
    rank = np.arange(len(of_pumps)) - np.searchsorted(section_of, section_of)
    picked = []
    for table in tables:
        rows = below(ROW, of_pumps[rank == table])
        cells = below(PARAMETER, rows)
        width = np.bincount(parent[PARAMETER][cells], minlength=len(path[ROW]))
        tags.having(path[ROW][rows])
        tags.reject(path[ROW][rows[width[rows] == 0]])
        names = named["Name"][cells]
        tags.reject(path[PARAMETER][cells[(names < 0) | (named["Value"][cells] < 0)]])
        names = names[names >= 0]
        tags.reject(names[tags.stop[names] == tags.gt[names] + 1])
        picked.append((rows, cells, width))
    found = []
    for rows, cells, width in picked:
        rows = rows[tags.good[tags.doc[path[ROW][rows]]]]
        cells = cells[tags.good[tags.doc[path[PARAMETER][cells]]]]
        pairs = [tags.texts(named[name][cells]) for name in ("Name", "Value")]
        parameters = _lists(width[rows], pa.StructArray.from_arrays(pairs, ["Name", "Value"]))
        per_doc = np.bincount(tags.doc[path[ROW][rows]], minlength=len(tags.good))
        found.append(_lists(per_doc, pa.StructArray.from_arrays([parameters], ["Parameter"]), ~tags.good).cast(ROWS))
    return tags.good, found


def plain_tables(texts: pa.Array, section: str, tables: Sequence[int]) -> Iterator[tuple[int, int, np.ndarray, list[pa.Array]]]:
    """Rows of the numbered tables of each document's first section of that name, a stretch at a time.

    Gives where the stretch begins and ends, which of its documents are plain, and for each table a
    list of rows for each document, null where it is not plain.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + BATCH_BYTES, "right")) - 1)
        stretch = whole[offsets[begin] : offsets[end]]
        yield begin, end, *_read(stretch, offsets[begin : end + 1] - offsets[begin], section, tables)
        begin = end
