"""Hard negatives of anchors, with exact integer scores from float32 matrix products.

Components are multiplied by SCALE and rounded down; a score is the integer inner product. Anchors and rows are dealt to
a grid of cells of bounded size: a cell holds a block of anchors and a block of rows, and only its best candidates leave
it. In a cell, both blocks are taken modulo several small primes. Their residues are multiplied as float32 matrices,
whose sums stay below 2**24 and are therefore exact; Chinese remaindering puts the exact signed scores together from the
residues, with as many primes as the cell's greatest possible score needs.

The first grid meets rows of the anchor's label and finds its positives. The second one meets all rows; a positive's
window is a range of scores, looked up in the sorted scores of the other labels.

Defined results: rows without an id or a label, without a vector, or with a null or non-finite component take no part.
Rows that share an id count once: the one with the smallest label, then the smallest width and vector. Vectors of
different widths never meet. Further columns are dropped; an empty table, or one without anchors, gives no rows. Equal
scores are ordered by the smaller id. Scores of 2**62 or more fail.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracehouse.llm.common import Stage

SCALE = 256
CELL_COMPONENTS = 1 << 22  # of each of a cell's two blocks
CELL_ROWS = 1 << 16
LEAST_ROWS = 512  # smaller blocks are not worth a cell of their own
TILE = 1 << 21  # scores computed at a time
EXACT = 1 << 24  # float32 holds all integers up to this
CHUNK = 256  # components multiplied at a time
LIMIT = 1 << 62
NEVER = np.iinfo(np.int64).min

ROW = "vec_id long, label long, width int, unit int, data binary"


# --- exact products ---------------------------------------------------------------------------------


def primes_below(limit: int) -> Iterator[int]:
    """Odd primes up to ``limit``, largest first."""
    sieve = np.ones(limit + 1, bool)
    for d in range(2, isqrt(limit) + 1):
        sieve[d * d :: d] = False
    return (int(p) for p in np.flatnonzero(sieve)[::-1] if p > 2)


def moduli(width: int, bound: int) -> list[int]:
    """Primes whose residues multiply exactly over ``width`` components and tell all scores within ``bound`` apart."""
    largest = 2 * isqrt(EXACT // max(1, min(width, CHUNK))) + 1
    chosen, product = [], 1
    for p in primes_below(largest):
        chosen.append(p)
        product *= p
        if product > 2 * bound:
            return chosen
    raise ValueError("scores of 2**62 or more")


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of smallest size, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def greatest(x: np.ndarray) -> int:
    """No row of ``x`` is longer than this."""
    # the least excess covers what the double sums may lose
    return int(np.sqrt(np.square(x.astype(np.float64)).sum(axis=1).max(initial=0.0)) * (1 + 1e-9)) + 1


class Residues:
    """Rows prepared for exact products with blocks of anchors, for scores within ``bound``."""

    def __init__(self, rows: np.ndarray, bound: int):
        if bound >= LIMIT:
            raise ValueError("scores of 2**62 or more")
        self.width = rows.shape[1]
        self.primes = moduli(self.width, bound)
        self.rows = [residues(rows, p) for p in self.primes]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of all anchors and rows."""
        total, product = None, 1
        for p, rows in zip(self.primes, self.rows, strict=True):
            own = residues(anchors, p)
            found = np.zeros((len(own), len(rows)), np.int64)
            for c in range(0, self.width, CHUNK):
                found += (own[:, c : c + CHUNK] @ rows[:, c : c + CHUNK].T).astype(np.int64)
            if total is None:
                total = np.mod(found, p)
            else:
                # the multiple of the earlier primes' product that agrees with this residue too
                total += product * np.mod(np.mod(found - total, p) * pow(product, -1, p), p)
            product *= p
        return np.where(total > product // 2, total - product, total)


# --- rows -------------------------------------------------------------------------------------------


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, with whole components in as few bytes as each vector needs."""
    for batch in batches:
        ids, labels, lists = batch.columns
        out: list[tuple[int, int, int, int, bytes]] = []
        for vec_id, label, value in zip(ids.to_pylist(), labels.to_pylist(), lists, strict=True):
            if vec_id is None or label is None or not value.is_valid or value.values.null_count:
                continue
            x = np.asarray(value.values, np.float64)
            if not np.isfinite(x).all():
                continue
            x = np.floor(SCALE * x)
            size = float(np.abs(x).max(initial=0.0))
            if size >= 2**62:
                raise ValueError("scores of 2**62 or more")
            unit = next(u for u in (1, 2, 4, 8) if size < 2 ** (8 * u - 1))
            out.append((vec_id, label, len(x), unit, x.astype(f"<i{unit}").tobytes()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        names = ("vec_id", "label", "width", "unit", "data")
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _matrix(table: pa.Table) -> np.ndarray:
    """Components of the rows of one cell's block."""
    width = table.column("width")[0].as_py()
    units = np.asarray(table.column("unit"))
    out = np.empty((len(units), width), np.int64)
    data = table.column("data").to_pylist()
    for unit in np.unique(units).tolist():
        at = np.flatnonzero(units == unit)
        out[at] = np.frombuffer(b"".join([data[i] for i in at]), f"<i{unit}").reshape(len(at), width)
    return out


def _cells(rows: DataFrame, anchors: DataFrame, keys: list[str], parallel: int, cell_rows: int, least_rows: int):
    """Rows and anchors dealt to the cells in which all that share ``keys`` meet, grouped for one function a cell."""
    wide = F.greatest(F.lit(1), F.lit(CELL_COMPONENTS) / F.greatest(F.lit(1), F.first("width")))
    size = F.least(F.lit(cell_rows), wide)

    def blocks(df: DataFrame, name: str, parallel: int) -> DataFrame:
        n = F.count(F.lit(1))
        spread = F.least(F.lit(parallel), F.ceil(n / least_rows))
        return df.groupBy(*keys).agg(F.greatest(F.ceil(n / size), spread).cast("int").alias(name))

    counts = blocks(rows, "row_blocks", parallel).join(blocks(anchors, "anchor_blocks", 1), keys)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int")
        dealt = df.join(counts, keys).withColumn(own.removesuffix("s"), mine)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return dealt.withColumn(other.removesuffix("s"), every).drop("row_blocks", "anchor_blocks")

    cell = [*keys, "row_block", "anchor_block"]
    left = dealt(anchors, "anchor_blocks", "row_blocks").groupBy(*cell)
    return left.cogroup(dealt(rows, "row_blocks", "anchor_blocks").groupBy(*cell))


class _Cell:
    """Exact scores of one cell, tile by tile, as keys that also order equal scores by the smaller id."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        self.anchors, self.rows = anchors, rows.sort_by("vec_id")
        self.left, self.right = _matrix(self.anchors), _matrix(self.rows)
        self.bound = greatest(self.left) * greatest(self.right)
        self.ids, self.labels = np.asarray(self.rows.column("vec_id")), np.asarray(self.rows.column("label"))
        self.anchor_ids = np.asarray(anchors.column("vec_id"))
        self.anchor_labels = np.asarray(anchors.column("label"))

    def tiles(self) -> Iterator[tuple[slice, slice, int, np.ndarray]]:
        """(anchors, rows, r, keys): a key is score * r + (r - 1 - place of the row among the r rows)."""
        r = max(1, min(len(self.ids), LIMIT // (2 * self.bound + 1)))
        step = max(1, TILE // r)
        for at in range(0, len(self.ids), r):
            part = slice(at, at + r)
            prepared = Residues(self.right[part], self.bound)
            last = r - 1 - np.arange(len(self.ids[part]))
            for a in range(0, len(self.anchor_ids), step):
                own = slice(a, a + step)
                yield own, part, r, prepared.scores(self.left[own]) * r + last


def _best_positives(wanted: int):
    schema = "anchor_id long, positive_id long, positive_score long"

    def positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if anchors.num_rows and rows.num_rows:
            cell = _Cell(anchors, rows)
            for own, part, r, keys in cell.tiles():
                ids = cell.ids[part]
                keys[cell.anchor_ids[own][:, None] == ids[None, :]] = NEVER
                top = keys if keys.shape[1] <= wanted else np.partition(keys, -wanted, axis=1)[:, -wanted:]
                anchor, _ = np.nonzero(top != NEVER)
                key = top[top != NEVER]
                found[0].append(cell.anchor_ids[own][anchor])
                found[1].append(ids[r - 1 - key % r])
                found[2].append(key // r)
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in found]
        return pa.table(columns, names=["anchor_id", "positive_id", "positive_score"])

    return positives, schema


def _best_negatives(wanted: int, low: int, high: int):
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def negatives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], [], []]
        if anchors.num_rows and rows.num_rows:
            cell = _Cell(anchors, rows)
            positives = anchors.column("positives").to_pylist()
            for own, part, r, keys in cell.tiles():
                ids = cell.ids[part]
                keys[cell.anchor_labels[own][:, None] == cell.labels[part][None, :]] = NEVER
                keys.sort(axis=1)
                for i, row in enumerate(keys, own.start):
                    for p in positives[i]:
                        score = p["positive_score"]
                        least, most = -(-low * score // 100), high * score // 100
                        lo, hi = np.searchsorted(row, [least * r, (most + 1) * r])
                        chosen = row[max(lo, hi - wanted) : hi] if least <= most else row[:0]
                        n = len(chosen)
                        found[0].append(np.full(n, cell.anchor_ids[i]))
                        found[1].append(np.full(n, p["positive_id"]))
                        found[2].append(np.full(n, score))
                        found[3].append(ids[r - 1 - chosen % r])
                        found[4].append(chosen // r)
        return pa.table([np.concatenate(c) if c else np.empty(0, np.int64) for c in found], names=names)

    return negatives, ", ".join(f"{n} long" for n in names)


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    cell_rows: int = CELL_ROWS,
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its first ``positives`` other rows of its label; a positive's negatives are the first
    ``negatives`` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    ``is_anchor`` is a condition on the column ``vec_id``. Cells hold up to ``cell_rows`` rows and as many anchors; below
    that, rows are dealt to as many cells as there are shuffle partitions, with ``least_rows`` or more each.
    """
    stage = Stage(vectors.sparkSession, "negatives")
    parallel = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding)
    )
    packed = picked.mapInArrow(_packed, ROW)
    one = F.min(F.struct("label", "width", "unit", "data")).alias("row")
    rows = stage(packed.groupBy("vec_id").agg(one).select("vec_id", "row.*"))
    anchors = rows.where(is_anchor).select(*[F.col(c).alias(c) for c in rows.columns])

    work, schema = _best_positives(positives)
    near = _cells(rows, anchors, ["width", "label"], parallel, cell_rows, least_rows).applyInArrow(work, schema)
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = near.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives)
    listed = best.groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    windows = stage(anchors.join(listed.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))

    work, schema = _best_negatives(negatives, low, high)
    hard = _cells(rows, windows, ["width"], parallel, cell_rows, least_rows).applyInArrow(work, schema)
    by_score = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
