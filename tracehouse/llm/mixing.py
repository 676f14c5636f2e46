"""Mixing sources to target weights by balanced sampling (the cube method).

A source's target over its size gives how often each of its documents is expected: the whole part as
full copies, the rest as the probability of one more. The flight moves these probabilities to 0 or 1
along directions that change neither the sum of sizes nor the number of documents: within blocks of
BLOCK documents of a source first, then within blocks of what those left undecided (two documents each
at most), until a source is left with one block. The landing rounds that block's last values and corrects its sum of
sizes by a few changes.

Defined results: a null text has size 0 and takes nothing; null sources form one source, weighed last;
a source without words has target 0. Repeated rows and null ids count as rows of their own; further
columns are kept, whatever their names but those of the results; an empty table gives no rows. The order within a block is by size
(largest first) and hashes of id and text, so reruns agree; rows equal in all these are interchangeable. Rows that
repeat an id share a block; in a block that they crowd, rows of equal size are settled among themselves first, which
leaves one undecided row of each size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracehouse.functions.columns import free_name, named, quoted
from tracehouse.llm.common import WORD, Stage
from tracehouse.operators.skew import positions

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
SHARE = 1.5  # of all sizes together
MOST = 2.0  # copies of a document
BLOCK = 2_000
CROWD = 2  # times BLOCK: a block above this holds repeated ids
RESULTS = ("size", "source_size", "target", "copies")
CORRECTIONS = 4  # of the landing
SEED = 8
EPS = 1e-9


def source_targets(sizes: DataFrame, *, source: str = "source", size: str = "size") -> DataFrame:
    """One row a source: ``source``, ``source_size``, ``__n_docs``, ``target``.

    Shares above MOST times a source's size are handed on by weight until none is above: with the level
    v at which sources that are not full stand, a target is min(MOST·size, v·weight). Sources fill up in
    the order of size over weight, so v follows from sums over that order.
    """
    by_source = sizes.groupBy(source).agg(F.sum(size).alias("source_size"), F.count("*").alias("__n_docs"))
    # windows over one row a source
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = by_source.withColumn("__w", F.get(weights, (place % len(WEIGHTS)).cast("int"))).withColumn(
        "__most", MOST * F.col("source_size")
    )
    ordered = Window.orderBy(F.col("__most") / F.col("__w"), F.col(source).asc_nulls_last())
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    later = ordered.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = weighed.withColumns(
        {
            "__full": F.coalesce(F.sum("__most").over(earlier), F.lit(0.0)),
            "__rest": F.sum("__w").over(later),
            "__all": SHARE * F.sum("source_size").over(everything),
        }
    ).withColumn("__level", (F.col("__all") - F.col("__full")) / F.col("__rest"))
    # the first source in this order that isn't full sets the level; later ones would set a lower one
    level = F.max(F.when(F.col("__level") * F.col("__w") <= F.col("__most"), F.col("__level"))).over(everything)
    return filled.withColumn(
        "target", F.coalesce(F.least(F.col("__most"), level * F.col("__w")), F.col("__most"))
    ).select(source, "source_size", "__n_docs", "target")


def fly(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Flight of one block: keeps the sum of p and of size·p, leaves two values inside (0, 1) at most."""
    p = p.astype(float).copy()
    size = size.astype(float)
    random = np.random.Generator(np.random.PCG64(SEED)).random(len(p) + 3)
    waiting = iter([i for i in range(len(p)) if EPS < p[i] < 1 - EPS])
    flying: list[int] = []
    step = 0
    while True:
        while len(flying) < 3:
            new = next(waiting, None)
            if new is None:
                p[p <= EPS] = 0.0
                p[p >= 1 - EPS] = 1.0
                return p
            flying.append(new)
        a, b, c = flying
        # a direction in the null space of the two sums
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[i] if x > 0 else p[i]) / abs(x) for i, x in zip(flying, u, strict=True) if x)
        down = min((p[i] if x > 0 else 1 - p[i]) / abs(x) for i, x in zip(flying, u, strict=True) if x)
        move = up if random[step % len(random)] < down / (up + down) else -down
        step += 1
        for i, x in zip(flying, u, strict=True):
            p[i] += move * x
        flying = [i for i in flying if EPS < p[i] < 1 - EPS]


def land(size: np.ndarray, p: np.ndarray, wanted: float) -> np.ndarray:
    """The last values (two at most) rounded, then single changes and exchanges that bring the sum of sizes
    nearer to ``wanted``, while any does."""
    size = size.astype(float)
    open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    best = p.round()
    for bits in range(1 << len(open_)):
        tried = p.copy()
        tried[open_] = [bits >> k & 1 for k in range(len(open_))]
        if abs((size * tried).sum() - wanted) < abs((size * best).sum() - wanted):
            best = tried
    best = np.clip(best, 0, 1)
    for _ in range(CORRECTIONS):
        off = wanted - (size * best).sum()
        change = np.where(best > 0.5, -size, size)
        exchange = np.abs(off - change[:, None] - change[None, :])
        np.fill_diagonal(exchange, np.abs(off - change))
        at = int(exchange.argmin())
        if exchange.flat[at] >= abs(off) - EPS:
            break
        for k in {*divmod(at, len(best))}:
            best[k] = 1 - best[k]
    return best


def _twins(crowded: DataFrame) -> DataFrame:
    """Rows of a block that share a size, flown against each other: moving their probabilities changes neither sum, so
    of m rows at p the first m·p in order go to 1, the next keeps the fraction that is left, the others go to 0.

    The places come from ``positions``, so a size that any number of rows share is numbered by many tasks.
    """
    numbered, place = positions(crowded, ["source", "block", "size"], ["order", "mark"])
    left = place["n"] * F.col("p") - place["idx"]
    near = F.when(left > 1 - EPS, F.lit(1.0)).when(left < EPS, F.lit(0.0)).otherwise(left)
    return numbered.withColumn("p", near).select(*crowded.columns)


def _chosen(undecided: DataFrame, stage: Stage) -> DataFrame:
    """``row`` of the rows of (row, source, size, p, order, mark, block) whose p the flight moves to 1."""
    schema = undecided.schema

    def moved(block: pa.Table, last: bool) -> pa.Table:
        sizes, p = block["size"].to_numpy(), block["p"].to_numpy()
        order = np.lexsort((block["mark"].to_numpy(), block["order"].to_numpy(), -sizes))
        sizes, p = sizes[order], p[order]
        wanted = float((sizes * p).sum())
        p = fly(sizes, p)
        if last:
            p = land(sizes, p, wanted)
        block = block.take(pa.array(order))
        return block.set_column(block.column_names.index("p"), "p", pa.array(p, pa.float64()))

    def flown(block: pa.Table) -> pa.Table:
        return moved(block, False)

    def landed(block: pa.Table) -> pa.Table:
        return moved(block, True)

    open_ = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    decided = []
    blocks = stage(undecided.groupBy("source", "block").count())
    most = blocks.groupBy("source").agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] or 0
    if most > BLOCK:
        # ids repeat in blocks far above their expected size
        crowds = blocks.where(F.col("count") > CROWD * BLOCK).select(
            F.col("source").alias("crowd_source"), F.col("block").alias("crowd_block")
        )
        if crowds.limit(1).count():
            here = F.col("source").eqNullSafe(F.col("crowd_source")) & (F.col("block") == F.col("crowd_block"))
            settled = stage(_twins(undecided.join(crowds, here, "left_semi")))
            decided.append(settled.where(~open_))
            undecided = undecided.join(crowds, here, "left_anti").unionByName(settled.where(open_))
            most = undecided.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    # each pass leaves two documents a block at most
    while most > BLOCK:
        passed = stage(undecided.groupBy("source", "block").applyInArrow(flown, schema))
        decided.append(passed.where(~open_))
        most = passed.where(open_).groupBy("source").count().agg(F.max("count")).first()[0] or 0
        left = max(1, -(-most // BLOCK))
        undecided = passed.where(open_).withColumn("block", F.pmod(F.xxhash64("block", F.lit(SEED)), F.lit(left)))
    decided.append(undecided.groupBy("source").applyInArrow(landed, schema))
    return reduce(DataFrame.unionByName, decided).where(F.col("p") > 0.5).select("row")


def mix_sources(docs: DataFrame, *, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """``docs`` without their texts, with ``size``, ``source_size``, ``target`` and ``copies``.

    The flight sees sizes and hashes alone; what it chooses is joined back to the rows by a number that each row gets
    when it is written.
    """
    stage = Stage(docs.sparkSession, "mixing")
    own = [c for c in docs.columns if c != text and c.lower() not in RESULTS]
    taken = [*own, *RESULTS]
    row, mark = free_name(taken, "row"), free_name(taken, "mark")
    size = F.coalesce(F.regexp_count(named(text), F.lit(WORD)), F.lit(0)).cast("long")
    sized = stage(
        docs.select(
            *map(named, own),
            size.alias("size"),
            F.monotonically_increasing_id().alias(row),
            F.xxhash64(named(text)).alias(mark),
        )
    )
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(expected + EPS).cast("long")
    by_source = stage(
        source_targets(sized.select(named(source).alias("source"), "size")).select(
            F.col("source").alias("of"), "__n_docs", "source_size", "target", whole.alias("whole"),
            F.greatest(F.lit(0.0), expected - whole).alias("p"),
        )
    )
    is_open = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    slim = sized.select(
        F.col(row).alias("row"), named(source).alias("source"), "size",
        F.xxhash64(named(key), F.lit(SEED + 1)).alias("order"), F.col(mark).alias("mark"),
        F.xxhash64(named(key), F.col("size"), F.lit(SEED)).alias("spread"),
    )
    undecided = slim.join(by_source.where(is_open), F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "source", "size", "p", "order", "mark",
        F.pmod(F.col("spread"), F.ceil(F.col("__n_docs") / BLOCK)).alias("block"),
    )
    chosen = stage(_chosen(undecided, stage))
    told = F.struct(F.col("source_size"), F.col("target"), F.col("whole"), F.col("p")).alias("told")
    of, share, extra = (free_name([*taken, row, mark], n) for n in ("of", "told", "extra"))
    shares = by_source.select(F.col("of").alias(of), told.alias(share))
    joined = sized.join(shares, sized[quoted(source)].eqNullSafe(shares[of]))
    always = F.col(share)["whole"] + F.round(F.col(share)["p"]).cast("long")

    def result(rows: DataFrame, copies: Column) -> DataFrame:
        given = [F.col(share)[name].alias(name) for name in ("source_size", "target")]
        return rows.select(*map(named, own), "size", *given, copies.alias("copies"))

    probable = (F.col(share)["p"] > EPS) & (F.col(share)["p"] < 1 - EPS)
    more = chosen.select(F.col("row").alias(row), F.lit(1).cast("long").alias(extra))
    open_rows = joined.where(probable).join(more, row, "left")
    some = F.col(share)["whole"] + F.coalesce(F.col(extra), F.lit(0).cast("long"))
    return result(joined.where(~probable), always).unionByName(result(open_rows, some))
