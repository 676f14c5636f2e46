"""Near-duplicate vectors by NN-descent.

* Balls: vectors within RADIUS of a common centre are all linked with each other, because angles add up; only
  centres go on, so crowds of near-equal vectors never become pairs. Candidates for centres come from blocks
  of LEAF vectors that are neighbours in the order of random sign codes (leaves of random projection trees).
* NN-descent over centres: lists of the nearest other centres start from such leaves. In each round, every
  centre's neighbours (and those it is a neighbour of) are compared with each other, and each keeps its best.
  A list whose last entry could still hold links is saturated and doubles.
* Crowds: balls whose lists are still saturated, or had to grow and hold nothing but possible links, are open. Their members are compared with all rows, in
  broadcasts of bounded size, and counted like other links; lists decide only about pairs of balls that are not open.
* Links: balls whose centres are near enough for a link are compared member by member, in blocks. Links are
  decided in double precision, and counted rather than written as pairs.
* Audit: a bounded sample of vectors is compared with all rows. While the recall of its links is below RECALL, the
  search goes on from its lists with further random codes; after TRIES all balls are open, which needs no lists.

Defined results: null, zero or non-finite vectors link with nothing, vectors of different lengths not with each other. Equal rows are one vector and
share their result; rows with one id and different vectors are different vectors. Null ids link with nothing and have
no component. Further columns are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracehouse.llm.common import Stage
from tracehouse.llm.components import components

COSINE = 0.9
BALL_SHARE = 0.499  # of the linking angle: two members of a ball are always linked
LEAF = 64
BALL_CODES = 12
CODES = 24
BITS = 48
NEIGHBOURS = 6
MOST_ROUNDS = 3
SETTLED = 0.01  # share of list entries that still changed
RECALL = 0.99
AUDITED = 500
TRIES = 3
BLOCK = 256
CROWD_VALUES = 1 << 20  # numbers of one broadcast of members of open balls
SLACK = 1e-3  # list cosines are single precision
SEED = 97

_VECTOR = "row long, vector array<float>"


def _matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ids, units = [], [], []
        for row, own, values in zip(*(batch.column(n).to_pylist() for n in ("row", "id", "vector")), strict=True):
            if own is None or not values or None in values:
                continue
            v = np.array(values, np.float64)
            if not np.isfinite(v).all():
                continue
            v = v / (np.abs(v).max() or 1.0)  # lengths of very large or small values stay finite
            length = math.sqrt(float(v @ v))
            if length > 0:
                rows.append(row)
                ids.append(own)
                units.append(v / length)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(units, pa.list_(pa.float64()))],
            names=["row", "id", "unit"],
        )


def _leaves(units: DataFrame, codes: int, seed: int, width: int) -> DataFrame:
    """(code, sign, row, vector): every vector under each random code, in the codes' order."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.Generator(np.random.PCG64(seed)).standard_normal((codes, width, BITS)).astype(np.float32)
        places = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("unit"), np.float32)
            for code in range(codes):
                signs = ((vectors @ planes[code]) > 0) @ places
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(vectors), code, np.int32)),
                        pa.array(signs),
                        batch.column("row"),
                        pa.array(list(vectors), pa.list_(pa.float32())),
                    ],
                    names=["code", "sign", "row", "vector"],
                )

    signed = units.select("row", "unit").mapInArrow(sign, f"code int, sign long, {_VECTOR}")
    order = ["code", "sign", "row"]
    parts = max(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return signed.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def _in_leaves(batches: Iterator[pa.RecordBatch], look) -> Iterator[pa.RecordBatch]:
    """``look(rows, cosines)`` for consecutive blocks of LEAF rows of one code."""
    for batch in batches:
        code = batch.column("code").to_numpy()
        cuts = np.flatnonzero(np.diff(code)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(code)], strict=True):
            for start in range(a, b, LEAF):
                part = batch.slice(start, min(LEAF, b - start))
                vectors = _matrix(part.column("vector"), np.float32)
                yield look(part.column("row").to_numpy(), vectors @ vectors.T)


def _balls(units: DataFrame, stage: Stage, width: int, reach: float) -> DataFrame:
    """(row, centre, near): the centre's ball holds the row; ``near`` is their cosine."""
    least = math.cos(reach)

    def centres(batches):
        def look(rows: np.ndarray, cosines: np.ndarray) -> pa.RecordBatch:
            close = cosines >= least
            first = np.where(close, rows[None, :], np.iinfo(np.int64).max).min(axis=1)
            own = first < rows
            return pa.RecordBatch.from_arrays([pa.array(rows[own]), pa.array(first[own])], names=["row", "centre"])

        return _in_leaves(batches, look)

    proposed = stage(
        _leaves(units, BALL_CODES, SEED, width)
        .mapInArrow(centres, "row long, centre long")
        .groupBy("row")
        .agg(F.min("centre").alias("centre"))
    )
    # a centre's own centre may hold the row as well: fewer, larger balls
    up = proposed.select(F.col("row").alias("centre"), F.col("centre").alias("far"))
    jump = stage(proposed.join(up, "centre", "left").select("row", "centre", F.coalesce("far", "centre").alias("far")))
    vectors = units.select("row", "unit")
    of = lambda name, vector: vectors.select(F.col("row").alias(name), F.col("unit").alias(vector))
    paired = jump.join(vectors, "row").join(of("centre", "u"), "centre").join(of("far", "v"), "far")
    cosine = lambda other: F.aggregate(
        F.zip_with("unit", other, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda s, x: s + x
    )
    measured = paired.select("row", "centre", "far", cosine("u").alias("a"), cosine("v").alias("b"))
    chosen = measured.select(
        "row",
        F.when(F.col("b") >= least, F.col("far")).when(F.col("a") >= least, F.col("centre")).otherwise(F.col("row")).alias("centre"),
        F.when(F.col("b") >= least, F.col("b")).when(F.col("a") >= least, F.col("a")).otherwise(F.lit(1.0)).alias("near"),
    )
    alone = units.select("row").join(proposed, "row", "left_anti")
    balls = stage(chosen.unionByName(alone.select("row", F.col("row").alias("centre"), F.lit(1.0).alias("near"))))
    stage.drop(proposed, jump)
    return balls


def _best(pairs: DataFrame) -> DataFrame:
    """The best ``keep`` entries of each list (a, b, cosine, keep)."""
    once = pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.max("keep").alias("keep"))
    order = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return once.withColumn("r", F.row_number().over(order)).where(F.col("r") <= F.col("keep")).drop("r")


def _start(centres: DataFrame, seed: int, width: int) -> DataFrame:
    def nearest(batches):
        def look(rows: np.ndarray, cosines: np.ndarray) -> pa.RecordBatch:
            np.fill_diagonal(cosines, -2)
            k = min(NEIGHBOURS, len(rows) - 1)
            best = np.argpartition(-cosines, k - 1, axis=1)[:, :k] if k > 0 else np.empty((len(rows), 0), int)
            a = np.repeat(rows, best.shape[1])
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(rows[best].ravel()), pa.array(np.take_along_axis(cosines, best, 1).ravel().astype(np.float32))],
                names=["a", "b", "cosine"],
            )

        return _in_leaves(batches, look)

    found = _leaves(centres, CODES, seed, width).mapInArrow(nearest, "a long, b long, cosine float")
    return _best(found.withColumn("keep", F.lit(NEIGHBOURS)))


def _local_join(table: pa.Table) -> pa.Table:
    """All pairs of one centre's neighbourhood that would enter a list."""
    table = table.sort_by("x")
    rows, worst, keep = (table[n].to_numpy() for n in ("x", "worst", "keep"))
    vectors = _matrix(table["vector"], np.float32)
    cosines = vectors @ vectors.T
    np.fill_diagonal(cosines, -2)
    i, j = np.nonzero(cosines > worst[:, None])
    apart = rows[i] != rows[j]
    i, j = i[apart], j[apart]
    return pa.table(
        {"a": rows[i], "b": rows[j], "cosine": pa.array(cosines[i, j], pa.float32()), "keep": pa.array(keep[i], pa.int32())}
    )


def _state(lists: DataFrame, least: DataFrame) -> DataFrame:
    """(a, last, keep, full, saturated, open) of every list; ``least`` has (a, least), from which on entries may hold
    links. A list that has grown is open until it reaches below that, even if it is not full yet."""
    ends = lists.groupBy("a").agg(F.min("cosine").alias("last"), F.count("*").alias("n"), F.max("keep").alias("keep"))
    full = F.col("n") >= F.col("keep")
    within = F.col("last") >= F.col("least")
    return ends.join(least, "a").select(
        "a",
        "last",
        "keep",
        full.alias("full"),
        (full & within).alias("saturated"),
        ((full | (F.col("keep") > NEIGHBOURS)) & within).alias("open"),
    )


def _descend(lists: DataFrame, centres: DataFrame, stage: Stage, least: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rounds of NN-descent until few entries change and no list is saturated: the lists, and (centre) of open ones."""
    state = stage(_state(lists, least))
    for _ in range(MOST_ROUNDS):
        full, saturated = F.col("full"), F.col("saturated")
        # a saturated list is open again, at twice its length
        state_now = state.select(
            F.col("a").alias("x"),
            F.when(saturated, F.col("keep") * 2).otherwise(F.col("keep")).cast("int").alias("keep"),
            F.when(full & ~saturated, F.col("last")).otherwise(F.lit(-1.0)).cast("float").alias("worst"),
        )
        back = Window.partitionBy("v").orderBy(F.desc("cosine"), "x")
        reverse = (
            lists.select(F.col("b").alias("v"), F.col("a").alias("x"), "cosine", "keep")
            .withColumn("r", F.row_number().over(back))
            .where(F.col("r") <= F.col("keep"))
        )
        around = (
            lists.select(F.col("a").alias("v"), F.col("b").alias("x"))
            .union(reverse.select("v", "x"))
            .union(lists.select(F.col("a").alias("v"), F.col("a").alias("x")))
            .distinct()
        )
        vectors = centres.select(F.col("row").alias("x"), F.col("unit").cast("array<float>").alias("vector"))
        joined = around.join(state_now, "x").join(vectors, "x")
        found = joined.groupBy("v").applyInArrow(_local_join, "a long, b long, cosine float, keep int")
        grown = lists.join(state_now.select(F.col("x").alias("a"), F.col("keep").alias("more")), "a").select(
            "a", "b", "cosine", F.greatest("keep", "more").alias("keep")
        )
        better = stage(_best(grown.unionByName(found)))
        changed = better.join(lists.select("a", "b"), ["a", "b"], "left_anti").count()
        size = better.count()
        stage.drop(lists, state)
        lists = better
        state = stage(_state(lists, least))
        if changed <= SETTLED * size and state.where("saturated").limit(1).count() == 0:
            break
    return lists, stage(state.where("open").select(F.col("a").alias("centre")))


def _count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, part, b, role, row, unit): members of ball ``a`` (role 0, a block of them) before those of ``b``."""
    current, rows, units, counts = None, [], [], None

    def out() -> pa.RecordBatch:
        hit = np.flatnonzero(counts) if counts is not None else []
        return pa.RecordBatch.from_pydict(
            {
                "row": pa.array([rows[i] for i in hit], pa.int64()),
                "a": pa.array([current[0]] * len(hit), pa.int64()),
                "b": pa.array([current[2]] * len(hit), pa.int64()),
                "n": pa.array([int(counts[i]) for i in hit], pa.int64()),
            }
        )

    for batch in batches:
        keys = [batch.column(n).to_numpy() for n in ("a", "part", "b", "role")]
        changes = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1 if batch.num_rows else []
        bounds = [0, *list(changes), batch.num_rows]
        for start, stop in zip(bounds, bounds[1:], strict=False):
            if start == stop:
                continue
            key = tuple(int(k[start]) for k in keys[:3])
            if key != current:
                if current is not None:
                    yield out()
                current, rows, units, counts = key, [], [], None
            part = batch.slice(start, stop - start)
            matrix = _matrix(part.column("unit"))
            if keys[3][start] == 0:
                rows += part.column("row").to_pylist()
                units.append(matrix)
            elif units:
                block = np.concatenate(units) if len(units) > 1 else units[0]
                units = [block]
                found = (block @ matrix.T >= COSINE).sum(axis=1)
                counts = found if counts is None else counts + found
    if current is not None:
        yield out()


def _against(crowd):
    """Rows (row, centre, unit, open) against a broadcast of open ones: (row, n) links with rows of other balls, each
    counted for both its rows, and (a, b) balls that they connect."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, balls, matrix = crowd.value
        names, starts = np.unique(balls, return_index=True)
        label = np.arange(len(names))
        outside = np.zeros(len(rows), np.int64)
        edges: set[tuple[int, int]] = set()

        def out(row, n, a, b) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (row, n, a, b)], names=["row", "n", "a", "b"]
            )

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                own = part.column("centre").to_numpy()
                hit = _matrix(part.column("unit")) @ matrix.T >= COSINE
                hit &= own[:, None] != balls[None, :]
                n = hit.sum(axis=1)
                some = np.flatnonzero(n)
                if not len(some):
                    continue
                closed = ~part.column("open").to_numpy(zero_copy_only=False)
                outside += hit[closed].sum(axis=0)
                none = [None] * len(some)
                yield out(part.column("row").to_numpy()[some], n[some], none, none)
                # every ball that a row meets is connected; balls with one label are known to be
                met = np.logical_or.reduceat(hit[some], starts, axis=1)
                edges.update(zip(own[some].tolist(), names[met.argmax(axis=1)].tolist(), strict=True))
                low = np.where(met, label, len(label)).min(axis=1)
                for k in np.flatnonzero(low != np.where(met, label, -1).max(axis=1)):
                    at = np.flatnonzero(met[k])
                    labels, first = np.unique(label[at], return_index=True)
                    reached = names[at[first]].tolist()
                    edges.update((reached[0], other) for other in reached[1:])
                    label[np.isin(label, labels)] = labels[0]
        some = np.flatnonzero(outside)
        none = [None] * len(some)
        yield out(rows[some], outside[some], none, none)
        none = [None] * len(edges)
        yield out(none, none, [a for a, _ in edges], [b for _, b in edges])

    return look


def _crowds(open_: DataFrame, members: DataFrame, stage: Stage, width: int) -> DataFrame:
    """(row, n, a, b): all links between balls of which one at least is open, as counts of rows and connected balls."""
    spark = members.sparkSession
    found = spark.createDataFrame([], "row long, n long, a long, b long")
    if open_.limit(1).count() == 0:
        return found
    told = members.join(open_.withColumn("__open", F.lit(True)), "centre", "left")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    held = stage(
        told.select("row", "centre", "unit", F.coalesce("__open", F.lit(False)).alias("open")).repartition(parts, "row")
    )
    passes = -(-held.where("open").count() // max(1, CROWD_VALUES // width))
    for k in range(passes):
        # balls stay together as far as they fit
        own = held.where(F.col("open") & (F.pmod(F.xxhash64("row"), F.lit(passes)) == k)).orderBy("centre").toArrow()
        if own.num_rows:
            crowd = spark.sparkContext.broadcast((own["row"].to_numpy(), own["centre"].to_numpy(), _matrix(own["unit"])))
            found = found.unionByName(stage(held.mapInArrow(_against(crowd), "row long, n long, a long, b long")))
            crowd.unpersist()
    stage.drop(held)
    return found


def _audit(units: DataFrame, result: DataFrame) -> float:
    """Share of a sample's links that were found; the sample is bounded, all rows are compared with it."""
    sample = units.select("row", "unit").orderBy(F.xxhash64("row"), "row").limit(AUDITED).collect()
    if not sample:
        return 1.0
    rows = np.array([r["row"] for r in sample])
    matrix = units.sparkSession.sparkContext.broadcast((rows, np.array([r["unit"] for r in sample])))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, queries = matrix.value
        total = np.zeros(len(rows), np.int64)
        for batch in batches:
            if batch.num_rows:
                near = queries @ _matrix(batch.column("unit")).T >= COSINE
                near &= rows[:, None] != batch.column("row").to_numpy()[None, :]
                total += near.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(total)], names=["row", "true"])

    true = units.select("row", "unit").mapInArrow(count, "row long, true long").groupBy("row").agg(F.sum("true").alias("true"))
    found = true.join(result, "row").agg(F.sum(F.least("true", "n_links")), F.sum("true")).first()
    return 1.0 if not found[1] else found[0] / found[1]


def _group_units(units: DataFrame, stage: Stage, width: int) -> tuple[DataFrame, float]:
    """((row, n_links, component_id), audited recall) of distinct vectors of one length."""
    angle = math.acos(COSINE)
    reach = BALL_SHARE * angle
    balls = _balls(units, stage, width, reach)
    size = stage(
        balls.groupBy("centre").agg(F.count("*").alias("members"), F.acos(F.least(F.lit(1.0), F.min("near"))).alias("radius"))
    )
    centres = stage(units.join(size.select(F.col("centre").alias("row")), "row", "left_semi"))
    members = stage(balls.join(units, "row").select("centre", "row", "unit"))
    widest = size.agg(F.max("radius")).first()[0] or 0.0
    least = stage(
        size.select(F.col("centre").alias("a"), (F.cos(F.lit(angle + widest + SLACK) + F.col("radius")) - SLACK).alias("least"))
    )
    lists: DataFrame | None = None
    candidates: DataFrame | None = None
    recall = 0.0
    for turn in range(TRIES):
        begun = _start(centres, SEED + 1 + turn, width)
        if lists is not None:
            both = begun.unionByName(lists)
            begun = _best(both.withColumn("keep", F.max("keep").over(Window.partitionBy("a"))))
        lists, open_ = _descend(stage(begun), centres, stage, least)
        near = stage(lists.select("a", "b", "cosine").union(lists.select("b", "a", "cosine")))
        candidates = near if candidates is None else candidates.union(near)
        result, linked = _links(candidates, open_, size, members, balls, stage, angle, width)
        recall = _audit(units, result)
        if recall >= RECALL:
            break
    else:
        result, linked = _links(candidates, size.select("centre"), size, members, balls, stage, angle, width)
        recall = _audit(units, result)
        if recall < RECALL:
            raise RuntimeError(f"links found by comparing all vectors have an audited recall of {recall}")
    labels = components(linked, stage)
    label = balls.join(labels.withColumnRenamed("id", "centre"), "centre", "left").select(
        "row", F.coalesce("component", "centre").alias("component")
    )
    smallest = stage(
        label.join(units.select("row", "id"), "row").groupBy("component").agg(F.min("id").alias("component_id"))
    )
    return label.join(smallest, "component").join(result, "row").select("row", "n_links", "component_id"), recall


def group_embeddings(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, float]:
    """((``key``, n_links, component_id, kept) for each row of ``vectors``, audited recall of links)."""
    stage = Stage(vectors.sparkSession, "embeddings")
    rows = vectors.select(
        F.xxhash64(F.col(key), F.col(vector).cast("array<double>")).alias("row"),
        F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    every = stage(rows.mapInArrow(_unit, "row long, id long, unit array<double>").dropDuplicates(["row"]))
    # vectors of different lengths have no cosine: each length is searched by itself
    lengths = every.groupBy(F.size("unit").alias("n")).count().where("count > 1").orderBy("n").collect()
    final, recall = None, 1.0
    for found in lengths:
        units = every if len(lengths) == 1 else stage(every.where(F.size("unit") == found["n"]))
        own, own_recall = _group_units(units.where(F.size("unit") == found["n"]), stage, found["n"])
        final = own if final is None else final.unionByName(own)
        recall = min(recall, own_recall)
    if final is None:
        final = every.limit(0).select("row", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    joined = rows.select("row", "id").join(final.withColumnRenamed("row", "__row"), F.col("row") == F.col("__row"), "left")
    component = F.coalesce("component_id", "id")
    return (
        joined.select(
            F.col("id").alias(key),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            component.alias("component_id"),
            (F.col("id") == component).alias("kept"),
        ),
        recall,
    )


def _links(
    candidates: DataFrame,
    open_: DataFrame,
    size: DataFrame,
    members: DataFrame,
    balls: DataFrame,
    stage: Stage,
    angle: float,
    width: int,
) -> tuple[DataFrame, DataFrame]:
    """((row, n_links), linked pairs of balls) from the pairs of balls that may hold links, and from all rows for open
    balls."""
    crowds = _crowds(open_, members, stage, width)
    for side in ("a", "b"):
        candidates = candidates.join(open_.select(F.col("centre").alias(side)), side, "left_anti")
    of = lambda name, n, r: size.select(F.col("centre").alias(name), F.col("members").alias(n), F.col("radius").alias(r))
    pairs = stage(
        candidates.groupBy("a", "b")
        .agg(F.max("cosine").cast("double").alias("cosine"))
        .join(of("a", "na", "ra"), "a")
        .join(of("b", "nb", "rb"), "b")
        .where(
            F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cosine") + SLACK)))
            <= F.lit(angle) + F.col("ra") + F.col("rb") + SLACK
        )
        .select("a", "b", F.ceil(F.col("na") / BLOCK).alias("parts"))
    )
    own = members.select(F.col("centre").alias("a"), "row", "unit")
    left = pairs.join(own, "a").select(
        "a", F.pmod(F.xxhash64("row"), F.col("parts")).alias("part"), "b", F.lit(0).alias("role"), "row", "unit"
    )
    other = members.select(F.col("centre").alias("b"), "row", "unit")
    right = (
        pairs.join(other, "b")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("a", "part", "b", F.lit(1).alias("role"), "row", "unit")
    )
    keys = ["a", "part", "b"]
    dealt = left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys, "role")
    counted = stage(dealt.mapInArrow(_count_links, "row long, a long, b long, n long"))
    every = counted.select("row", "n").unionByName(crowds.where(F.col("row").isNotNull()).select("row", "n"))
    outside = every.groupBy("row").agg(F.sum("n").alias("outside"))
    result = stage(
        balls.join(size, "centre")
        .join(outside, "row", "left")
        .select("row", (F.col("members") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"))
    )
    connected = counted.select("a", "b").unionByName(crowds.where(F.col("a").isNotNull()).select("a", "b"))
    return result, connected.distinct()
