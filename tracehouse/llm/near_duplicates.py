"""Near-duplicate texts by SuperMinHash signatures, banding, verification and union-find grouping.

* A text's set holds the hashes of its distinct word shingles. Every element draws a permutation of the
  registers and puts "step + fraction" into the register of each step; steps end once no register can
  improve. Registers of one element exclude each other, which lowers the estimate's variance below that
  of independent minima.
* Texts with equal sets form a class at once. Classes whose ROWS registers agree in one of the BANDS
  bands share a bucket. At a similarity of 0.8 a pair misses all buckets with probability
  (1 - 0.8**ROWS)**BANDS, below one in a million.
* In each bucket the class with most company leads: every other one is compared with it on whole sets.
  After STAR_ROUNDS leaders, the classes outside a bucket's largest group are compared with the bucket's
  others in blocks. Classes already grouped need no further comparison, so groups of copies never
  become pairs.

Defined results: a text without words, or null, has an empty set and is linked with nothing; a text with
fewer words than a shingle has its whole sequence as one. Equal texts are linked. Null ids have no group
(component null). Repeated rows get one result each; an empty table gives no rows. Shingles are compared
by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.llm.common import Stage, mix, powers, shingle_hashes, word_hashes
from tracehouse.llm.components import components

ROWS, BANDS = 5, 36
REGISTERS = ROWS * BANDS
SIMILARITY = 80  # percent
SHINGLE = 5
STAR_ROUNDS = 2
PAIRS_PER_TASK = 500  # members compared with one copy of their leader
BLOCK = 64  # leaders compared at a time in the blocked comparison
ELEMENTS = 1 << 16  # shingles whose registers are drawn together

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles; ASCII letters count without their case."""
    return np.unique(shingle_hashes(word_hashes(text, lower=True), size))


def super_minhash(elements: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Register values (step in the upper, fraction in the lower 32 bits) of a non-empty set."""
    values = np.full(registers, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(elements), ELEMENTS):
        block = elements[start : start + ELEMENTS]
        rows = np.arange(len(block))
        places: np.ndarray | None = None
        for step in range(registers):
            # registers above this step can still improve; none can once all hold earlier steps
            if int(values.max() >> np.uint64(32)) < step:
                break
            drawn = mix(block + np.uint64((int(_STEP) * (step + 1)) % (1 << 64)))
            fraction = drawn & _LOW
            pick = (((drawn >> np.uint64(32)) * np.uint64(registers - step)) >> np.uint64(32)).astype(np.int64) + step
            if step == 0:
                register, first = pick, pick
            else:
                if places is None:
                    places = np.tile(np.arange(registers, dtype=np.int16), (len(block), 1))
                    places[rows, first], places[:, 0] = places[:, 0].copy(), places[rows, first]
                register = places[rows, pick].astype(np.int64)
                places[rows, pick] = places[:, step]
            np.minimum.at(values, register, (np.uint64(step) << np.uint64(32)) | fraction)
    return values


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key a band; keys of different bands differ."""
    rows = mix(signature).reshape(BANDS, ROWS) * powers(ROWS)
    return mix(rows.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _STEP).view(np.int64)


def alike(a: np.ndarray, b: np.ndarray, percent: int = SIMILARITY) -> bool:
    """100·|intersection| >= percent·|union| of two sorted sets."""
    low, high = sorted((len(a), len(b)))
    if low == 0 or 100 * low < percent * high:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def signatures(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """(key, n_shingles, digest, bands) of each text; digest and bands are null for empty sets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, bands = [], [], []
            for value in batch.column(1):
                own = shingle_set(value.as_py(), size)
                counts.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                bands.append(band_keys(super_minhash(own)) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["id", "n_shingles", "digest", "bands"],
            )

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(sign, "id long, n_shingles long, digest binary, bands array<long>")


def _compare(size: int, percent: int):
    """Rows (group, part, role, id, label, n, homes, text), leaders (role 0) before members: links of a group.

    With ``homes``, the sorted groups in which a text is, a pair is compared in the first group that both share alone, and
    once if both lead there; with ``n``, the set's size, only if sizes allow the similarity.
    """

    def due(leader: tuple, own: int, label: int, n: int | None, homes: list[int] | None, group: int) -> bool:
        other, other_label, other_n, other_homes = leader
        if other == own or other_label == label:
            return False
        if homes is None:
            return True
        if 100 * min(n, other_n) < percent * max(n, other_n) or (label != group and own > other):
            return False
        return next(h for h in homes if h in other_homes) == group

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, leaders, texts, sets = None, [], [], {}
        for batch in batches:
            found: list[tuple[int, int]] = []
            names = ("group", "part", "role", "id", "label", "n", "homes")
            columns = [batch.column(n).to_pylist() for n in names]
            for group, part, role, own, label, n, homes, text in zip(*columns, batch.column("text"), strict=True):
                if (group, part) != current:
                    current, leaders, texts, sets = (group, part), [], [], {}
                if role == 0:
                    leaders.append((own, label, n, None if homes is None else frozenset(homes)))
                    texts.append(text)
                    continue
                elements = None
                for at, leader in enumerate(leaders):
                    if due(leader, own, label, n, homes, group):
                        if elements is None:
                            elements = shingle_set(text.as_py(), size)
                        if at not in sets:
                            sets[at], texts[at] = shingle_set(texts[at].as_py(), size), None
                        if alike(elements, sets[at], percent):
                            found.append((own, leader[0]))
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())}
            )

    return compare


class _Search:
    """Links between classes of equal sets, found bucket by bucket."""

    def __init__(self, stage: Stage, texts: DataFrame, size: int, percent: int):
        self.stage, self.texts, self.size, self.percent = stage, texts, size, percent

    def verified(self, leaders: DataFrame, members: DataFrame) -> DataFrame:
        """Links of (group, part, id, label, n, homes) leaders with the members of the same group and part."""
        columns = ["group", "part", "role", "id", "label", "n", "homes"]
        rows = leaders.withColumn("role", F.lit(0)).select(*columns).unionByName(
            members.withColumn("role", F.lit(1)).select(*columns)
        )
        with_text = rows.join(self.texts, "id").select(*columns, "text")
        dealt = with_text.repartition("group", "part").sortWithinPartitions("group", "part", "role")
        return dealt.mapInArrow(_compare(self.size, self.percent), "a long, b long")


def group_near_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = SIMILARITY,
) -> DataFrame:
    """(``key``, n_shingles, component_id, kept): one row for each row of ``docs``."""
    spark = docs.sparkSession
    stage = Stage(spark, "near-duplicates")
    signed = stage(signatures(docs, shingle, key, text))
    classes = stage(
        signed.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
        .groupBy("digest", "n_shingles")
        .agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    )
    placed = classes.select("rep", F.explode("bands").alias("key"))
    shared = stage(placed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    buckets = stage(placed.join(shared, "key").select("key", "rep", "n"))
    company = stage(buckets.groupBy(F.col("rep").alias("id")).agg(F.sum("n").alias("company")))
    whole = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    # of repeated ids, each row of the id may stand for it only if its set does: all are compared
    texts = stage(whole.join(company.select("id"), "id", "left_semi"))
    search = _Search(stage, texts, shingle, percent)

    ranked = stage(
        buckets.join(company, buckets["rep"] == company["id"]).select("key", "rep", "n", "company")
    )
    stage.drop(buckets, shared)
    labels: DataFrame | None = None
    links: DataFrame | None = None
    tried: list[DataFrame] = []
    last: DataFrame | None = None
    for turn in range(STAR_ROUNDS + 1):
        remaining = ranked.where(F.col("n") > turn + 1)
        if labels is None:
            labelled = remaining.withColumn("label", F.col("rep"))
        else:
            known = labels.withColumnRenamed("id", "__id")
            labelled = remaining.join(known, F.col("rep") == F.col("__id"), "left").select(
                "key", "rep", "n", "company", F.coalesce("component", "rep").alias("label")
            )
            split = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
            open_keys = stage(split.where(F.col("lo") != F.col("hi")).select("key"))
            if open_keys.limit(1).count() == 0:
                break
            labelled = stage(labelled.join(open_keys, "key"))
        if turn == STAR_ROUNDS:
            found = _blocked(search, labelled, classes.select("rep", F.col("n_shingles").alias("n")))
        else:
            # labels fall between rounds: only what stays the same tells who has led
            place = F.struct(F.col("company"), (-F.col("rep")).alias("back"))
            able = labelled
            if last is not None:
                before = last.select("key", F.struct("was.company", "was.back").alias("before"))
                able = able.join(before, "key", "left").where(F.col("before").isNull() | (place < F.col("before")))
            order = F.struct(F.col("company"), (-F.col("rep")).alias("back"), F.col("label"))
            led = stage(able.groupBy("key").agg(F.max(order).alias("was")))
            last = led
            pairs = (
                labelled.join(led, "key")
                .select(
                    (-F.col("was")["back"]).alias("leader"),
                    F.col("was")["label"].alias("leader_label"),
                    F.col("rep").alias("id"),
                    "label",
                )
                .where(F.col("label") != F.col("leader_label"))
                .distinct()
            )
            for earlier in tried:
                pairs = pairs.join(
                    earlier,
                    ((pairs["id"] == earlier["x"]) & (pairs["leader"] == earlier["y"])),
                    "left_anti",
                ).join(
                    earlier,
                    ((pairs["id"] == earlier["y"]) & (pairs["leader"] == earlier["x"])),
                    "left_anti",
                )
            pairs = stage(pairs)
            tried.append(pairs.select(F.col("id").alias("x"), F.col("leader").alias("y")))
            sizes = stage(pairs.groupBy("leader").agg(F.ceil(F.count("*") / PAIRS_PER_TASK).alias("parts")))
            dealt = stage(
                pairs.join(sizes, "leader").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).withColumn(
                    "group", F.col("leader")
                )
            )
            leaders = dealt.groupBy("group", "part").agg(
                F.first("leader").alias("id"), F.first("leader_label").alias("label")
            )
            all_of = {"n": F.lit(None).cast("long"), "homes": F.lit(None).cast("array<long>")}
            found = search.verified(leaders.withColumns(all_of), dealt.withColumns(all_of))
        new = stage(found)
        links = new if links is None else links.unionByName(new)
        if labels is not None:
            stage.drop(labels)
        labels = components(links, stage)
    if labels is None:
        labels = spark.createDataFrame([], "id long, component long")
    stage.drop(texts, company, ranked)
    # a class's group is its representative's; members find their class by digest
    known = labels.withColumnRenamed("id", "__id")
    of_class = classes.join(known, F.col("rep") == F.col("__id"), "left").select(
        F.col("digest").alias("__digest"),
        F.col("n_shingles").alias("__n"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    of_class = stage(of_class)
    joined = signed.join(
        of_class, (signed["digest"] == of_class["__digest"]) & (signed["n_shingles"] == of_class["__n"]), "left"
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return joined.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept")
    )


def _blocked(search: _Search, labelled: DataFrame, sizes: DataFrame) -> DataFrame:
    """Whatever a bucket's leaders left apart: its classes outside the bucket's largest group, in blocks of BLOCK,
    against all its classes. Buckets with one largest group (their home) are taken together, as they hold much the same;
    a class has BANDS homes at most, and a pair is compared in the first home that it shares."""
    stage = search.stage
    counts = labelled.groupBy("key", "label").agg(F.count("*").alias("c"))
    largest = stage(counts.groupBy("key").agg(F.max(F.struct("c", "label")).alias("m")).select("key", F.col("m.label").alias("home")))
    places = stage(labelled.join(largest, "key").select("home", "rep", "label").distinct())
    known = stage(places.groupBy("rep").agg(F.sort_array(F.collect_set("home")).alias("homes")).join(sizes, "rep"))
    apart = F.col("label") != F.col("home")
    blocks = stage(places.where(apart).groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    sized = places.join(blocks, "home").join(known, "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    columns = [F.col("home").alias("group"), "part", F.col("rep").alias("id"), "label", "n", "homes"]
    leaders = sized.where(apart).withColumn("part", own).select(*columns)
    members = sized.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(*columns)
    return search.verified(leaders, members)
