"""Connected components of links between ids, as Spark jobs.

Each task first reduces its links to a forest by union-find; then labels travel along links, and jump
to the label of their label, until none changes. Every aggregate is a minimum, which combines before
its shuffle, and joins are plain equi-joins that AQE splits where an id has very many links.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.llm.common import Stage

FOREST_IDS = 1 << 19  # ids a task's union-find holds at a time


class UnionFind(dict):
    """Smallest known member of each id's set."""

    def find(self, x: int) -> int:
        root = x
        while (up := self.get(root, root)) != root:
            root = up
        while x != root:
            self[x], x = root, self.get(x, x)
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.setdefault(a, a)
        self.setdefault(b, b)
        if a != b:
            self[max(a, b)] = min(a, b)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(sets: UnionFind) -> pa.RecordBatch:
        pairs = [(x, sets.find(x)) for x in list(sets)]
        pairs = [(x, r) for x, r in pairs if x != r]
        return pa.RecordBatch.from_pydict(
            {"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([r for _, r in pairs], pa.int64())}
        )

    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.union(a, b)
        if len(sets) > FOREST_IDS:
            yield out(sets)
            sets = UnionFind()
    yield out(sets)


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b: long); the component is its smallest id."""
    forest = stage(links.select("a", "b").mapInArrow(_forest, "a long, b long"))
    both = forest.select("a", "b").union(forest.select(F.col("b"), F.col("a")))
    edges = stage(both.distinct())
    stage.drop(forest)
    labels = stage(
        edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component"))
    )
    while True:
        near = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("near"))
        offered = labels.join(near, labels["id"] == near["a"]).select(
            "id", F.col("component").alias("was"), F.least("component", "near").alias("c")
        )
        up = labels.select(F.col("id").alias("up"), F.col("component").alias("far"))
        jumped = stage(
            offered.join(up, F.col("c") == F.col("up"), "left").select(
                "id", "was", F.least("c", F.coalesce("far", "c")).alias("component")
            )
        )
        settled = jumped.where(F.col("was") != F.col("component")).limit(1).count() == 0
        stage.drop(labels)
        labels = stage.passed_on(jumped, jumped.select("id", "component"))
        if settled:
            stage.drop(edges)
            return labels
