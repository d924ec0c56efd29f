"""Connected components of an edge list: union-find inside partitions, joined by pointer jumps between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from peerscope.llm.shared import stage
from peerscope.operators.joins import salted_join

MAX_STEPS = 60
JUMPS = 3  # pointer jumps a step: chains shorten eightfold
EDGES_A_TASK = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of a partition's edges with the smallest node it is linked to there.

    ``home``: the node's own partition (edges are dealt by ``a``), so this is its only parent.
    """
    parent: dict = {}
    home: set = set()
    schema = None

    def root(x):
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            home.add(a)
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    found = [(x, root(x)) for x in list(parent)]
    found = [(x, r) for x, r in found if x != r]
    if found:
        kind = schema.field("a").type
        yield pa.record_batch({"a": pa.array([x for x, _ in found], kind), "b": pa.array([r for _, r in found], kind),
                               "home": pa.array([x in home for x, _ in found], pa.bool_())})


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): root is the smallest node reachable, itself included.

    Null ends and loops link nothing.  A step deals the edges by their larger end, contracts each partition to a
    forest, stages it in the shared folder, and lets every pointer jump to its parent's parent several times; a hub's
    pointers are spread over several tasks.  A partition takes about ``EDGES_A_TASK`` edges, so what fits one task is
    done in one step.  Only counts and two flags reach the driver.
    """
    name = edges.schema["a"].dataType.simpleString()
    current = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(current, "edges")
    parts = -(-current.count() // EDGES_A_TASK)
    for _ in range(MAX_STEPS):
        stars = stage((current.repartition(1) if parts <= 1 else current.repartition(parts, "a")).mapInArrow(_contract, f"a {name}, b {name}, home boolean"), "stars")
        parents = stars.filter("home").select(F.col("a").alias("b"), F.col("b").alias("m"))
        current = stars.select("a", "b")
        if parts <= 1 or stars.filter("NOT home").isEmpty() and current.join(parents, "b", "left_semi").isEmpty():
            forest = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return forest.union(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        for _ in range(JUMPS):
            current = salted_join(current, parents, "b", "a", "left").select("a", F.coalesce("m", "b").alias("b"))
    raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
