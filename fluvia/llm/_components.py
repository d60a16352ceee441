"""Connected components of links between integers, on executors only.

Partitions first replace their links by a spanning star (union-find over the
partition's own links). While more than ``SINGLE`` links remain, rounds of
hooking every node to its smallest neighbour and contracting shrink them; what
is left fits one task of proven size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvia.llm import _blocks as B

SINGLE = 400_000


def find(parent: dict[int, int], x: int) -> int:
    root = x
    while parent.get(root, root) != root:
        root = parent[root]
    while parent.get(x, x) != root:
        parent[x], x = root, parent[x]
    return root


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that connect what links (a, b) do."""
    parent: dict[int, int] = {}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(parent, x), find(parent, y)
        parent.setdefault(x, x)
        parent.setdefault(y, y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if parent[x] != x]
    return np.array(nodes, np.int64), np.array([find(parent, x) for x in nodes], np.int64)


def _contract(batches):
    held = [(np.asarray(b["a"]), np.asarray(b["b"])) for b in batches]
    if held:
        a, b = stars(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        yield pa.RecordBatch.from_pydict({"a": a, "b": b})


def components(links: DataFrame, single: int = SINGLE) -> DataFrame:
    """(node, component): each node of links (a, b) and the smallest node that it reaches."""
    links = B.written(links.select("a", "b").where("a <> b").mapInArrow(_contract, "a long, b long"))
    levels: list[DataFrame] = []
    count = links.count()
    while count > single:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("to"))
        # a node that hooks to one which hooks on goes there in the same round
        up = B.written(hook.join(hook.select(F.col("a").alias("to"), F.col("to").alias("top")), "to", "left").select("a", F.coalesce("top", "to").alias("to")))
        levels.append(up)
        step = links.join(up.withColumnRenamed("to", "a2"), "a").join(up.select(F.col("a").alias("b"), F.col("to").alias("b2")), "b")
        links = B.written(step.select(F.col("a2").alias("a"), F.col("b2").alias("b")).where("a <> b").distinct().mapInArrow(_contract, "a long, b long"))
        count = links.count()
    found = links.repartition(1).mapInArrow(_contract, "a long, b long").select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    for up in reversed(levels):
        root = found.select(F.col("node").alias("to"), "component")
        found = up.join(root, "to", "left").select(F.col("a").alias("node"), F.coalesce("component", "to").alias("component"))
    return found
