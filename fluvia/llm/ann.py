"""Nearest neighbours from forests of random-projection trees.

Vectors are dealt into shards of about ``SHARD_ROWS`` rows. Each shard grows
``TREES`` trees; a node halves its rows at the median of their projection on the
difference of two of them. A query walks all trees of a shard through one
shared priority queue, ordered by the widest margin that a path has crossed,
until the leaves hold ``share`` of the shard's vec_ids, and k at least; the
candidates' exact distances give the shard's best, and the best of all shards are
the result. Queries meet shards in groups of bounded size, so no task holds more
than a shard and a group. Every vector is indexed.

Vectors that are null, empty, zero, or hold null or non-finite components, and
rows without vec_id, take no part. Vectors are near only to those of their own
length. Rows of one vec_id are one vector: the nearest of them counts, and none
is a candidate of its own query. Ties go to the smaller vec_id. Other columns
aren't read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluvia.llm import _blocks as B

SHARD_ROWS, QUERY_ROWS = 8192, 16384
TREES, LEAF, SHARE = 8, 48, 0.62


class Forest:
    def __init__(self, x: np.ndarray, seed: int, trees: int = TREES, leaf: int = LEAF):
        self.x, self.leaf = x, leaf
        rng = np.random.default_rng(seed)
        self.roots = [self._grow(np.arange(len(x)), rng) for _ in range(trees)]

    def _grow(self, rows: np.ndarray, rng: np.random.Generator):
        """A leaf's rows, or (direction, median, lower side, upper side)."""
        if len(rows) <= self.leaf:
            return rows
        a, b = self.x[rows[rng.choice(len(rows), 2, replace=False)]]
        direction = a - b
        if not direction.any():
            direction = rng.normal(size=self.x.shape[1])
        direction = direction / np.linalg.norm(direction)
        p = self.x[rows] @ direction
        cut = np.median(p)
        low = p < cut
        if not low.any():
            return rows  # all alike here
        return direction, cut, self._grow(rows[low], rng), self._grow(rows[~low], rng)

    def candidates(self, q: np.ndarray, least: int, names: np.ndarray) -> np.ndarray:
        """Rows of the leaves that the queue reaches first, until they have so many different names (numbers from 0)."""
        seen, named = np.zeros(len(self.x), bool), np.zeros(int(names.max()) + 1, bool)
        queue = [(0.0, k, root) for k, root in enumerate(self.roots)]
        ticket, found = len(queue), 0
        while queue and found < least:
            margin, _, node = heapq.heappop(queue)
            while isinstance(node, tuple):
                direction, cut, low, high = node
                side = float(q @ direction) - cut
                node, far = (high, low) if side >= 0 else (low, high)
                heapq.heappush(queue, (max(margin, abs(side)), ticket, far))
                ticket += 1
            seen[node] = True
            new = names[node]
            found += len(np.unique(new[~named[new]]))
            named[new] = True
        return np.flatnonzero(seen)


def _matrix(blobs: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in blobs), np.float64).reshape(-1, dim)


def _search(k: int, share: float):
    def run(key, left, right):
        ids, qids = np.asarray(left["vec_id"]), np.asarray(right["query_id"])
        out_q, out_v, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(ids) and len(qids):
            order, q_order = np.argsort(ids, kind="stable"), np.argsort(qids, kind="stable")
            dim = key[0].as_py()
            ids, x = ids[order], _matrix(left["x"].take(pa.array(order)), dim)
            qids, q = qids[q_order], _matrix(right["q"].take(pa.array(q_order)), dim)
            forest = Forest(x, seed=key[1].as_py())
            different, names = np.unique(ids, return_inverse=True)
            least = max(k + 1, math.ceil(share * len(different)))
            for name, v in zip(qids.tolist(), q, strict=True):
                rows = forest.candidates(v, least, names)
                rows = rows[ids[rows] != name]
                d = x[rows] - v
                score = np.sqrt(np.einsum("ij,ij->i", d, d))
                best = np.lexsort((ids[rows], score))
                _, first = np.unique(ids[rows][best], return_index=True)  # a vec_id once, at its nearest
                best = best[np.sort(first)[:k]]
                out_q.append(np.full(len(best), name))
                out_v.append(ids[rows][best])
                out_s.append(score[best])
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    return run


def _packed(batches):
    for b in batches:
        x = b["embedding"].cast(pa.list_(pa.float64()))
        o, v = np.asarray(x.offsets), np.asarray(x.values)
        yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(np.diff(o), pa.int32()), pa.array([v[i:j].tobytes() for i, j in zip(o[:-1], o[1:], strict=True)], pa.binary())], ["vec_id", "dim", "x"])


def usable(vectors: DataFrame) -> DataFrame:
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)


def neighbours(vectors: DataFrame, every: int = 100, k: int = 10, share: float = SHARE, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each vector whose vec_id is divisible by ``every``."""
    rows = usable(vectors)
    count = rows.count()
    shards, groups = max(1, math.ceil(count / shard_rows)), max(1, math.ceil(count / every / query_rows))
    packed = rows.mapInArrow(_packed, "vec_id long, dim int, x binary")
    place = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    left = packed.withColumn("shard", place(shards, 0)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = packed.where(F.col("vec_id") % every == 0).select("dim", F.col("vec_id").alias("query_id"), F.col("x").alias("q"), place(groups, 1).alias("part")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    key = ["dim", "shard", "part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_search(k, share), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
