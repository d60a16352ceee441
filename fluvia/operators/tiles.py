"""Sites and what lies within a distance of them, without a row for each pair.

Both sides are dealt to tiles of a few distances: a site to its own, a point or
segment to each tile that it can be near. One Arrow group holds the sites and
the points of some tiles; a tile of more rows than ``SITES`` or ``POINTS`` is
cut into parts, and each part of its sites meets each part of its points. In a
group, compact blocks of sites meet compact blocks of points: blocks that lie
within the distance as a whole count as one, the pairs of the others are tested
in small matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvia.operators.regions import written

#: Rows of a tile in one part; sites of a task; rows of a block of sites and of points; columns of a matrix.
SITES, POINTS, TASK, OWN, BLOCK, WIDE = 200_000, 500_000, 50_000, 64, 16, 4096
#: What boxes are widened by, so that rounding leaves no pair out: pairs at the border are tested one by one.
SLACK = 1e-9
UNIT = ["_tx", "_ty", "_a", "_b"]


def known(*columns: Column) -> Column:
    """Whether all are finite numbers."""
    every = F.lit(True)
    for c in columns:
        every = every & F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))
    return every


def _sizes(*frames: DataFrame) -> list[tuple[int, int]]:
    """Rows of the fullest tile and of all tiles of each frame, by one job."""
    every = [f.select("_tx", "_ty", F.lit(k).alias("_k")) for k, f in enumerate(frames)]
    n = reduce(DataFrame.unionByName, every).groupBy("_tx", "_ty", "_k").agg(F.count(F.lit(1)).alias("_n"))
    got = {r[0]: (r[1], r[2]) for r in n.groupBy("_k").agg(F.max("_n"), F.sum("_n")).collect()}
    return [got.get(k, (0, 0)) for k in range(len(frames))]


def _many(df: DataFrame, most: int) -> DataFrame:
    """(_tx, _ty, parts) of the tiles with more rows than most."""
    n = df.groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias("_n"))
    return written(n.where(F.col("_n") > most).select("_tx", "_ty", F.ceil(F.col("_n") / most).alias("_parts")))


def _cut(df: DataFrame, many: DataFrame | None, name: str, own: bool) -> DataFrame:
    """Adds the part of a tile that a row is in (own), or a row for each part."""
    if many is None:
        return df.withColumn(name, F.lit(0))
    of = F.coalesce("_parts", F.lit(1))
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), of).cast("int") if own else F.explode(F.sequence(F.lit(0), (of - 1).cast("int")))
    return df.join(many, ["_tx", "_ty"], "left").withColumn(name, part).drop("_parts")


def met(sites: DataFrame, points: DataFrame, d: float, box: tuple[Column, Column, Column, Column], run: Callable[[pa.Table, pa.Table], pa.Table], out: str, side: float = 2.0) -> DataFrame:
    """run(sites, points) for the sites (x, y, ...) of each part of a tile and the points whose box (from x, to x, from y, to y) can be within d of them.

    A site is in one part, but meets the points in several runs (numbered _b
    from 0, a column of sites) where those are cut. Rows without coordinates
    take no part. ``side`` is that of a tile, in d.
    """
    side = side * d
    tile = lambda c: F.floor(c / side)
    reach = d * (1 + SLACK)
    span = lambda p, q: F.explode(F.sequence(tile(p - reach - SLACK * F.abs(p)), tile(q + reach + SLACK * F.abs(q))))
    s = sites.where(known(F.col("x"), F.col("y"))).withColumn("_tx", tile(F.col("x"))).withColumn("_ty", tile(F.col("y")))
    p = points.where(known(*box)).withColumn("_tx", span(*box[:2])).withColumn("_ty", span(*box[2:]))
    (top_s, n), (top_p, _) = _sizes(s, p)
    many_s, many_p = _many(s, SITES) if top_s > SITES else None, _many(p, POINTS) if top_p > POINTS else None
    s = _cut(_cut(s, many_s, "_a", True), many_p, "_b", False)
    p = _cut(_cut(p, many_s, "_a", False), many_p, "_b", True)
    tasks = max(1, -(-n // TASK))
    group = F.pmod(F.xxhash64(*UNIT), F.lit(4 * tasks)).cast("int")
    s, p = (x.withColumn("_g", group).repartition(tasks, "_g") for x in (s, p))

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        got = [run(a, b) for a, b in _units(left, right)]
        return pa.concat_tables(got) if got else empty

    empty = run(_none(sites.withColumn("_b", F.lit(0))), _none(points))
    return s.groupBy("_g").cogroup(p.groupBy("_g")).applyInArrow(each, out)


def _none(df: DataFrame) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema).empty_table()


def _units(left: pa.Table, right: pa.Table) -> Iterator[tuple[pa.Table, pa.Table]]:
    """The sites of each part of a tile, and its points (there may be none)."""
    n = left.num_rows
    if not n:
        return
    u = np.zeros(n + right.num_rows, np.int64)
    for c in UNIT:
        k, inverse = np.unique(np.concatenate([np.asarray(left[c]), np.asarray(right[c])]), return_inverse=True)
        u = np.unique(u * len(k) + inverse, return_inverse=True)[1]
    orders = [np.argsort(v, kind="stable") for v in (u[:n], u[n:])]
    left, right = (t.take(pa.array(o)).combine_chunks() for t, o in zip((left, right), orders, strict=True))
    a, b = u[:n][orders[0]], u[n:][orders[1]]
    there = np.unique(a)
    ends = [np.searchsorted(v, there, side) for v in (a, b) for side in ("left", "right")]
    for i, j, k, m in zip(*(e.tolist() for e in ends), strict=True):
        yield left.slice(i, j - i), right.slice(k, m - k)


def values(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns as doubles; missing values are NaN."""
    return [table[c].cast(pa.float64()).to_numpy() for c in names]


class Blocks:
    """Rows in runs of ``size``: slabs along x, runs along y in each. order, starts, and the runs' boxes."""

    def __init__(self, size: int, x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray):
        n, self.size = len(x0), size
        slab = max(1, -(-n // (size * max(1, round((n / size) ** 0.5))))) * size
        by_x = np.argsort(x0, kind="stable")
        self.order = by_x[np.lexsort((y0[by_x], np.arange(n) // slab))]
        self.starts = np.arange(0, n, size)
        of = lambda f, v: f.reduceat(v[self.order], self.starts) if n else v[:0]
        self.boxes = of(np.minimum, x0), of(np.maximum, x1), of(np.minimum, y0), of(np.maximum, y1)

    def rows(self, blocks: np.ndarray) -> np.ndarray:
        """Places in ``order`` of the rows of some blocks."""
        at = (self.starts[blocks][:, None] + np.arange(self.size)).ravel()
        return at[at < len(self.order)]

    def each(self) -> Iterator[tuple[np.ndarray, tuple[float, float, float, float]]]:
        for k, at in enumerate(self.starts.tolist()):
            yield self.order[at : at + self.size], tuple(b[k] for b in self.boxes)


def apart(box, boxes) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between points of a box and of each of others."""
    (ax, bx, ay, by), (px, qx, py, qy) = box, boxes
    near = lambda a, b, p, q: np.maximum(np.maximum(p - b, a - q), 0.0)
    far = lambda a, b, p, q: np.maximum(q - a, b - p)
    return near(ax, bx, px, qx) ** 2 + near(ay, by, py, qy) ** 2, far(ax, bx, px, qx) ** 2 + far(ay, by, py, qy) ** 2


def sums(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, v: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each site, the sum of the points' values within d (NaN ones are NaN) and their number."""
    total, n, dd = np.zeros(len(x)), np.zeros(len(x), np.int64), d * d
    if not len(px):
        return total, n
    p = Blocks(BLOCK, px, px, py, py)
    px, py, v = px[p.order], py[p.order], v[p.order]
    plain = bool(np.isfinite(v).all())
    block_v, block_n = np.add.reduceat(v, p.starts), np.diff(np.append(p.starts, len(v)))
    for own, box in Blocks(OWN, x, x, y, y).each():
        near, far = apart(box, p.boxes)
        whole = far <= dd * (1 - SLACK)
        some = p.rows(np.flatnonzero((near <= dd * (1 + SLACK)) & ~whole))
        near, far = apart(box, (px[some], px[some], py[some], py[some]))
        sure = far <= dd * (1 - SLACK)
        total[own] = block_v[whole].sum() + v[some[sure]].sum()
        n[own] = block_n[whole].sum() + np.count_nonzero(sure)
        some = some[(near <= dd * (1 + SLACK)) & ~sure]
        for k in range(0, len(some), WIDE):
            at = some[k : k + WIDE]
            dx, dy = x[own][:, None] - px[at], y[own][:, None] - py[at]
            inside = dx * dx + dy * dy <= dd
            total[own] += inside.astype(float) @ v[at] if plain else np.where(inside, v[at], 0.0).sum(axis=1)
            n[own] += np.count_nonzero(inside, axis=1)
    return total, n


def nearest(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, d: float, one: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(site, point, squared distance) of the nearest points within d: all equally near ones, or the first of them."""
    found, dd = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], d * d
    if len(px):
        p = Blocks(BLOCK, px, px, py, py)
        qx, qy = px[p.order], py[p.order]
        for own, box in Blocks(OWN, x, x, y, y).each():
            near, far = apart(box, p.boxes)
            some = p.rows(np.flatnonzero(near <= min(dd, far.min()) * (1 + SLACK)))
            if not len(some):
                continue
            near, far = apart(box, (qx[some], qx[some], qy[some], qy[some]))
            some = np.sort(p.order[some[near <= min(dd, far.min()) * (1 + SLACK)]])
            best, first = np.full(len(own), np.inf), np.zeros(len(own), np.int64)
            for k in range(0, len(some), WIDE):
                at = some[k : k + WIDE]
                d2 = _squared(x[own], y[own], px[at], py[at])
                j = d2.argmin(axis=1)
                top = d2[np.arange(len(own)), j]
                first, best = np.where(top < best, at[j], first), np.minimum(top, best)
            if one:
                ok = best <= dd
                found.append((own[ok], first[ok], best[ok]))
                continue
            for k in range(0, len(some), WIDE):
                at = some[k : k + WIDE]
                d2 = _squared(x[own], y[own], px[at], py[at])
                i, j = np.nonzero((d2 == best[:, None]) & (best <= dd)[:, None])
                found.append((own[i], at[j], best[i]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def _squared(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    dx, dy = x[:, None] - px, y[:, None] - py
    return dx * dx + dy * dy


def lengths(x: np.ndarray, y: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, d: float) -> np.ndarray:
    """Of each site, the length of the segments inside the circle of radius d around it."""
    total, dd = np.zeros(len(x)), d * d
    sx, sy = x2 - x1, y2 - y1
    qa = sx * sx + sy * sy
    long, boxes = np.sqrt(qa), (np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2))
    real = qa > 0
    for own, box in Blocks(OWN, x, x, y, y).each():
        near, far = apart(box, boxes)
        whole = far <= dd * (1 - SLACK)  # both ends inside every circle of the block
        total[own] = long[whole].sum()
        some = np.flatnonzero(real & (near <= dd * (1 + SLACK)) & ~whole)
        # the segment's own distance from the middle of the block
        mx, my, half = (box[0] + box[1]) / 2, (box[2] + box[3]) / 2, np.hypot(box[1] - box[0], box[3] - box[2]) / 2
        t = np.clip(((mx - x1[some]) * sx[some] + (my - y1[some]) * sy[some]) / qa[some], 0.0, 1.0)
        some = some[np.hypot(x1[some] + t * sx[some] - mx, y1[some] + t * sy[some] - my) <= (d + half) * (1 + SLACK)]
        for k in range(0, len(some), WIDE):
            at = some[k : k + WIDE]
            fx, fy, a = x1[at] - x[own][:, None], y1[at] - y[own][:, None], qa[at]
            qb = fx * sx[at] + fy * sy[at]
            under = qb * qb - a * (fx * fx + fy * fy - dd)
            root = np.sqrt(np.maximum(under, 0.0))
            span = np.clip((root - qb) / a, 0.0, 1.0) - np.clip((-qb - root) / a, 0.0, 1.0)
            total[own] += np.where(under > 0, span, 0.0) @ long[at]
    return total
