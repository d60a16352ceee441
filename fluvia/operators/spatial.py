"""Spatial joins: pairs by buckets as wide as the distance; sums and nearest points by tiles, without a row for each pair."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvia.operators import tiles
from fluvia.operators.regions import written


def _bucket(df: DataFrame, x: str, y: str, d: float, around: bool) -> DataFrame:
    bx, by = F.floor(F.col(x) / d), F.floor(F.col(y) / d)
    if not around:
        return df.withColumn("_bx", bx).withColumn("_by", by)
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return df.withColumn("_s", F.explode(steps)).withColumn("_bx", bx + F.col("_s.i")).withColumn("_by", by + F.col("_s.j")).drop("_s")


def squared(ax: str, ay: str, bx: str, by: str) -> Column:
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return dx * dx + dy * dy


def within(sites: DataFrame, points: DataFrame, d: float, site_xy=("x", "y"), point_xy=("px", "py")) -> DataFrame:
    """Pairs at most d apart, with their squared distance."""
    a, b = _bucket(sites, *site_xy, d, True), _bucket(points, *point_xy, d, False)
    return a.join(b, ["_bx", "_by"]).drop("_bx", "_by").withColumn("d2", squared(*site_xy, *point_xy)).where(F.col("d2") <= d * d)


def sums_by_key(sites: DataFrame, points: DataFrame, key: str, value: str, d: float) -> DataFrame:
    """(key, total, n, rows): values of points within d of the sites of a key, 0 where there are none, and the number of those sites."""
    p = points.select("px", "py", F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v"))
    own = sites.select(key, "x", "y")

    def run(s: pa.Table, p: pa.Table) -> pa.Table:
        total, n = tiles.sums(*tiles.values(s, "x", "y"), *tiles.values(p, "px", "py", "v"), d)
        return pa.table({key: s[key], "total": total, "n": n, "rows": (np.asarray(s["_b"]) == 0).astype(np.int64)})

    got = tiles.met(own, p, d, (F.col("px"), F.col("px"), F.col("py"), F.col("py")), run, f"`{key}` {own.schema[key].dataType.simpleString()}, total double, n long, rows long")
    none = F.lit(0).cast("long")
    apart = own.where(~tiles.known(F.col("x"), F.col("y"))).select(key, F.lit(0.0).alias("total"), none.alias("n"), F.lit(1).cast("long").alias("rows"))
    return got.unionByName(apart).groupBy(key).agg(*[F.sum(c).alias(c) for c in ("total", "n", "rows")])


def sum_within(sites: DataFrame, points: DataFrame, key: str, value: str, d: float) -> DataFrame:
    """(key, total, n) for each site: values of points within d of the sites of its key; 0 where there are none."""
    there = lambda c: F.when(F.col(key).isNotNull(), F.col(c)).otherwise(0).alias(c)
    return sums_by_key(sites, points, key, value, d).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).select(key, there("total"), there("n"))


def near_any(points: DataFrame, zone: DataFrame, d: float) -> DataFrame:
    """Points within d of any zone point, each once."""
    z = _bucket(zone.select(F.col("x").alias("_zx"), F.col("y").alias("_zy")), "_zx", "_zy", d, True)
    p = _bucket(points, "px", "py", d, False)
    near = squared("px", "py", "_zx", "_zy") <= d * d
    return p.join(z, (p["_bx"] == z["_bx"]) & (p["_by"] == z["_by"]) & near, "left_semi").drop("_bx", "_by")


def nearest(sites: DataFrame, places: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name, distance) of the nearest place; ties go to the smaller name.

    Sites look within a distance at which a bucket of the middle nine tenths of
    places holds about one; those that found none look again twice as far, up to
    the extent of all. A place far away from the rest so changes the number of
    rounds, not the buckets. Places at one spot count as one, by the smallest
    name. Rows without coordinates take no part; without places there are no rows.
    """
    places = places.where("px is not null and py is not null").groupBy("px", "py").agg(F.min(name).alias(name))
    places = written(places)
    left = written(sites.select(key, "x", "y").where("x is not null and y is not null"))
    middle = F.percentile_approx("px", F.array(F.lit(0.05), F.lit(0.95))).alias("x"), F.percentile_approx("py", F.array(F.lit(0.05), F.lit(0.95))).alias("y")
    n, ax, bx, ay, by, mx, my = places.agg(F.count(F.lit(1)), F.min("px"), F.max("px"), F.min("py"), F.max("py"), *middle).first()
    cx, dx, cy, dy = left.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if not n or cx is None:
        return within(left, places, 1.0).select(key, name, F.sqrt("d2").alias("distance"))
    reach = max(math.hypot(max(bx, dx) - min(ax, cx), max(by, dy) - min(ay, cy)), 1e-9) * 1.001
    core = math.sqrt((mx[1] - mx[0]) * (my[1] - my[0]) / n) or max(mx[1] - mx[0], my[1] - my[0]) / n
    d = min(reach, core or reach / 1024)
    found = []
    while True:
        best = written(nearest_within(left, places, key, name, d, side=16.0).groupBy(key).agg(F.min(F.struct("d2", name)).alias("b")))
        found.append(best)
        left = written(left.join(best, key, "left_anti"))
        if d >= reach or left.isEmpty():
            break
        d = min(2 * d, reach)
    every = reduce(DataFrame.unionByName, found)
    return every.select(key, F.col(f"b.{name}").alias(name), F.sqrt("b.d2").alias("distance"))


def nearest_within(sites: DataFrame, points: DataFrame, key: str, name: str, d: float, one: bool = True, more: Sequence[str] = (), own: Sequence[str] = (), side: float = 2.0) -> DataFrame:
    """(key, own columns of the site, name, more columns of the point, d2): the nearest points within d of each site, the one of the smallest name or all equally near ones.

    Where a tile's points are cut, and where rows share a key, there is a row for each part and each row.
    """
    s, p = sites.select(key, "x", "y", *own), points.select(name, "px", "py", *more)
    types = [(c, f.schema[c].dataType.simpleString()) for f, cols in ((s, (key, *own)), (p, (name, *more))) for c in cols]

    def run(s: pa.Table, p: pa.Table) -> pa.Table:
        p = p.sort_by(name) if one else p
        i, j, d2 = tiles.nearest(*tiles.values(s, "x", "y"), *tiles.values(p, "px", "py"), d, one)
        s, p = s.select([key, *own]).take(pa.array(i)), p.select([name, *more]).take(pa.array(j))
        return pa.table({**dict(zip(s.column_names, s.columns, strict=True)), **dict(zip(p.column_names, p.columns, strict=True)), "d2": d2})

    return tiles.met(s, p, d, (F.col("px"), F.col("px"), F.col("py"), F.col("py")), run, ", ".join(f"`{c}` {t}" for c, t in types) + ", d2 double", side)


def bounded_nearest(sites: DataFrame, points: DataFrame, key: str, name: str, d: float) -> DataFrame:
    """(key, name, distance): the nearest points within d; equally near ones all stay."""
    # rows of one key are few where keys are: at most the ties of a site's parts meet in a window
    w = Window.partitionBy(key).orderBy("d2")
    return nearest_within(sites, points, key, name, d, one=False).withColumn("_r", F.rank().over(w)).where("_r = 1").select(key, name, F.sqrt("d2").alias("distance"))


def inside_polygon(cells: DataFrame, ring: list[tuple[float, float]], x: str = "x", y: str = "y") -> DataFrame:
    """Adds inside: parity of the ring's edges crossed to the right of a cell's centre. The ring is a parameter, so edges are literals."""
    edges = [(ax, ay, bx, by) for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True) if ay != by]
    crossings = F.lit(0)
    for ax, ay, bx, by in edges:
        spans = (F.lit(ay) > F.col(y)) != (F.lit(by) > F.col(y))
        at = (F.col(y) - ay) * ((bx - ax) / (by - ay)) + ax
        crossings = crossings + F.when(spans & (F.col(x) < at), 1).otherwise(0)
    return cells.withColumn("inside", crossings % 2 == 1)
