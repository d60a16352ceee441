"""Connected regions of pixels: components, sieve, rivers, distances, patches.

Components are found in tiles first (union-find over a tile's cells in one
Arrow group), then merged across tile borders by hooking and contraction on the
small graph of border regions. Lineage is cut in the shared checkpoint folder.
"""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ["row", "col"]
TILE = 256
WIDE = 1 << 31
_own: dict[str, str] = {}
_roots: set[str] = set()


def written(df: DataFrame) -> DataFrame:
    """The frame written to the folder that the cluster shares and read again: its lineage ends there."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = _own[app] = _own.get(app) or "file://" + tempfile.mkdtemp(prefix="fluvia-")
    root = f"{at.rstrip('/')}/fluvia-{app}-grid"
    if root not in _roots:
        _roots.add(root)
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)  # by the JVM as it ends
    path = f"{root}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _label_tile(table: pa.Table) -> pa.Table:
    """The smallest cell key of each 8-connected region of a tile's cells of one class."""
    r, c, k = (np.asarray(table[x]) for x in ("row", "col", "cls"))
    parent: dict[tuple[int, int], tuple[int, int]] = {}
    cls = dict(zip(zip(r.tolist(), c.tolist(), strict=True), k.tolist(), strict=True))

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for (i, j), v in cls.items():
        for near in ((i, j - 1), (i - 1, j - 1), (i - 1, j), (i - 1, j + 1)):
            if cls.get(near) == v:
                a, b = find((i, j)), find(near)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    roots = [find(x) for x in zip(r.tolist(), c.tolist(), strict=True)]
    return pa.table({"row": pa.array(r, pa.int32()), "col": pa.array(c, pa.int32()), "cls": pa.array(k, pa.int32()), "part": pa.array([a * WIDE + b for a, b in roots], pa.int64())})


def _stars(batches):
    """A partition's links as (node, smallest node that the partition's links lead to)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for x, y in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            x, y = find(x), find(y)
            parent.setdefault(x, x)
            parent.setdefault(y, y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if parent[x] != x]
    yield pa.RecordBatch.from_pydict({"a": pa.array(nodes, pa.int64()), "b": pa.array([find(x) for x in nodes], pa.int64())})


def merged(links: DataFrame) -> DataFrame:
    """(node, top): nodes of links (a, b) with the smallest node that they reach. Each partition shortens its own links, then hooking and contraction join the partitions'."""
    levels = []
    short = lambda df: written(df.distinct().mapInArrow(_stars, "a long, b long"))
    links = short(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"))
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.least("a", F.min("b")).alias("up"))
        hook = written(hook.join(hook.select(F.col("a").alias("up"), F.col("up").alias("upper")), "up", "left").select("a", F.coalesce("upper", "up").alias("up")))
        levels.append(hook)
        step = links.join(hook.withColumnRenamed("up", "x"), "a").join(hook.select(F.col("a").alias("b"), F.col("up").alias("y")), "b")
        links = short(step.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).where("a <> b"))
    if not levels:
        return links.select(F.col("a").alias("node"), F.col("b").alias("top"))
    found = levels[-1].select(F.col("a").alias("node"), F.col("up").alias("top"))
    for hook in reversed(levels[:-1]):
        over = found.select(F.col("node").alias("up"), F.col("top").alias("over"))
        found = hook.join(over, "up", "left").select(F.col("a").alias("node"), F.coalesce("over", "up").alias("top"))
    return written(found)


def components(cells: DataFrame, tile: int = TILE) -> DataFrame:
    """(row, col, cls, region): 8-connected regions of cells of one class; region is row * 2**31 + col of its first cell."""
    k = F.col("cls") if "cls" in cells.columns else F.lit(1)
    own = cells.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), k.cast("int").alias("cls"))
    tiles = own.withColumn("tr", F.expr(f"row div {tile}")).withColumn("tc", F.expr(f"col div {tile}"))
    parts = written(tiles.groupBy("tr", "tc").applyInArrow(lambda t: _label_tile(t.drop_columns(["tr", "tc"])), "row int, col int, cls int, part long"))
    edge = parts.where(f"row % {tile} in (0, {tile - 1}) or col % {tile} in (0, {tile - 1})")
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, -1), (-1, -1), (-1, 0), (-1, 1))])
    near = edge.select("cls", F.col("part").alias("other"), F.col("row").alias("_r"), F.col("col").alias("_c"), F.explode(steps).alias("s")).select("cls", "other", (F.col("_r") + F.col("s.a")).alias("row"), (F.col("_c") + F.col("s.b")).alias("col"))
    links = edge.join(near, [*CELL, "cls"]).where("part <> other").select(F.col("part").alias("a"), F.col("other").alias("b"))
    top = merged(links)
    return parts.join(top.withColumnRenamed("node", "part"), "part", "left").select(*CELL, "cls", F.coalesce("top", "part").alias("region"))


def region_sizes(regions: DataFrame) -> DataFrame:
    return regions.groupBy("region").agg(F.count(F.lit(1)).alias("size"))


def large_regions(mask: DataFrame, least: int) -> DataFrame:
    """Cells of regions of at least so many cells (a river, when the mask is water)."""
    regions = components(mask)
    return regions.join(region_sizes(regions).where(F.col("size") >= least), "region", "left_semi").select(*CELL)


def sieve(cells: DataFrame, least: int) -> DataFrame:
    """(row, col, cls): regions under ``least`` cells take the class of the largest region next to them (ties: smaller region key)."""
    regions = written(components(cells))
    sizes = region_sizes(regions)
    small = sizes.where(F.col("size") < least).select("region")
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b])
    around = regions.join(small, "region", "left_semi").select(F.col("region").alias("me"), F.col("row").alias("_r"), F.col("col").alias("_c"), F.explode(steps).alias("s")).select("me", (F.col("_r") + F.col("s.a")).alias("row"), (F.col("_c") + F.col("s.b")).alias("col"))
    pairs = around.join(regions, CELL).where("me <> region").select("me", "region", "cls").distinct().join(sizes, "region")
    new = pairs.groupBy("me").agg(F.max_by("cls", F.struct("size", -F.col("region"))).alias("new"))
    return regions.join(new.withColumnRenamed("me", "region"), "region", "left").select(*CELL, F.coalesce("new", "cls").alias("cls"))


def inland_split(change: DataFrame, river: DataFrame, touch: int = 2) -> DataFrame:
    """Losses (1, 5) of regions that don't come within ``touch`` cells of the river become 6; without a river nothing changes."""
    from fluvia.operators.focal import dilate

    loss = change.where("cls in (1, 5)")
    regions = components(loss.select(*CELL)).select(*CELL, "region")
    touching = regions.join(dilate(river, touch, cross=False), CELL, "left_semi").select("region").distinct()
    away = regions.join(touching, "region", "left_anti").select(*CELL, F.lit(6).alias("six"))
    some = river.limit(1).agg((F.count(F.lit(1)) > 0).alias("some"))
    out = change.join(away, CELL, "left").crossJoin(F.broadcast(some))
    return out.select(*CELL, F.when(F.col("some") & F.col("six").isNotNull(), 6).otherwise(F.col("cls")).alias("cls"))


def _across(lo: int, hi: int):
    """(row, col, gap): of a row with targets, the cells to its nearest one from each column from lo to hi."""

    def run(table: pa.Table) -> pa.Table:
        on, at = np.unique(np.asarray(table["tc"]).astype(np.int64)), np.arange(lo, hi + 1)
        k = np.searchsorted(on, at)
        gap = np.minimum(np.abs(at - on[np.maximum(k - 1, 0)]), np.abs(on[np.minimum(k, len(on) - 1)] - at))
        return pa.table({"tr": pa.array(np.full(len(at), table["tr"][0].as_py()), pa.int64()), "col": pa.array(at, pa.int64()), "gap": pa.array(gap, pa.int64())})

    return run


def _down(left: pa.Table, right: pa.Table) -> pa.Table:
    """Adds d2 to the cells of a column: the lower envelope of the parabolas gap**2 + (row - tr)**2. All numbers are whole, so it is exact."""
    if not right.num_rows:
        return pa.table({**{k: left[k] for k in CELL}, "d2": pa.nulls(left.num_rows, pa.int64())})
    tr, gap = np.asarray(right["tr"]), np.asarray(right["gap"])
    order = np.argsort(tr)
    tr, gap = tr[order].tolist(), gap[order].tolist()
    base, start = [], []  # parabolas of the envelope, and from where each is the least
    for k, (r, g) in enumerate(zip(tr, gap, strict=True)):
        at = -math.inf
        while base:
            q = base[-1]
            at = (g * g + r * r - gap[q] ** 2 - tr[q] ** 2) / (2 * (r - tr[q]))
            if at > start[-1]:
                break
            base.pop()
            start.pop()
            at = -math.inf
        base.append(k)
        start.append(at)
    row = np.asarray(left["row"]).astype(np.int64)
    k = np.array(base)[np.searchsorted(np.array(start), row, side="right") - 1]
    d2 = np.array(gap)[k] ** 2 + (row - np.array(tr)[k]) ** 2
    return pa.table({**{k: left[k] for k in CELL}, "d2": pa.array(d2, pa.int64())})


def distance_to(cells: DataFrame, targets: DataFrame, res: float, reach: int | None = None) -> DataFrame:
    """(row, col, distance) to the nearest target, exact; NULL only where there is none at all.

    The nearest target of each row first, then the least over the rows of a
    column: a task holds one row or one column of the grid. With ``reach`` the
    distance is NULL beyond so many cells, and buckets of that width keep it an
    equi-join.
    """
    t = targets.select(F.col("row").alias("tr"), F.col("col").alias("tc"))
    if reach is None:
        own = cells.select(*CELL)
        lo, hi = own.agg(F.min("col"), F.max("col")).first()
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema)
        across = t.where("tr is not null and tc is not null").groupBy("tr").applyInArrow(_across(lo or 0, -1 if hi is None else hi), "tr long, col long, gap long")
        near = own.groupBy("col").cogroup(across.groupBy("col")).applyInArrow(_down, f"{kinds}, d2 long")
        return near.select(*CELL, (F.sqrt(F.col("d2")) * res).alias("distance"))
    b = reach
    t = t.withColumn("br", F.floor(F.col("tr") / b)).withColumn("bc", F.floor(F.col("tc") / b))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    c = cells.select(*CELL, F.explode(steps).alias("s")).withColumn("br", F.floor(F.col("row") / b) + F.col("s.i")).withColumn("bc", F.floor(F.col("col") / b) + F.col("s.j"))
    d2 = (F.col("row") - F.col("tr")) * (F.col("row") - F.col("tr")) + (F.col("col") - F.col("tc")) * (F.col("col") - F.col("tc"))
    near = c.join(t, ["br", "bc"]).groupBy(*CELL).agg(F.min(d2).alias("d2")).where(F.col("d2") <= reach * reach)
    return cells.select(*CELL).join(near, CELL, "left").select(*CELL, (F.sqrt(F.col("d2")) * res).alias("distance"))


def zonal(regions: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Pixels, sum, mean and greatest of a value in each region; missing values don't count."""
    return regions.join(values.select(*CELL, value), CELL, "left").groupBy("region").agg(F.count(F.lit(1)).alias("pixels"), F.sum(value).alias("sum"), F.avg(value).alias("mean"), F.max(value).alias("most"))


def majority(regions: DataFrame, cells: DataFrame, cls: str) -> DataFrame:
    """The most frequent class of each region; ties go to the smaller code."""
    n = regions.join(cells.select(*CELL, F.col(cls).alias("code")), CELL).groupBy("region", "code").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("region").agg(F.max_by("code", F.struct("n", -F.col("code"))).alias("code"))
