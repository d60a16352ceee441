"""Neighbourhood operators. Rows are windows over a row's or a column's cells, never over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["row", "col"]


def odd_size(metres: float, res: float) -> int:
    """A window's width in cells, made odd."""
    return round(metres / res) | 1


def _along(value: Column, line: str, axis: str, r: int, n: int) -> tuple[Column, Column, Column]:
    """A line's running sum, its whole sum, and what its repeated edge adds to a box of r cells each way."""
    w = Window.partitionBy(line).orderBy(axis)
    upto = F.sum(F.coalesce(value, F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.first(value).over(every), F.last(value).over(every)
    before, after = F.greatest(F.lit(r) - F.col(axis), F.lit(0)), F.greatest(F.col(axis) + r - (n - 1), F.lit(0))
    return upto, F.sum(F.coalesce(value, F.lit(0.0))).over(every), before * first + after * last


def _box(cells: DataFrame, value: str, line: str, axis: str, size: int, n: int, out: str) -> DataFrame:
    """Sums over a box are differences of a line's running sums, whatever the size of the box; the line's cells follow each other without gaps."""
    r = size // 2
    w = Window.partitionBy(line).orderBy(axis)
    upto, whole, edge = _along(F.col(value), line, axis, r, n)
    x = cells.withColumn("_u", upto).withColumn("_w", whole).withColumn("_e", edge)
    inside = F.coalesce(F.lead("_u", r).over(w), F.col("_w")) - F.coalesce(F.lag("_u", r + 1).over(w), F.lit(0.0))
    return x.withColumn(out, inside + F.col("_e")).drop("_u", "_w", "_e")


def box_sum(cells: DataFrame, value: str, size: int, n_rows: int, n_cols: int, out: str) -> DataFrame:
    """Sum over a size x size box of a full grid, its edge repeated outwards."""
    across = _box(cells, value, "row", "col", size, n_cols, "_across")
    return _box(across, "_across", "col", "row", size, n_rows, out).drop("_across")


def box_mean(cells: DataFrame, value: str, size: int, n_rows: int, n_cols: int, out: str = "box_mean") -> DataFrame:
    return box_sum(cells, value, size, n_rows, n_cols, out).withColumn(out, F.col(out) / float(size * size))


def known_box_mean(cells: DataFrame, value: str, size: int, n_rows: int, n_cols: int, out: str = "box_mean", keep_missing: bool = True) -> DataFrame:
    """Mean of the values that there are; keep_missing: a cell without a value gets none."""
    x = cells.withColumn("_v", F.coalesce(F.col(value), F.lit(0.0))).withColumn("_n", F.col(value).isNotNull().cast("double"))
    x = box_sum(box_sum(x, "_v", size, n_rows, n_cols, "_sv"), "_n", size, n_rows, n_cols, "_sn")
    mean = F.when(F.col("_sn") > 0.5, F.col("_sv") / F.col("_sn"))
    return x.withColumn(out, F.when(F.col(value).isNotNull(), mean) if keep_missing else mean).drop("_v", "_n", "_sv", "_sn")


def box_min(cells: DataFrame, value: str, size: int, out: str = "box_min") -> DataFrame:
    r = size // 2
    least = lambda c, line, axis: F.min(c).over(Window.partitionBy(line).orderBy(axis).rangeBetween(-r, r))
    return cells.withColumn("_across", least(value, "row", "col")).withColumn(out, least("_across", "col", "row")).drop("_across")


def slope(cells: DataFrame, value: str, res: float, out: str = "slope") -> DataFrame:
    """Degrees, from central differences inside and one-sided ones at the edge."""

    def gradient(line: str, axis: str) -> Column:
        w = Window.partitionBy(line).orderBy(axis)
        low, high = F.lag(value).over(w), F.lead(value).over(w)
        here = F.col(value)
        return F.when(low.isNull(), (high - here) / res).when(high.isNull(), (here - low) / res).otherwise((high - low) / (2 * res))

    return cells.withColumn("_gx", gradient("row", "col")).withColumn("_gy", gradient("col", "row")).withColumn(out, F.degrees(F.atan(F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy"))))).drop("_gx", "_gy")


def offsets(k: int, cross: bool) -> list[tuple[int, int]]:
    """Steps reached by k dilations with a cross or a square."""
    return [(a, b) for a in range(-k, k + 1) for b in range(-k, k + 1) if not cross or abs(a) + abs(b) <= k]


def _runs(mask: DataFrame) -> DataFrame:
    """(row, low, high): the runs of a mask's cells in each row."""
    w = Window.partitionBy("row").orderBy("col")
    x = mask.select("row", "col").distinct().withColumn("_g", F.col("col") - F.row_number().over(w))
    return x.groupBy("row", "_g").agg(F.min("col").alias("low"), F.max("col").alias("high")).drop("_g")


def _spread(mask: DataFrame, k: int, cross: bool, grow: int) -> DataFrame:
    """Each run in each of the 2 k + 1 rows around it, longer (grow 1) or shorter (-1) at both ends by the steps left."""
    steps = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(grow * (k - abs(d) if cross else k)).alias("by")) for d in range(-k, k + 1)])
    s = _runs(mask).withColumn("s", F.explode(steps))
    return s.select((F.col("row") + F.col("s.d")).alias("row"), (F.col("low") - F.col("s.by")).alias("low"), (F.col("high") + F.col("s.by")).alias("high")).where("low <= high")


def dilate(mask: DataFrame, k: int, cross: bool = True) -> DataFrame:
    """Cells (row, col) within k steps of mask's cells: the union of spread runs of each row."""
    w = Window.partitionBy("row").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    x = _spread(mask, k, cross, 1).withColumn("_b", F.max("high").over(w))
    fresh = x.withColumn("low", F.greatest("low", F.coalesce(F.col("_b") + 1, F.col("low")))).where("low <= high")
    return fresh.select("row", F.explode(F.sequence("low", "high")).alias("col"))


def erode(mask: DataFrame, k: int, cross: bool = True) -> DataFrame:
    """Cells whose whole neighbourhood is mask; what lies outside the grid is not. A cell is left if it is in a shortened run of all 2 k + 1 rows around it."""
    x = _spread(mask, k, cross, -1).select("row", F.explode(F.sequence("low", "high")).alias("col"))
    return x.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 2 * k + 1).select("row", "col")
