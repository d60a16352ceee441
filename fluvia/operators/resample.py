"""Between grids: a grid is its corner (x0, y0), its cell size, and rows that go down."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = ["row", "col"]


@dataclass(frozen=True)
class Grid:
    x0: float
    y0: float
    res: float

    def x(self, col: Column) -> Column:
        return self.x0 + (col + 0.5) * self.res

    def y(self, row: Column) -> Column:
        return self.y0 - (row + 0.5) * self.res

    def place(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column as numbers with fractions; whole at cell corners."""
        return (self.y0 - y) / self.res, (x - self.x0) / self.res

    def at(self, x: Column, y: Column) -> tuple[Column, Column]:
        r, c = self.place(x, y)
        return F.floor(r), F.floor(c)


def nearest(cells: DataFrame, own: Grid, layer: DataFrame, grid: Grid, value: str, missing: float | None = None) -> DataFrame:
    """cells with the value of the layer's cell that each centre lies in."""
    r, c = grid.at(own.x(F.col("col")), own.y(F.col("row")))
    found = layer.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias("_v"))
    return cells.withColumn("_r", r).withColumn("_c", c).join(found, ["_r", "_c"], "left").withColumn(value, F.coalesce("_v", F.lit(missing)) if missing is not None else F.col("_v")).drop("_r", "_c", "_v")


def bilinear(cells: DataFrame, own: Grid, layer: DataFrame, grid: Grid, value: str) -> DataFrame:
    """cells with the layer's value between the four cell centres around each; where some are missing, the rest by weight."""
    r, c = grid.place(own.x(F.col("col")), own.y(F.col("row")))
    x = cells.withColumn("_fr", r - 0.5).withColumn("_fc", c - 0.5).withColumn("_id", F.struct(*CELL))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    corner = x.select("_id", "_fr", "_fc", F.explode(steps).alias("s")).withColumn("_r", F.floor("_fr") + F.col("s.i")).withColumn("_c", F.floor("_fc") + F.col("s.j"))
    w = (1 - F.abs(F.col("_fr") - F.col("_r"))) * (1 - F.abs(F.col("_fc") - F.col("_c")))
    found = layer.where(F.col(value).isNotNull()).select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias("_v"))
    got = corner.join(found, ["_r", "_c"]).withColumn("_w", w).where("_w > 0").groupBy("_id").agg((F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")).alias(value))
    return cells.join(got.select("_id.*", value), CELL, "left")


def raster_on(cells: DataFrame, own: Grid, layer: DataFrame | None, grid: Grid, value: str, constant: float) -> DataFrame:
    """Bilinear; gaps take the layer's mean, or the constant without a layer or any value."""
    if layer is None:
        return cells.withColumn(value, F.lit(float(constant)))
    mean = layer.agg(F.avg(value).alias("_mean"))
    return bilinear(cells, own, layer, grid, value).crossJoin(F.broadcast(mean)).withColumn(value, F.coalesce(value, "_mean", F.lit(float(constant)))).drop("_mean")  # one row


def coarser(cells: DataFrame, own: Grid, grid: Grid, value: str, how: str = "max") -> DataFrame:
    """(row, col, value) on a coarser grid: greatest or mean value of the cells whose centres lie in each."""
    r, c = grid.at(own.x(F.col("col")), own.y(F.col("row")))
    return cells.groupBy(r.alias("row"), c.alias("col")).agg({"max": F.max, "average": F.avg}[how](value).alias(value))


def value_at(points: DataFrame, cells: DataFrame, grid: Grid, value: str, x: str = "x", y: str = "y") -> DataFrame:
    """points with the value of the cell that each lies in, 0 outside."""
    r, c = grid.at(F.col(x), F.col(y))
    found = cells.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias("_v"))
    return points.withColumn("_r", r).withColumn("_c", c).join(found, ["_r", "_c"], "left").withColumn(value, F.coalesce("_v", F.lit(0))).drop("_r", "_c", "_v")


def cell_points(cells: DataFrame, grid: Grid, value: str, projected: bool = True) -> DataFrame:
    """(x, y, v, cell_ha) of cells above 0; the cell's area only where the grid is in metres."""
    ha = F.lit(grid.res * grid.res / 1e4) if projected else F.lit(None).cast("double")
    return cells.where(F.col(value) > 0).select(grid.x(F.col("col")).alias("x"), grid.y(F.col("row")).alias("y"), F.col(value).alias("v"), ha.alias("cell_ha"))


def class_share(cells: DataFrame, code: str, cls: int, n_rows: int, n_cols: int, k: int = 10) -> DataFrame:
    """(row, col, share) of a class in k x k blocks; ragged blocks at the edge are left out."""
    whole = cells.where((F.col("row") < n_rows // k * k) & (F.col("col") < n_cols // k * k))
    return whole.groupBy(F.expr(f"row div {k}").alias("row"), F.expr(f"col div {k}").alias("col")).agg(F.avg((F.col(code) == cls).cast("double")).alias("share"))


def window(cells: DataFrame, grid: Grid, value: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Cells whose centre is in a box (west, south, east, north); values under 0 are 0."""
    x, y = grid.x(F.col("col")), grid.y(F.col("row"))
    return cells.where(x.between(box[0], box[2]) & y.between(box[1], box[3])).withColumn(value, F.greatest(F.col(value), F.lit(0.0)))


def code_areas(cells: DataFrame, code: str, cell_ha: float) -> DataFrame:
    return cells.groupBy(F.col(code).alias("code")).agg(F.count(F.lit(1)).alias("pixels"), (F.count(F.lit(1)) * cell_ha).alias("ha"))


def yearly_mean(years: DataFrame, value: str, missing: float = -9000.0) -> DataFrame:
    """(row, col, value): the mean over years; values at or below ``missing`` are none."""
    return years.groupBy(*CELL).agg(F.avg(F.when(F.col(value) > missing, F.col(value))).alias(value))
