"""Queries over the grid: patches, water maps, resampling, features, comparison with labels."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvia.functions import soil, spectral
from fluvia.operators import composite, external, focal, lines, ml, patches, regions, resample, stats, watermap
from fluvia.plans.grid import CHANGE, EDGES, FREQ, OBS, PERIODS, PIXELS, REACH, WATER, observations, periods, pixels, shape
from fluvia.plans.maps import PIXEL_HA, change, code_table, freq, water
from fluvia.plans.maps import CODES as LABELS

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add




def comps(source: str, p: str) -> str:
    """CTEs that end in {p}pr("row", col, cls, region): regions of cells of one class above 0."""
    return f"""{p}ce AS (SELECT a."row" * 2147483648 + a.col AS a, b."row" * 2147483648 + b.col AS b FROM {source} a JOIN {source} b ON abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1 AND a.cls = b.cls WHERE a.cls > 0),
{p}tp(id, lab) AS (SELECT "row" * 2147483648 + col, "row" * 2147483648 + col FROM {source} WHERE cls > 0 UNION SELECT {p}ce.b, {p}tp.lab FROM {p}tp JOIN {p}ce ON {p}tp.id = {p}ce.a),
{p}pr AS (SELECT "row", col, cls, min(lab) AS region FROM {p}tp JOIN {source} ON "row" * 2147483648 + col = id GROUP BY ALL)"""


def sieved(source: str, least: int, p: str) -> str:
    """CTEs that end in {p}sv("row", col, cls): classes from 0 on after the sieve."""
    return f"""{p}up AS (SELECT "row", col, cls + 1 AS cls FROM {source}), {comps(f"{p}up", f"{p}u")}, {p}sz AS (SELECT region, any_value(cls) AS cls, count(*) AS size FROM {p}upr GROUP BY region),
{p}nb AS (SELECT DISTINCT a.region AS me, b.region FROM {p}upr a JOIN {p}upr b ON abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1 AND a.region <> b.region),
{p}mv AS (SELECT me, arg_max(s.cls, s.size * 100000000000000 - s.region) AS cls FROM {p}nb JOIN {p}sz m ON m.region = me AND m.size < {least} JOIN {p}sz s ON s.region = {p}nb.region GROUP BY me),
{p}sv AS (SELECT r."row", r.col, coalesce({p}mv.cls, r.cls) - 1 AS cls FROM {p}upr r LEFT JOIN {p}mv ON {p}mv.me = r.region)"""


def diamond(k: int, name: str = "dm") -> str:
    return f"{name} AS (SELECT a.x AS dr, b.x AS dc FROM (SELECT unnest(range({-k}, {k + 1})) AS x) a, (SELECT unnest(range({-k}, {k + 1})) AS x) b WHERE abs(a.x) + abs(b.x) <= {k})"


def edge_threshold(source: str, first: float, least: int, low: float, high: float, band: int = 3) -> str:
    """CTEs that end in eo(threshold), for values v of source."""
    n = 2 * band * (band + 1) + 1
    return f"""{diamond(band, "ed3")}, mk AS (SELECT "row", col FROM {source} WHERE v > {first}), di AS (SELECT DISTINCT "row" + dr AS "row", col + dc AS col FROM mk, ed3), er AS (SELECT "row" + dr AS "row", col + dc AS col FROM mk, ed3 GROUP BY ALL HAVING count(*) = {n}),
zn AS (SELECT v FROM {source} x WHERE v IS NOT NULL AND EXISTS (SELECT 1 FROM di WHERE di."row" = x."row" AND di.col = x.col) AND NOT EXISTS (SELECT 1 FROM er WHERE er."row" = x."row" AND er.col = x.col)),
pc AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi, count(*) AS cells FROM zn), hd AS (SELECT least(greatest(v, lo), hi) AS v, lo, hi FROM zn, pc),
hh AS (SELECT least(floor((v - lo) / (hi - lo) * 256), 255)::INT AS bin, count(*) AS n FROM hd GROUP BY ALL), gg AS (SELECT b.bin, lo, hi, coalesce(n, 0)::DOUBLE AS n, lo + (b.bin + 0.5) * (hi - lo) / 256 AS c FROM (SELECT unnest(range(256)) AS bin) b CROSS JOIN pc LEFT JOIN hh ON hh.bin = b.bin),
ww AS (SELECT *, sum(n) OVER o AS w0, sum(n * c) OVER o AS s0, sum(n) OVER () AS wt, sum(n * c) OVER () AS st FROM gg WINDOW o AS (ORDER BY bin)), vv AS (SELECT *, w0 * (wt - w0) * pow(s0 / greatest(w0, 1) - (st - s0) / greatest(wt - w0, 1), 2) AS b FROM ww WHERE bin < 255),
eo AS (SELECT CASE WHEN (SELECT cells FROM pc) < {least} THEN {first} ELSE least(greatest(any_value(lo) + (round_even(avg(bin), 0) + 0.5) * (any_value(hi) - any_value(lo)) / 256, {low}), {high}) END AS threshold FROM vv WHERE b >= (SELECT max(b) FROM vv) * (1 - 1e-6))"""


@query(f"""WITH RECURSIVE {OBS}, {PERIODS}, {CHANGE}, {PIXELS}, {comps("ch", "k")} SELECT region::BIGINT AS region, any_value(cls)::INT AS cls, count(*) AS pixels, round((count(*) * 0.04)::DOUBLE, 6) AS area_ha, round(1000 + (avg(r.col) + 0.5) * 20, 6) AS x, round(5000 - (avg(r."row") + 0.5) * 20, 6) AS y, round(avg(z), 6) AS mean_z, max(s) AS most_s
FROM kpr r JOIN px ON px."row" = r."row" AND px.col = r.col GROUP BY region""")
def patch_table(spark, d):
    cells = change(spark, d).join(pixels(spark, d), ["row", "col"])
    p = patches.polygons(cells, 20.0, 1, 1000.0, 5000.0, {"mean_z": "z"}, {"most_s": "s"})
    return p.select("region", "cls", "pixels", *[F.round(c, 6).alias(c) for c in ("area_ha", "x", "y", "mean_z")], "most_s")


@query(f"""WITH RECURSIVE {OBS}, {PERIODS}, {CHANGE}, kd AS (SELECT "row", col, CASE WHEN cls = 5 THEN 1 ELSE cls END AS cls FROM ch), {comps("kd", "k")},
a AS (SELECT region, any_value(r.cls) AS kind, count(*) AS pixels, count(*) FILTER (ch.cls = 5) AS n5, abs(sum(mb - ma)) * 0.04 AS lost FROM kpr r JOIN ch ON ch."row" = r."row" AND ch.col = r.col JOIN pf ON pf."row" = r."row" AND pf.col = r.col GROUP BY region)
SELECT region::BIGINT AS region, (CASE WHEN kind = 1 AND n5 > pixels / 2 THEN 5 ELSE kind END)::INT AS cls, pixels, round(lost::DOUBLE, 6) AS lost_ha, round((pixels * 0.04)::DOUBLE, 6) AS footprint_ha, round((lost / (pixels * 0.04))::DOUBLE, 6) AS mean_change FROM a""")
def class_patches(spark, d):
    """Their joint p and confidence have no SQL; tests hold them."""
    p = periods(spark, d).select("row", "col", (F.col("mb") - F.col("ma")).alias("d"))
    cells = change(spark, d).join(p, ["row", "col"]).withColumn("p_up", F.lit(0.5))
    return patches.tested_patches(cells, PIXEL_HA).select("region", "cls", "pixels", *[F.round(c, 6).alias(c) for c in ("lost_ha", "footprint_ha", "mean_change")])


@query(f"""WITH RECURSIVE {OBS}, {PERIODS}, {CHANGE}, bm AS (SELECT "row", col, (cls IN (1, 5))::INT AS cls FROM ch), {sieved("bm", 5, "s")}, {comps("ssv", "k")}
SELECT region::BIGINT AS region, count(*) AS pixels, round((count(*) * 0.04)::DOUBLE, 6) AS area_ha FROM kpr GROUP BY region""")
def binary_patches(spark, d):
    return patches.binary_patches(change(spark, d), (1, 5), 5, PIXEL_HA).withColumn("area_ha", F.round("area_ha", 6))


@query(f"""WITH {OBS}, {PERIODS}, {CHANGE}, codes(code, label) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in LABELS.items())}), a AS (SELECT cls, sum(abs(mb - ma)) * 0.04 AS ha FROM ch JOIN pf USING ("row", col) GROUP BY cls)
SELECT code, label, round(coalesce(ha, 0)::DOUBLE, 6) AS ha FROM codes LEFT JOIN a ON cls = code""")
def changed_area(spark, d):
    p = periods(spark, d).select("row", "col", (F.col("mb") - F.col("ma")).alias("d"))
    return patches.changed_area(change(spark, d).join(p, ["row", "col"]), code_table(spark), PIXEL_HA).withColumn("ha", F.round("ha", 6))


@query(f"""WITH RECURSIVE {OBS}, {PERIODS}, lm AS (SELECT "row", col, coalesce(na >= 2 AND nb >= 2 AND ka / nullif(na, 0) < 0.5 AND kb / nullif(nb, 0) >= 0.5, false)::INT AS cls FROM pf), gm AS (SELECT "row", col, coalesce(na >= 2 AND nb >= 2 AND ka / nullif(na, 0) >= 0.5 AND kb / nullif(nb, 0) < 0.5, false)::INT AS cls FROM pf),
{sieved("lm", 3, "l")}, {sieved("gm", 3, "g")} SELECT a."row"::INT AS "row", a.col::INT AS col, a.cls = 1 AS loss, b.cls = 1 AS gain FROM lsv a JOIN gsv b ON a."row" = b."row" AND a.col = b.col""")
def frequency_change(spark, d):
    return watermap.frequency_change(periods(spark, d), 3)


_STATE = "ka / na >= 0.5 AS was, kb / nb >= 0.5 AS now"


@query(f"""WITH {OBS}, {PERIODS}, {CHANGE}, x AS (SELECT "row", col, {_STATE} FROM pf WHERE na >= 2 AND nb >= 2)
SELECT "row", col, (CASE WHEN col >= 45 THEN 0 WHEN cls IN (1, 2, 5, 6) THEN cls WHEN NOT was AND NOT now THEN 10 WHEN was AND now THEN 11 ELSE 0 END)::INT AS cls FROM x JOIN ch USING ("row", col)""")
def map_classes(spark, d):
    x = periods(spark, d).where("na >= 2 and nb >= 2").select("row", "col", (F.col("ka") / F.col("na") >= 0.5).alias("was"), (F.col("kb") / F.col("nb") >= 0.5).alias("now"))
    return x.join(change(spark, d), ["row", "col"]).select("row", "col", watermap.map_class(F.col("cls"), F.col("was"), F.col("now"), F.col("col") < 45).cast("int").alias("cls"))


@query(f"""WITH {PIXELS} SELECT "row", col, (CASE s % 11 WHEN 2 THEN 1 WHEN 5 THEN 2 WHEN 3 THEN 3 WHEN 6 THEN 4 ELSE 0 END)::INT AS history, s % 11 BETWEEN 1 AND 10 AS ever FROM px""")
def history_classes(spark, d):
    code = F.col("s") % 11
    return pixels(spark, d).select("row", "col", watermap.history_class(code).cast("int").alias("history"), watermap.ever_water(code).alias("ever"))


@query(f"""WITH {PIXELS}, src AS (SELECT "row", col, z AS v FROM px), {edge_threshold("src", 1000.0, 50, 900.0, 2000.0)} SELECT round(threshold, 6) AS threshold FROM eo""")
def edge_otsu(spark, d):
    t = watermap.threshold_of(pixels(spark, d).select("row", "col", F.col("z").alias("v")), "v", 1000.0, True, (900.0, 2000.0), 50)
    return spark.range(1).select(F.round(F.lit(t), 6).alias("threshold"))


_LEVELS = (1000.0, 1200.0, 1400.0)


@query(f"""WITH {OBS}, {PIXELS}, src AS (SELECT "row", col, CASE WHEN s % 9 <> 0 THEN z END AS v FROM px), {edge_threshold("src", 1000.0, 50, 900.0, 2000.0)},
u AS (SELECT threshold AS t, CASE WHEN abs(1000.0 - threshold) <= least(abs(1200.0 - threshold), abs(1400.0 - threshold)) THEN 0 WHEN abs(1200.0 - threshold) <= abs(1400.0 - threshold) THEN 1 ELSE 2 END AS level FROM eo),
c AS (SELECT "row", col, count(*) FILTER (clear) AS n, count(*) FILTER (clear AND v > 0.02) AS w0, count(*) FILTER (clear AND v > 0.05) AS w1, count(*) FILTER (clear AND v > 0.08) AS w2 FROM obs GROUP BY ALL),
m AS (SELECT src."row", src.col, v, t, CASE WHEN n >= 22 THEN n END AS n, CASE level WHEN 0 THEN w0 WHEN 1 THEN w1 ELSE w2 END AS k FROM src JOIN c USING ("row", col), u)
SELECT "row", col, coalesce(CASE WHEN n IS NOT NULL THEN k / n >= 0.5 ELSE v > t END, false) AS water, CASE WHEN n IS NOT NULL THEN 'optical' WHEN v IS NOT NULL THEN 'composite' END AS tier, round(CASE WHEN n IS NOT NULL THEN k / n END, 6) AS frequency FROM m""")
def water_map(spark, d):
    """The whole chain: threshold of the composite's edges, nearest stored level, tiers. Dates are many here, so a tier needs 22."""
    n = composite.threshold_counts(observations(spark, d), "v", (0.02, 0.05, 0.08), F.col("clear"))
    cells = pixels(spark, d).withColumn("index", F.when(F.col("s") % 9 != 0, F.col("z"))).join(n, ["row", "col"])
    out, _ = watermap.water_map(cells, _LEVELS, dates=22, least=50, index_guess=1000.0, index_bounds=(900.0, 2000.0))
    return out.select("row", "col", "water", "tier", F.round("frequency", 6).alias("frequency"))


@query(f"""WITH {OBS}, {PIXELS}, c AS (SELECT "row", col, count(*) FILTER (clear) AS n, count(*) FILTER (clear AND v > 0.05) AS k FROM obs GROUP BY ALL) SELECT c."row", c.col, round(CASE WHEN n >= 22 THEN k / n ELSE (z > 1200)::INT END, 6) AS frequency, CASE WHEN n >= 22 THEN k / n ELSE (z > 1200)::INT END >= 0.5 AS water FROM c JOIN px ON px."row" = c."row" AND px.col = c.col""")
def frequency_state(spark, d):
    x = freq(spark, d).join(pixels(spark, d), ["row", "col"])
    s = watermap.frequency_state(F.col("k"), F.col("n"), F.col("z"), 1200.0, dates=22)
    return x.select("row", "col", F.round(s["frequency"], 6).alias("frequency"), s["water"].alias("water"))


_BIG = "rv AS (SELECT \"row\", col FROM rg WHERE region IN (SELECT region FROM rg GROUP BY region HAVING count(*) >= {0}))"


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH}, {PIXELS}, {_BIG.format(10)}, m AS (SELECT px."row", px.col, min((px."row" - rv."row") ** 2 + (px.col - rv.col) ** 2) AS d2 FROM px, rv GROUP BY ALL) SELECT "row", col FROM m WHERE sqrt(d2) * 20 <= 60 AND col < 45""")
def river_corridor(spark, d):
    return watermap.corridor(water(spark, d), pixels(spark, d), 20.0, 10, 60.0, F.col("col") < 45).select("row", "col")


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH}, {PIXELS}, {_BIG.format(10)} SELECT px."row", px.col FROM px WHERE EXISTS (SELECT 1 FROM rv WHERE rv."row" // 8 = px."row" // 8 AND rv.col // 8 = px.col // 8)""")
def pruned_blocks(spark, d):
    return watermap.pruned(pixels(spark, d), regions.large_regions(water(spark, d), 10), 8).select("row", "col")


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {PERIODS}, {WATER}, {EDGES}, {REACH}, {_BIG.format(40)}, ch AS (SELECT "row", col, CASE WHEN col >= 45 THEN 0 WHEN ka / na < 0.5 AND kb / nb >= 0.5 THEN (CASE WHEN ("row" + col) % 7 = 0 THEN 5 ELSE 1 END) WHEN ka / na >= 0.5 AND kb / nb < 0.5 THEN 2 ELSE 0 END AS cls FROM pf WHERE na >= 2 AND nb >= 2),
ls AS (SELECT "row", col, 1 AS cls FROM ch WHERE cls IN (1, 5)), {comps("ls", "k")}, tc AS (SELECT DISTINCT region FROM kpr JOIN rv ON abs(kpr."row" - rv."row") <= 1 AND abs(kpr.col - rv.col) <= 1)
SELECT ch."row", ch.col, (CASE WHEN (SELECT count(*) FROM rv) > 0 AND ch.cls IN (1, 5) AND region NOT IN (SELECT region FROM tc) THEN 6 ELSE ch.cls END)::INT AS cls FROM ch LEFT JOIN kpr ON kpr."row" = ch."row" AND kpr.col = ch.col""")
def hires_change(spark, d):
    x = periods(spark, d).where("na >= 2 and nb >= 2")
    cells = x.select("row", "col", (F.col("ka") / F.col("na") >= 0.5).alias("was"), (F.col("kb") / F.col("nb") >= 0.5).alias("now"), F.when((F.col("row") + F.col("col")) % 7 == 0, 5).otherwise(0).alias("code"), (F.col("col") < 45).alias("inside"))
    return watermap.hires_change(cells, regions.large_regions(water(spark, d), 40), 1).select("row", "col", F.col("cls").cast("int").alias("cls"))


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH}, {PIXELS}, {_BIG.format(10)}, {diamond(5)}, eg AS (SELECT DISTINCT "row" + dr AS "row", col + dc AS col FROM rv, dm)
SELECT px."row", px.col, (CASE WHEN EXISTS (SELECT 1 FROM eg WHERE eg."row" = px."row" AND eg.col = px.col) AND NOT EXISTS (SELECT 1 FROM rv WHERE rv."row" = px."row" AND rv.col = px.col)
  THEN 1 + (s * 2.0 >= 15)::INT + (s * 2.0 >= 25)::INT + (s * 2.0 >= 40)::INT + (s * 2.0 >= 70)::INT ELSE 0 END)::INT AS cls FROM px""")
def detection_classes(spark, d):
    limits = pixels(spark, d).select("row", "col", (F.col("s") * 2.0).alias("limit"))
    return watermap.detection_classes(limits, regions.large_regions(water(spark, d), 10)).select("row", "col", "cls")


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {PIXELS}, b AS (SELECT "row", col FROM px WHERE s > 40), {diamond(2)}, da AS (SELECT DISTINCT "row" + dr AS "row", col + dc AS col FROM wt, dm), db AS (SELECT DISTINCT "row" + dr AS "row", col + dc AS col FROM b, dm)
SELECT round((SELECT count(*) FROM wt JOIN b USING ("row", col)) / (SELECT count(*) FROM (SELECT "row", col FROM wt UNION SELECT "row", col FROM b)), 3) AS iou, round((SELECT count(*) FROM wt JOIN db USING ("row", col)) / (SELECT count(*) FROM wt), 3) AS first_near_second, round((SELECT count(*) FROM b JOIN da USING ("row", col)) / (SELECT count(*) FROM b), 3) AS second_near_first""")
def map_agreement(spark, d):
    return patches.agreement(water(spark, d), pixels(spark, d).where("s > 40"))


OWN, OTHER, SPREAD = resample.Grid(0.0, 1000.0, 20.0), resample.Grid(-10.0, 1010.0, 50.0), resample.Grid(0.0, 20023.0, 400.0)
_AT = '"row", col, floor((1010.0 - (1000.0 - ("row" + 0.5) * 20.0)) / 50.0) AS lr, floor(((col + 0.5) * 20.0 + 10.0) / 50.0) AS lc'


@query(f"""WITH {PIXELS}, a AS (SELECT {_AT} FROM px) SELECT a."row", a.col, coalesce(px.z, -1) AS z FROM a LEFT JOIN px ON px."row" = lr AND px.col = lc""")
def resample_nearest(spark, d):
    x = pixels(spark, d)
    return resample.nearest(x.select("row", "col"), OWN, x, OTHER, "z", -1.0).select("row", "col", "z")


@query(f"""WITH {PIXELS}, ly AS (SELECT "row", col, z FROM px WHERE s % 9 <> 0), a AS (SELECT "row", col, (1010.0 - (1000.0 - ("row" + 0.5) * 20.0)) / 50.0 - 0.5 AS fr, ((col + 0.5) * 20.0 + 10.0) / 50.0 - 0.5 AS fc FROM px),
g AS (SELECT a."row", a.col, ly.z, (1 - abs(fr - ly."row")) * (1 - abs(fc - ly.col)) AS w FROM a JOIN ly ON abs(fr - ly."row") < 1 AND abs(fc - ly.col) < 1), m AS (SELECT "row", col, sum(z * w) / sum(w) AS z FROM g WHERE w > 0 GROUP BY ALL)
SELECT px."row", px.col, round(coalesce(m.z, (SELECT avg(z) FROM ly)), 6) AS z FROM px LEFT JOIN m ON m."row" = px."row" AND m.col = px.col""")
def raster_on(spark, d):
    """Bilinear, gaps filled with the layer's mean."""
    x = pixels(spark, d)
    return resample.raster_on(x.select("row", "col"), OWN, x.where("s % 9 <> 0"), OTHER, "z", 0.0).select("row", "col", F.round("z", 6).alias("z"))


@query(f"""WITH {PIXELS}, a AS (SELECT {_AT}, s, z FROM px) SELECT lr::BIGINT AS "row", lc::BIGINT AS col, max(s) AS most, round(avg(z), 6) AS mean FROM a GROUP BY lr, lc""")
def resample_coarser(spark, d):
    x = pixels(spark, d)
    most = resample.coarser(x, OWN, OTHER, "s", "max").withColumnRenamed("s", "most")
    return most.join(resample.coarser(x, OWN, OTHER, "z", "average").select("row", "col", F.round("z", 6).alias("mean")), ["row", "col"])


@query(f"""WITH {PIXELS}, pt AS (SELECT c_custkey AS pid, (c_custkey * 59 % 20011)::DOUBLE AS x, (c_custkey * 83 % 20023)::DOUBLE AS y FROM customer) SELECT pid, coalesce(s, 0) AS s FROM pt LEFT JOIN px ON px."row" = floor((20023.0 - y) / 400.0) AND px.col = floor(x / 400.0)""")
def value_at_points(spark, d):
    from fluvia.plans.tables import points

    return resample.value_at(points(spark, d).select("pid", F.col("px").alias("x"), F.col("py").alias("y")), pixels(spark, d), SPREAD, "s").select("pid", "s")


@query(f"""WITH {PIXELS} SELECT (col + 0.5) * 20.0 AS x, 1000.0 - ("row" + 0.5) * 20.0 AS y, s - 25 AS v, 0.04::DOUBLE AS cell_ha FROM px WHERE s > 25""")
def raster_points(spark, d):
    return resample.cell_points(pixels(spark, d).withColumn("s", F.col("s") - 25), OWN, "s")


@query(f"""WITH {PIXELS}, sh AS (SELECT max("row") + 1 AS nr, max(col) + 1 AS nc FROM px) SELECT ("row" // 3)::BIGINT AS "row", (col // 3)::BIGINT AS col, round(avg((s % 5 = 1)::INT), 6) AS share FROM px, sh WHERE "row" < nr // 3 * 3 AND col < nc // 3 * 3 GROUP BY ALL""")
def class_share(spark, d):
    x = pixels(spark, d).withColumn("k", F.col("s") % 5)
    return resample.class_share(x, "k", 1, *shape(x), k=3).withColumn("share", F.round("share", 6))


@query(f"""WITH {PIXELS}, w AS (SELECT *, greatest(z - 1200, 0) AS v FROM px WHERE (col + 0.5) * 20.0 BETWEEN 100 AND 700 AND 1000.0 - ("row" + 0.5) * 20.0 BETWEEN 300 AND 980) SELECT s % 11 AS code, count(*) AS pixels, round((count(*) * 0.09)::DOUBLE, 6) AS ha, round(sum(v), 4) AS total FROM w GROUP BY ALL""")
def window_areas(spark, d):
    w = resample.window(pixels(spark, d).withColumn("v", F.col("z") - 1200).withColumn("k", F.col("s") % 11), OWN, "v", (100.0, 300.0, 700.0, 980.0))
    areas = resample.code_areas(w, "k", 0.09)
    return areas.join(w.groupBy(F.col("k").alias("code")).agg(F.round(F.sum("v"), 4).alias("total")), "code").withColumn("ha", F.round("ha", 6))


@query(f"""WITH {OBS} SELECT "row", col, round(avg(q) FILTER (q > 10), 6) AS q FROM obs GROUP BY ALL""")
def yearly_mean(spark, d):
    return resample.yearly_mean(observations(spark, d), "q", 10.0).withColumn("q", F.round("q", 6))


@query(f"""WITH {OBS} SELECT "row", col, max(p) AS p, max(q) AS q FROM obs GROUP BY ALL""")
def tile_maximum(spark, d):
    return composite.highest(observations(spark, d), ["p", "q"])


@query(f"""WITH {OBS}, r AS (SELECT *, row_number() OVER (PARTITION BY "row", col, date ORDER BY st DESC, scl DESC, p DESC, q DESC) AS n FROM obs) SELECT "row", col, date, st, scl, p, q FROM r WHERE n = 1""")
def latest_processing(spark, d):
    return composite.latest_baseline(observations(spark, d).select("row", "col", "date", "scl", "p", "q", "st"), ["row", "col", "date"], "st").select("row", "col", "date", "st", "scl", "p", "q")


@query(f"""WITH {PIXELS}, sh AS (SELECT max(col) + 1 AS nc FROM px) SELECT "row", col, (("row" // 5) * (nc // 5 + 1) + col // 5 + 1)::BIGINT AS tile FROM px, sh""")
def tile_ids(spark, d):
    x = pixels(spark, d)
    return x.select("row", "col", ml.tile_of(20.0, 100.0, shape(x)[1]).cast("long").alias("tile"))


@query(f"""WITH {PIXELS} SELECT "row", col, round(10 * log10(z / 1000), 6) AS decibels FROM px""")
def decibels(spark, d):
    return pixels(spark, d).select("row", "col", F.round(spectral.decibels(F.col("z") / 1000), 6).alias("decibels"))


@query(f"""WITH {PIXELS}, a AS (SELECT "row", col, s, sin(radians(s / 2.0)) AS si, tan(radians(s / 2.0)) AS ta, (z % 100) / 100.0 AS nd, z FROM px), b AS (SELECT *, (si / 0.0896) / (3.0 * pow(si, 0.8) + 0.56) AS be, CASE WHEN ta < 0.09 THEN 10.8 * si + 0.03 ELSE 16.8 * si - 0.5 END AS st FROM a),
f AS (SELECT *, greatest(pow(20.0 / 22.13, be / (1 + be)) * st, 0.0) AS ls, least(greatest(exp(-2.0 * least(greatest(nd, -0.99), 0.99) / (1.0 - least(greatest(nd, -0.99), 0.99))), 0), 1) AS c, 79 + 0.363 * z AS r FROM b) SELECT "row", col, round(CASE WHEN s <= 45 THEN r * 0.025 * ls * c END, 5) AS loss FROM f""")
def soil_loss(spark, d):
    ls, c, r = soil.ls_factor(F.col("s") / 2.0, 20.0), soil.c_factor((F.col("z") % 100) / 100.0), soil.r_factor(F.col("z"))
    return pixels(spark, d).select("row", "col", F.round(soil.soil_loss(r, F.lit(0.025), ls, c, F.col("s") > 45), 5).alias("loss"))


def _around(r: int, name: str) -> str:
    return f"""{name} AS (SELECT p."row", p.col, n."row" AS nr, n.col AS nc, n.z, n.s FROM px p, sh, (SELECT unnest(range({-r}, {r + 1})) AS dr) a, (SELECT unnest(range({-r}, {r + 1})) AS dc) b JOIN px n ON n."row" = least(greatest(p."row" + dr, 0), mr) AND n.col = least(greatest(p.col + dc, 0), mc))"""


_SHAPE = 'sh AS (SELECT max("row") AS mr, max(col) AS mc FROM px)'


@query(f"""WITH {PIXELS}, {_SHAPE}, {_around(2, "a5")}, w AS (SELECT "row", col, min(z) AS low, avg((s % 11 IN (2, 5))::INT) AS past FROM a5 GROUP BY ALL), g AS (SELECT "row", col, z, s, lag(z) OVER r AS w, lead(z) OVER r AS e, lag(z) OVER c AS n, lead(z) OVER c AS so FROM px WINDOW r AS (PARTITION BY "row" ORDER BY col), c AS (PARTITION BY col ORDER BY "row")),
h AS (SELECT *, CASE WHEN w IS NULL THEN (e - z) / 200 WHEN e IS NULL THEN (z - w) / 200 ELSE (e - w) / 400 END AS gx, CASE WHEN n IS NULL THEN (so - z) / 200 WHEN so IS NULL THEN (z - n) / 200 ELSE (so - n) / 400 END AS gy FROM g)
SELECT h."row", h.col, round(z - low, 6) AS height_above_low_m, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) AS slope_deg, (s % 11 BETWEEN 1 AND 10)::INT::DOUBLE AS jrc_ever_water, round(past, 6) AS jrc_loss_frac_1km FROM h JOIN w ON w."row" = h."row" AND w.col = h.col""")
def static_features(spark, d):
    x = pixels(spark, d).withColumn("history", F.col("s") % 11)
    f = ml.static_features(x, *shape(x), 200.0, "z")
    return f.select("row", "col", F.round("height_above_low_m", 6).alias("height_above_low_m"), F.round("slope_deg", 6).alias("slope_deg"), "jrc_ever_water", F.round("jrc_loss_frac_1km", 6).alias("jrc_loss_frac_1km"))


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH}, {PIXELS}, {_SHAPE}, {_BIG.format(10)}, {_around(1, "a3")}, {_around(2, "a5")}, {_around(7, "a15")}, dd AS (SELECT px."row", px.col, min((px."row" - rv."row") ** 2 + (px.col - rv.col) ** 2) AS d2 FROM px, rv GROUP BY ALL),
r3 AS (SELECT a."row", a.col, count(rv.col) / count(*) AS f, avg(z) AS nz FROM a3 a LEFT JOIN rv ON rv."row" = nr AND rv.col = nc GROUP BY ALL), r5 AS (SELECT a."row", a.col, count(rv.col) / count(*) AS f FROM a5 a LEFT JOIN rv ON rv."row" = nr AND rv.col = nc GROUP BY ALL), r15 AS (SELECT a."row", a.col, count(rv.col) / count(*) AS f FROM a15 a LEFT JOIN rv ON rv."row" = nr AND rv.col = nc GROUP BY ALL)
SELECT px."row", px.col, round(coalesce(sqrt(d2) * 200, 100000), 6) AS dist_river_m, round(r3.f, 6) AS river_frac_300m, round(r5.f, 6) AS river_frac_1km, round(r15.f, 6) AS river_frac_3km, round(r3.nz, 6) AS ndvi_300m FROM px LEFT JOIN dd USING ("row", col) JOIN r3 USING ("row", col) JOIN r5 USING ("row", col) JOIN r15 USING ("row", col)""")
def period_features(spark, d):
    x = pixels(spark, d)
    f = ml.period_features(x, regions.written(regions.large_regions(water(spark, d), 10)), *shape(x), 200.0, "z")
    names = {"dist_river_m": "dist_river_m", "river_frac_0": "river_frac_300m", "river_frac_1": "river_frac_1km", "river_frac_2": "river_frac_3km", "z_near": "ndvi_300m"}
    return f.select("row", "col", *[F.round(k, 6).alias(v) for k, v in names.items()])


@query(f"""WITH {PIXELS} SELECT "row", col FROM px WHERE col < 45 AND s <= 40 AND abs("row" - 10) * 200.0 <= 3000 AND s % 9 <> 0""")
def learning_domain(spark, d):
    x = pixels(spark, d)
    return ml.domain(x, F.col("col") < 45, F.col("s") > 40, F.abs(F.col("row") - 10) * 200.0, F.when(F.col("s") % 9 != 0, F.col("z"))).select("row", "col")


def _gauss() -> str:
    r = int(4 * lines.SIGMA + 0.5)
    w = [math.exp(-0.5 * (k / lines.SIGMA) ** 2) for k in range(-r, r + 1)]
    rows = ", ".join(f"({k}, {x / sum(w)!r})" for k, x in zip(range(-r, r + 1), w, strict=True))
    fold = lambda x, n: f"CASE WHEN {x} < 0 THEN -1 - ({x}) WHEN {x} > {n} THEN 2 * {n} + 1 - ({x}) ELSE {x} END"
    return f"""WITH {PIXELS}, {_SHAPE}, k(o, w) AS (VALUES {rows}), n AS (SELECT p."row", p.col, a.w * b.w AS w, least(greatest({fold('p."row" + a.o', "mr")}, 0), mr) AS nr, least(greatest({fold("p.col + b.o", "mc")}, 0), mc) AS nc FROM px p, sh, k a, k b)
SELECT n."row", n.col, round(sum(w * px.s), 6) AS smooth FROM n JOIN px ON px."row" = nr AND px.col = nc GROUP BY ALL"""


@query(_gauss())
def gaussian_smooth(spark, d):
    return lines.gaussian(pixels(spark, d).withColumn("v", F.col("s").cast("double")), "v").select("row", "col", F.round("smooth", 6).alias("smooth"))


@query(f"""WITH {OBS} SELECT tile, count(*) FILTER (scl % 3 > 0) AS labelled, count(*) FILTER (scl % 3 = 1) AS water FROM obs GROUP BY tile HAVING labelled >= 50 AND water >= 0.01 * labelled AND labelled - water >= 0.01 * labelled""")
def usable_tiles(spark, d):
    return external.usable_tiles(observations(spark, d).withColumn("code", F.col("scl") % 3), least=50)


_MIXED = "m{0} AS (SELECT {1} AS support_m, t, r, c, avg(truth) AS truth, avg(soft) AS soft, avg(hard) AS hard FROM (SELECT \"row\" // 10 AS t, \"row\" // {0} AS r, col // {0} AS c, (CASE WHEN s % 13 <> 0 THEN (s > 25)::INT END) AS truth, z / 2000 AS soft, (s > 20)::INT AS hard FROM px) GROUP BY ALL HAVING count(truth) = {2})"


@query(f"""WITH {PIXELS}, {_MIXED.format(2, 20, 4)}, {_MIXED.format(3, 30, 9)}, u AS (SELECT * FROM m2 UNION ALL SELECT * FROM m3), f AS (SELECT * FROM u WHERE truth > 0 AND truth < 1)
SELECT support_m, count(*) AS mixed_blocks, count(DISTINCT t) AS tiles, round(sum(abs(soft - truth)) / count(*), 4) AS soft_mae, round(sum(abs(hard - truth)) / count(*), 4) AS hard_mae, round(100 * (sum(soft) - sum(truth)) / sum(truth), 1) AS soft_area_error_pct, round(100 * (sum(hard) - sum(truth)) / sum(truth), 1) AS hard_area_error_pct FROM f GROUP BY support_m""")
def support_errors(spark, d):
    x = pixels(spark, d).select("row", "col", F.expr("row div 10").alias("tile"), F.when(F.col("s") % 13 != 0, (F.col("s") > 25).cast("int")).alias("truth"), (F.col("z") / 2000).alias("soft"), (F.col("s") > 20).cast("int").alias("hard"))
    parts = [external.mixed_blocks(x, "truth", ["soft", "hard"], k, ["tile"]).withColumn("support_m", F.lit(10 * k)) for k in (2, 3)]
    return external.support_errors(parts[0].unionByName(parts[1]), ["soft", "hard"])


@query(f"""WITH {OBS}, c AS (SELECT tile, count(*) FILTER (clear AND v > 0.05) AS tp, count(*) FILTER (clear AND v <= 0.05) AS fp, count(*) FILTER (NOT clear AND v > 0.05) AS fn, count(*) FILTER (NOT clear AND v <= 0.05) AS tn FROM obs GROUP BY tile)
SELECT round(sum(tp + tn) / sum(tp + fp + fn + tn), 8) AS accuracy, round(2 * sum(tp) / sum(2 * tp + fp + fn), 8) AS f1, round(sum(tp) / sum(tp + fp + fn), 8) AS iou, sum(tp + fp + fn + tn)::BIGINT AS pixels FROM c""")
def pooled_scores(spark, d):
    from fluvia.operators.accuracy import confusion

    c = confusion(observations(spark, d).withColumn("wet", F.col("v") > 0.05), ["tile"], "clear", "wet")
    return external.pooled(c, ["tp", "fp", "fn", "tn"]).select(*[F.round(k, 8).alias(k) for k in ("accuracy", "f1", "iou")], "pixels")


@query(f"""WITH {OBS} SELECT count(*) AS observations, round(100 * count(*) FILTER (clear) / count(*), 4) AS clear_pct, round(avg(v) FILTER (clear), 6) AS mean_clear, round(avg((v >= 0.09)::INT), 6) AS share_high, max(q) AS most FROM obs""")
def scene_statistics(spark, d):
    o, c = observations(spark, d), F.col("clear")
    n = F.count(F.lit(1))
    return o.agg(n.alias("observations"), F.round(100 * F.count_if(c) / n, 4).alias("clear_pct"), F.round(F.avg(F.when(c, F.col("v"))), 6).alias("mean_clear"), F.round(F.avg((F.col("v") >= 0.09).cast("int")), 6).alias("share_high"), F.max("q").alias("most"))


def river_of(spark, d) -> DataFrame:
    return regions.large_regions(water(spark, d), 10)


@query()
def bank_line_table(spark, d):
    """Lines of the smoothed surface that follow the river's edge."""
    x = pixels(spark, d).withColumn("v", F.col("s") / 50.0)
    river = regions.written(focal.dilate(river_of(spark, d), 2))
    kept = regions.written(lines.bank_lines(x, "v", river, 20.0, least=40.0))
    return lines.line_lengths(kept, 20.0)


@query(f"""WITH {PIXELS} SELECT "row", col, coalesce(CASE WHEN s % 9 <> 0 THEN z > 1200 WHEN s % 2 = 0 THEN s / 50.0 < 0.5 END, false) AS water FROM px""")
def composite_water(spark, d):
    back = F.when(F.col("s") % 2 == 0, F.col("s") / 50.0)
    return pixels(spark, d).select("row", "col", composite.composite_water(F.when(F.col("s") % 9 != 0, F.col("z")), 1200.0, back, 0.5).alias("water"))


@query(f"""WITH {PIXELS} SELECT "row", col, round((least(greatest(z, 1000), 1800) - 1000) / 800, 6) AS plain, round((log10(least(greatest(s, 2), 40)) - log10(2)) / (log10(40) - log10(2)), 6) AS logged FROM px""")
def shown_values(spark, d):
    return pixels(spark, d).select("row", "col", F.round(composite.shown(F.col("z"), 1000, 1800), 6).alias("plain"), F.round(composite.shown(F.col("s").cast("double"), 2, 40, log=True), 6).alias("logged"))


@query(f"""WITH {PIXELS}, q AS (SELECT quantile_cont(z, 0.02) AS lo, quantile_cont(z, 0.98) AS hi FROM px) SELECT "row", col, round(least(greatest((z - lo) / (hi - lo), 0), 1), 6) AS shown FROM px, q""")
def stretched_band(spark, d):
    """A band stretched between its percentiles 2 and 98."""
    x = pixels(spark, d)
    low, high = stats.quantiles(x, "z", (0.02, 0.98))
    return x.select("row", "col", F.round(composite.shown(F.col("z"), low, high), 6).alias("shown"))


@query(f"""WITH {OBS}, {PERIODS}, {CHANGE}, {PIXELS} SELECT "row", col, round(CASE WHEN cls IN (1, 2, 5, 6) THEN (CASE WHEN col < 25 THEN z / 2000 ELSE s / 50.0 END) END, 6) AS confidence FROM ch JOIN px USING ("row", col)""")
def merged_confidence(spark, d):
    x = change(spark, d).join(pixels(spark, d), ["row", "col"])
    return x.select("row", "col", F.round(composite.merged_confidence(F.col("cls"), F.col("col") < 25, F.col("z") / 2000, F.col("s") / 50.0), 6).alias("confidence"))


@query(f"""WITH {OBS}, {PERIODS}, {CHANGE}, t AS (SELECT CASE WHEN cls IN (1, 5) THEN 'loss' WHEN cls = 2 THEN 'gain' WHEN cls > 0 THEN 'other' ELSE 'none' END AS kind, count(*) AS pixels FROM ch GROUP BY ALL) SELECT kind, pixels, round(100 * pixels / sum(pixels) OVER (), 4) AS share_pct FROM t""")
def change_shares(spark, d):
    c = F.col("cls")
    kind = F.when(c.isin(1, 5), "loss").when(c == 2, "gain").when(c > 0, "other").otherwise("none")
    n = change(spark, d).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("pixels"))
    total = n.agg(F.sum("pixels").alias("total"))
    return n.crossJoin(F.broadcast(total)).select("kind", "pixels", F.round(100 * F.col("pixels") / F.col("total"), 4).alias("share_pct"))  # one row
