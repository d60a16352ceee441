"""Queries over the grid: composites, water, change, neighbourhoods, regions, soil loss, tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvia.functions import soil, spectral
from fluvia.functions.special import label_confidence as confidence_of
from fluvia.operators import composite, focal, regions, stats, threshold
from fluvia.plans.grid import CHANGE, EDGES, FREQ, LEVELS, OBS, PERIODS, PIXELS, REACH, WATER, observations, periods, pixels, shape, table

#: Labels of change classes.
CODES = {1: "Bank erosion (land to water)", 2: "Accretion (water to land)", 3: "Vegetation loss", 4: "New bare soil", 5: "Char or sandbar lost", 6: "New inland water"}
PIXEL_HA = 0.04

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def freq(spark, d) -> DataFrame:
    return composite.threshold_counts(observations(spark, d), "v", [0.05], F.col("clear")).select("row", "col", "n", F.col("w_0").alias("k"))


def water(spark, d) -> DataFrame:
    return freq(spark, d).where((F.col("n") >= 2) & (F.col("k") / F.col("n") >= 0.5)).select("row", "col")


def change(spark, d) -> DataFrame:
    x = periods(spark, d).where((F.col("na") >= 2) & (F.col("nb") >= 2))
    was, now = F.col("ka") / F.col("na") >= 0.5, F.col("kb") / F.col("nb") >= 0.5
    cls = composite.change_class(was, now, (F.col("mb") - F.col("ma")) * 20, F.col("ta"), F.col("tb"), (F.col("row") + F.col("col")) % 7 == 0)
    return x.select("row", "col", cls.cast("int").alias("cls"))


def code_table(spark: SparkSession) -> DataFrame:
    m = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return spark.range(1, 7).select(F.col("id").cast("int").alias("code"), m[F.col("id").cast("int")].alias("label"))


@query(f"""WITH {OBS} SELECT "row", col, date, round(least(greatest((p + CASE WHEN st = 'O' THEN -1000 ELSE 0 END) / 10000.0, 0), 1), 6) AS refl FROM obs WHERE scl IN (4, 5, 6, 7) AND p > 0""")
def cloud_filtered_reflectance(spark, d):
    o = observations(spark, d)
    r = spectral.reflectance(F.col("p"), F.col("scl"), F.when(F.col("st") == "O", "04.00").otherwise("03.01"))
    return o.select("row", "col", "date", F.round(r, 6).alias("refl")).where("refl is not null")


@query(f"""WITH {OBS} SELECT "row", col, date, round((tax - v) / nullif(tax + v, 0), 6) AS ndvi, round((v - tax) / nullif(v + tax, 0), 6) AS mndwi, round(((tax + v) - (tax + q)) / nullif((tax + v) + (tax + q), 0), 6) AS bsi FROM obs""")
def normalized_difference_indices(spark, d):
    o = observations(spark, d)
    i = spectral.indices(F.col("q"), F.col("v"), F.col("v"), F.col("tax"), F.col("tax"))
    return o.select("row", "col", "date", *[F.round(c, 6).alias(k) for k, c in i.items()])


@query(f"""WITH {OBS}, r AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY tax, p, q, v, date, "row", col, scl) AS rn FROM obs)
SELECT tile, rn::INT AS rn, tax, p, q FROM r WHERE rn <= 15""")
def clearest_k_per_tile(spark, d):
    return composite.clearest(observations(spark, d), 15, "tile", "tax", ["p", "q", "v", "date", "row", "col", "scl"]).select("tile", "rn", "tax", "p", "q")


@query(f"""WITH {OBS} SELECT "row", col, date, min(p) AS p, min(q) AS q FROM obs GROUP BY ALL""")
def same_day_mosaic(spark, d):
    return composite.mosaic(observations(spark, d), ["p", "q"])


@query(f"""WITH {OBS} SELECT "row", col, median(p) AS p, median(q) AS q FROM obs WHERE clear GROUP BY ALL""")
def median_composite(spark, d):
    return composite.median_composite(observations(spark, d).where("clear"), ["p", "q"])


@query(f"""WITH {OBS} SELECT "row", col, count(*) FILTER (clear) AS n, {", ".join(f"count(*) FILTER (clear AND v > {t}) AS w_{i}" for i, t in enumerate(LEVELS))} FROM obs GROUP BY ALL""")
def threshold_counts(spark, d):
    return composite.threshold_counts(observations(spark, d), "v", LEVELS, F.col("clear"))


@query(f"""WITH {OBS}, {FREQ}, o AS (SELECT "row", col, count(*) FILTER (scl < 4) AS rn, count(*) FILTER (scl < 4 AND tax < 0.03) AS rk, median(v) AS m, median(tax) AS b FROM obs GROUP BY ALL)
SELECT "row", col, CASE WHEN n >= 20 THEN k / n >= 0.5 WHEN rn >= 10 THEN rk / rn >= 0.5 ELSE m > 0.05 END AS water, CASE WHEN n >= 20 THEN 'optical' WHEN rn >= 10 THEN 'radar' ELSE 'composite' END AS tier FROM fr JOIN o USING ("row", col)""")
def water_frequency_map(spark, d):
    o = observations(spark, d)
    low = F.col("scl") < 4
    x = o.groupBy("row", "col").agg(F.count_if("clear").alias("n"), F.count_if(F.col("clear") & (F.col("v") > 0.05)).alias("k"), F.count_if(low).alias("rn"), F.count_if(low & (F.col("tax") < 0.03)).alias("rk"), F.median("v").alias("m"))
    # the grid's counts are larger than a scene stack's, so tiers need 20 and 10 dates here
    optical, radar = F.when(F.col("n") >= 20, F.col("n")), F.when(F.col("rn") >= 10, F.col("rn"))
    s = composite.water_state(F.col("k"), optical, F.col("rk"), radar, F.col("m"), 0.05, F.lit(None).cast("double"), 0.0)
    return x.withColumn("s", s).select("row", "col", "s.water", "s.tier")


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, t AS (SELECT "row", col, n, k, (SELECT sum(exp(lgamma(n + 2) - lgamma(j + 1) - lgamma(n + 2 - j) + (n + 1) * ln(0.5))) FROM generate_series(k + 1, n + 1) g(j)) AS below FROM fr WHERE n > 0)
SELECT "row", col, n, k, round(CASE WHEN k / n >= 0.5 THEN 1 - below ELSE below END, 6) AS confidence FROM t""")
def label_confidence(spark, d):
    return freq(spark, d).select("row", "col", "n", "k", F.round(confidence_of(F.col("k"), F.col("n")), 6).alias("confidence")).where("confidence is not null")


@query(f"""WITH {OBS}, {PERIODS}, {CHANGE} SELECT "row", col, cls::INT AS cls FROM ch""")
def change_classes(spark, d):
    return change(spark, d)


@query(f"""WITH {OBS}, {PERIODS}, {CHANGE}, codes(code, label) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in CODES.items())}), n AS (SELECT cls, count(*) AS pixels FROM ch GROUP BY cls)
SELECT code, label, coalesce(pixels, 0) AS pixels, round((coalesce(pixels, 0) * {PIXEL_HA})::DOUBLE, 6) AS ha FROM codes LEFT JOIN n ON code = cls""")
def change_area(spark, d):
    return composite.class_areas(change(spark, d), "cls", code_table(spark), PIXEL_HA).withColumn("ha", F.round("ha", 6))


@query(f"""WITH {PIXELS} SELECT "row", col, CASE WHEN s <= 5 THEN 1 WHEN s <= 10 THEN 2 WHEN s <= 20 THEN 3 WHEN s <= 40 THEN 4 ELSE 5 END::INT AS risk FROM px""")
def risk_classes(spark, d):
    return pixels(spark, d).select("row", "col", spectral.classify(F.col("s").cast("double"), soil.RISK_EDGES).alias("risk"))


@query(f"""WITH {PIXELS}, a AS (SELECT "row", col, sin(radians(s / 2.0)) AS si, tan(radians(s / 2.0)) AS ta, (z % 100) / 100.0 AS nd, z FROM px),
b AS (SELECT *, (si / 0.0896) / (3.0 * pow(si, 0.8) + 0.56) AS be, CASE WHEN ta < 0.09 THEN 10.8 * si + 0.03 ELSE 16.8 * si - 0.5 END AS st FROM a)
SELECT "row", col, round(greatest(pow(20.0 / 22.13, be / (1 + be)) * st, 0.0), 6) AS ls, round(least(greatest(exp(-2.0 * least(greatest(nd, -0.99), 0.99) / (1.0 - least(greatest(nd, -0.99), 0.99))), 0), 1), 6) AS c, round(79 + 0.363 * z, 6) AS r FROM b""")
def rusle_factors(spark, d):
    return pixels(spark, d).select("row", "col", F.round(soil.ls_factor(F.col("s") / 2.0, 20.0), 6).alias("ls"), F.round(soil.c_factor((F.col("z") % 100) / 100.0), 6).alias("c"), F.round(soil.r_factor(F.col("z")), 6).alias("r"))


@query(f"""WITH {PIXELS}, a AS (SELECT "row", col, 20.0 + s AS sand, 10.0 + s / 2.0 AS silt, 5.0 + s / 4.0 AS clay, 0.5 + s / 50.0 AS oc FROM px), b AS (SELECT *, 1.0 - sand / 100.0 AS sn FROM a)
SELECT "row", col, round((0.2 + 0.3 * exp(-0.256 * sand * (1.0 - silt / 100.0))) * pow(silt / greatest(clay + silt, 1e-6), 0.3) * (1.0 - 0.25 * oc / (oc + exp(3.72 - 2.95 * oc))) * (1.0 - 0.7 * sn / (sn + exp(-5.51 + 22.9 * sn))) * 0.1317, 8) AS k FROM b""")
def k_factor_epic(spark, d):
    s = F.col("s")
    return pixels(spark, d).select("row", "col", F.round(soil.k_factor(20.0 + s, 10.0 + s / 2.0, 5.0 + s / 4.0, 0.5 + s / 50.0), 8).alias("k"))


_AROUND = f"""{PIXELS}, sh AS (SELECT max("row") AS mr, max(col) AS mc FROM px), st AS (SELECT a.x AS dr, b.x AS dc FROM (SELECT unnest([-2, -1, 0, 1, 2]) AS x) a, (SELECT unnest([-2, -1, 0, 1, 2]) AS x) b),
nb AS (SELECT p."row", p.col, p.z AS own, p.s AS own_s, n.z, n.s FROM px p, sh, st JOIN px n ON n."row" = least(greatest(p."row" + dr, 0), mr) AND n.col = least(greatest(p.col + dc, 0), mc))"""


@query(f"""WITH {_AROUND} SELECT "row", col, round(sum(s) / 25.0, 6) AS box_mean FROM nb GROUP BY "row", col""")
def box_mean(spark, d):
    c = pixels(spark, d)
    return focal.box_mean(c.withColumn("s", F.col("s").cast("double")), "s", 5, *shape(c)).select("row", "col", F.round("box_mean", 6).alias("box_mean"))


@query(f"""WITH {_AROUND} SELECT "row", col, round(CASE WHEN any_value(own_s) % 4 <> 0 THEN sum(s) FILTER (s % 4 <> 0) / count(*) FILTER (s % 4 <> 0) END, 6) AS box_mean FROM nb GROUP BY "row", col""")
def nan_box_mean(spark, d):
    c = pixels(spark, d)
    x = c.withColumn("s", F.when(F.col("s") % 4 != 0, F.col("s").cast("double")))
    return focal.known_box_mean(x, "s", 5, *shape(c)).select("row", "col", F.round("box_mean", 6).alias("box_mean"))


@query(f"""WITH {_AROUND} SELECT "row", col, min(z) AS box_min FROM nb GROUP BY "row", col""")
def min_filter(spark, d):
    return focal.box_min(pixels(spark, d), "z", 5).select("row", "col", "box_min")


@query(f"""WITH {PIXELS}, g AS (SELECT "row", col, z, lag(z) OVER r AS w, lead(z) OVER r AS e, lag(z) OVER c AS n, lead(z) OVER c AS so FROM px WINDOW r AS (PARTITION BY "row" ORDER BY col), c AS (PARTITION BY col ORDER BY "row")),
h AS (SELECT "row", col, CASE WHEN w IS NULL THEN (e - z) / 20 WHEN e IS NULL THEN (z - w) / 20 ELSE (e - w) / 40 END AS gx, CASE WHEN n IS NULL THEN (so - z) / 20 WHEN so IS NULL THEN (z - n) / 20 ELSE (so - n) / 40 END AS gy FROM g)
SELECT "row", col, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) AS slope FROM h""")
def slope(spark, d):
    return focal.slope(pixels(spark, d), "z", 20.0).select("row", "col", F.round("slope", 6).alias("slope"))


_STEPS = "s2 AS (SELECT a.x AS dr, b.x AS dc FROM (SELECT unnest([-2, -1, 0, 1, 2]) AS x) a, (SELECT unnest([-2, -1, 0, 1, 2]) AS x) b WHERE abs(a.x) + abs(b.x) <= 2)"


@query(f"""WITH {OBS}, {FREQ}, {WATER}, {_STEPS}, di AS (SELECT DISTINCT "row" + dr AS "row", col + dc AS col FROM wt, s2), er AS (SELECT "row" + dr AS "row", col + dc AS col FROM wt, s2 GROUP BY ALL HAVING count(*) = 13)
SELECT "row"::INT AS "row", col::INT AS col, 'dilated' AS kind FROM di UNION ALL SELECT "row"::INT, col::INT, 'eroded' FROM er""")
def dilate_erode(spark, d):
    w = water(spark, d)
    return focal.dilate(w, 2).withColumn("kind", F.lit("dilated")).unionByName(focal.erode(w, 2).withColumn("kind", F.lit("eroded")))


@query(f"""WITH {PIXELS}, e AS (SELECT min(z) AS lo, max(z) AS hi FROM px), h AS (SELECT least(floor((z - lo) / (hi - lo) * 256), 255)::INT AS bin, lo, hi, count(*) AS n FROM px, e GROUP BY ALL),
g AS (SELECT b.bin, e.lo, e.hi, coalesce(n, 0)::DOUBLE AS n, e.lo + (b.bin + 0.5) * (e.hi - e.lo) / 256 AS c FROM (SELECT unnest(range(256)) AS bin) b CROSS JOIN e LEFT JOIN h ON h.bin = b.bin),
w AS (SELECT *, sum(n) OVER o AS w0, sum(n * c) OVER o AS s0, sum(n) OVER () AS wt, sum(n * c) OVER () AS st FROM g WINDOW o AS (ORDER BY bin)),
v AS (SELECT *, w0 * (wt - w0) * pow(s0 / greatest(w0, 1) - (st - s0) / greatest(wt - w0, 1), 2) AS b FROM w WHERE bin < 255)
SELECT round(any_value(lo) + (round_even(avg(bin), 0) + 0.5) * (any_value(hi) - any_value(lo)) / 256, 6) AS threshold FROM v WHERE b >= (SELECT max(b) FROM v) * (1 - 1e-6)""")
def otsu(spark, d):
    return threshold.otsu(pixels(spark, d), "z").select(F.round("threshold", 6).alias("threshold"))


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH} SELECT "row"::INT AS "row", col::INT AS col, region::BIGINT AS region FROM rg""")
def connected_components(spark, d):
    return regions.components(water(spark, d), tile=16).select("row", "col", "region")


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH} SELECT "row"::INT AS "row", col::INT AS col FROM rg WHERE region IN (SELECT region FROM rg GROUP BY region HAVING count(*) >= 10)""")
def river_mask(spark, d):
    return regions.large_regions(water(spark, d), 10)


_CELLS = """wt AS (SELECT "row", col, (CASE WHEN k / n >= 0.5 THEN 1 ELSE 0 END) AS cls FROM fr WHERE n > 0)"""
_EDGES2 = EDGES.replace("abs(a.col - b.col) <= 1", "abs(a.col - b.col) <= 1 AND a.cls = b.cls")


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {_CELLS}, {_EDGES2}, {REACH}, r2 AS (SELECT rg.*, cls FROM rg JOIN wt USING ("row", col)), sz AS (SELECT region, any_value(cls) AS cls, count(*) AS size FROM r2 GROUP BY region),
nb AS (SELECT DISTINCT a.region AS me, b.region FROM r2 a JOIN r2 b ON abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1 AND a.region <> b.region),
mv AS (SELECT me, arg_max(s.cls, s.size * 100000000000000 - s.region) AS cls FROM nb JOIN sz m ON m.region = me AND m.size < 5 JOIN sz s ON s.region = nb.region GROUP BY me)
SELECT r2."row"::INT AS "row", r2.col::INT AS col, coalesce(mv.cls, r2.cls)::INT AS cls FROM r2 LEFT JOIN mv ON mv.me = r2.region""")
def sieve(spark, d):
    c = freq(spark, d).where("n > 0").select("row", "col", F.when(F.col("k") / F.col("n") >= 0.5, 1).otherwise(0).alias("cls"))
    return regions.sieve(c, 5)


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {PERIODS}, {CHANGE}, {WATER}, {EDGES}, {REACH}, rv AS (SELECT "row", col FROM rg WHERE region IN (SELECT region FROM rg GROUP BY region HAVING count(*) >= 40)),
ls AS (SELECT "row", col FROM ch WHERE cls IN (1, 5)), e2 AS (SELECT a."row" * 2147483648 + a.col AS a, b."row" * 2147483648 + b.col AS b FROM ls a JOIN ls b ON abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1),
t2(id, lab) AS (SELECT "row" * 2147483648 + col, "row" * 2147483648 + col FROM ls UNION SELECT e2.b, t2.lab FROM t2 JOIN e2 ON t2.id = e2.a), r2 AS (SELECT id // 2147483648 AS "row", id % 2147483648 AS col, min(lab) AS region FROM t2 GROUP BY id),
tc AS (SELECT DISTINCT region FROM r2 JOIN rv ON abs(r2."row" - rv."row") <= 1 AND abs(r2.col - rv.col) <= 1)
SELECT ch."row", ch.col, (CASE WHEN (SELECT count(*) FROM rv) > 0 AND cls IN (1, 5) AND r2.region NOT IN (SELECT region FROM tc) THEN 6 ELSE cls END)::INT AS cls FROM ch LEFT JOIN r2 ON r2."row" = ch."row" AND r2.col = ch.col""")
def inland_split(spark, d):
    return regions.inland_split(change(spark, d), regions.large_regions(water(spark, d), 40), 1)


@query(f"""WITH {OBS}, {FREQ}, {WATER}, l AS (SELECT "row", col FROM fr WHERE NOT coalesce(k / nullif(n, 0) >= 0.5 AND n >= 2, false)),
m AS (SELECT l."row", l.col, min((l."row" - wt."row") * (l."row" - wt."row") + (l.col - wt.col) * (l.col - wt.col)) AS d2 FROM l, wt GROUP BY ALL) SELECT l."row", l.col, round(sqrt(d2) * 20.0, 6) AS distance FROM l LEFT JOIN m USING ("row", col)""")
def retreat_distance(spark, d):
    w = water(spark, d)
    land = freq(spark, d).join(w, ["row", "col"], "left_anti")
    return regions.distance_to(land, w, 20.0).select("row", "col", F.round("distance", 6).alias("distance"))


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH}, {PIXELS} SELECT region::BIGINT AS region, count(*) AS pixels, sum(s)::BIGINT AS total, round(avg(z), 6) AS mean, max(z) AS most FROM rg JOIN px ON px."row" = rg."row" AND px.col = rg.col GROUP BY region""")
def zonal_stats(spark, d):
    r = regions.written(regions.components(water(spark, d)))
    p = pixels(spark, d)
    z = regions.zonal(r, p, "z").select("region", "pixels", F.round("mean", 6).alias("mean"), "most")
    return z.join(regions.zonal(r, p, "s").select("region", F.col("sum").alias("total")), "region")


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH}, {PIXELS}, n AS (SELECT region, s % 3 AS code, count(*) AS n FROM rg JOIN px ON px."row" = rg."row" AND px.col = rg.col GROUP BY ALL) SELECT region::BIGINT AS region, arg_max(code, n * 10 - code)::INT AS code FROM n GROUP BY region""")
def majority_class(spark, d):
    return regions.majority(regions.components(water(spark, d)), pixels(spark, d).withColumn("k", F.col("s") % 3), "k")


#: Edges of the patch sizes in ha, for the mapped and for the tested edition.
SIZE_EDGES = (0, 0.05, 0.1, 0.2, 0.4, 1, 5, 20, 1e9)
TESTED_EDGES = (0.02, *SIZE_EDGES[1:])
_BIN = "CASE " + " ".join(f"WHEN a >= {x} AND a < {y} THEN {k}" for k, (x, y) in enumerate(zip(SIZE_EDGES[:-1], SIZE_EDGES[1:], strict=True))) + " END"


@query(f"""WITH RECURSIVE {OBS}, {FREQ}, {WATER}, {EDGES}, {REACH}, z AS (SELECT region, count(*) * {PIXEL_HA} AS a FROM rg GROUP BY region) SELECT ({_BIN})::INT AS bin, count(*) AS patches FROM z GROUP BY ALL""")
def size_histogram(spark, d):
    z = regions.region_sizes(regions.components(water(spark, d)))
    return z.groupBy(stats.bins(F.col("size") * PIXEL_HA, SIZE_EDGES).alias("bin")).agg(F.count(F.lit(1)).alias("patches"))


@query(f"""WITH {PIXELS} SELECT ("row" // 2)::BIGINT AS "row", (col // 2)::BIGINT AS col, round(CASE WHEN count(*) FILTER (s % 9 <> 0) = 4 THEN avg(z) END, 6) AS z FROM px GROUP BY ALL""")
def block_mean_2x2(spark, d):
    x = pixels(spark, d).withColumn("z", F.when(F.col("s") % 9 != 0, F.col("z")))
    return composite.block_mean(x, "z").withColumn("z", F.round("z", 6))


@query(f"""WITH {OBS}, dy AS (SELECT date, dense_rank() OVER (ORDER BY date) AS k FROM (SELECT DISTINCT date FROM obs)), u AS (SELECT "row", col, v, unnest(['all', CASE WHEN k % 2 = 1 THEN 'odd' ELSE 'even' END]) AS subset FROM obs JOIN dy USING (date))
SELECT "row", col, subset, count(v) AS n, round(avg(v), 10) AS mean, round(var_samp(v), 8) AS var FROM u GROUP BY ALL""")
def odd_even_stats(spark, d):
    return composite.subset_statistics(observations(spark, d), "v").withColumn("mean", F.round("mean", 10)).withColumn("var", F.round("var", 8))


_AB = f"""{OBS}, ab AS (SELECT "row", col, count(v) FILTER (period = 'was') AS na, avg(v) FILTER (period = 'was') AS ma, var_samp(v) FILTER (period = 'was') AS va, count(v) FILTER (period = 'now') AS nb, avg(v) FILTER (period = 'now') AS mb, var_samp(v) FILTER (period = 'now') AS vb FROM obs GROUP BY ALL),
f AS (SELECT *, greatest(coalesce(va, 0), 0.0025) / na AS fa, greatest(coalesce(vb, 0), 0.0025) / nb AS fb FROM ab WHERE na >= 3 AND nb >= 3)"""


def both_periods(spark, d) -> DataFrame:
    o = observations(spark, d)
    per = lambda p: [f(F.when(F.col("period") == p, F.col("v"))).alias(n + ("a" if p == "was" else "b")) for f, n in ((F.count, "n"), (F.avg, "m"), (F.var_samp, "v"))]
    x = o.groupBy("row", "col").agg(*per("was"), *per("now"))
    w = stats.welch(*[F.col(c) for c in ("na", "ma", "va", "nb", "mb", "vb")])
    return x.select("row", "col", *[c.alias(k) for k, c in w.items()]).where("t is not null")


@query(f"""WITH {_AB} SELECT "row", col, round(mb - ma, 6) AS d, round(sqrt(fa + fb), 6) AS se, round((mb - ma) / sqrt(fa + fb), 6) AS t, round((fa + fb) * (fa + fb) / (fa * fa / (na - 1) + fb * fb / (nb - 1)), 5) AS df FROM f""")
def welch_t(spark, d):
    return both_periods(spark, d).select("row", "col", *[F.round(c, 6).alias(c) for c in ("d", "se", "t")], F.round("df", 5).alias("df"))


@query()
def welch_p(spark, d):
    return stats.benjamini_hochberg(stats.tested(both_periods(spark, d)), "p_two", 0.5)


@query()
def stouffer_p(spark, d):
    t = stats.tested(both_periods(spark, d))
    r = regions.components(t.where("d > 0").select("row", "col")).select("row", "col", "region")
    return stats.stouffer(t.join(r, ["row", "col"]), "region", "p_up")


@query()
def null_test(spark, d):
    """Odd against even dates of one period: rejections are false ones."""
    s = composite.subset_statistics(observations(spark, d).where("period = 'was'"), "v")
    a, b = (s.where(F.col("subset") == k).select("row", "col", *[F.col(c).alias(c[0] + x) for c in ("n", "mean", "var")]) for k, x in (("odd", "a"), ("even", "b")))
    w = stats.welch(*[F.col(c) for c in ("na", "ma", "va", "nb", "mb", "vb")])
    t = stats.tested(a.join(b, ["row", "col"]).select("row", "col", *[c.alias(k) for k, c in w.items()]))
    return stats.benjamini_hochberg(t, "p_two").agg(F.count("p_two").alias("tested"), F.count_if("rejected").alias("rejected"))


_LC = lambda n, k: f"(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - ({k}) + 1))"


@query(f"""WITH RECURSIVE {OBS}, {PERIODS}, x AS (SELECT "row", col, na, ka, nb, kb, na + nb AS t, ka + kb AS g FROM pf WHERE na >= 2 AND nb >= 2),
y AS (SELECT *, (SELECT coalesce(sum(exp({_LC("g", "j")} + {_LC("t - g", "nb - j")} - {_LC("t", "nb")})), 0) FROM generate_series(greatest(kb, nb + g - t, 0), least(g, nb)) q(j)) AS up FROM x)
SELECT "row", col, ka, na, kb, nb, round(least(up, 1), 6) AS p_up FROM y""")
def fisher_counts(spark, d):
    x = periods(spark, d).where((F.col("na") >= 2) & (F.col("nb") >= 2))
    return x.select("row", "col", "ka", "na", "kb", "nb", F.round(stats.fisher(*[F.col(c) for c in ("ka", "na", "kb", "nb")])["p_up"], 6).alias("p_up"))


@query(f"""WITH {OBS}, {FREQ}, p AS (SELECT "row", col, (k + 1) / (n + 40)::DOUBLE AS p FROM fr), r AS (SELECT *, count(*) OVER (ORDER BY p) AS rk, count(*) OVER () AS m FROM p), c AS (SELECT max(p) AS cut FROM r WHERE p * m <= 0.2 * rk) SELECT "row", col, coalesce(p <= cut, false) AS rejected FROM r, c""")
def bh_fdr(spark, d):
    p = freq(spark, d).select("row", "col", ((F.col("k") + 1) / (F.col("n") + 40)).alias("p"))
    return stats.benjamini_hochberg(p, "p", 0.2).select("row", "col", "rejected")


@query("""WITH e AS (SELECT label, vec_id, embedding::DOUBLE[] AS x FROM embeddings), m AS (SELECT i, avg(x[i]) FILTER (label = 0) AS w, avg(x[i]) FILTER (label = 1) AS l FROM e, (SELECT unnest(range(1, 65)) AS i) GROUP BY i),
d AS (SELECT vec_id, sum((x[i] - l) * (w - l)) AS a, sum((w - l) * (w - l)) AS b FROM e, m GROUP BY vec_id) SELECT vec_id, round(least(greatest(a / b, 0), 1), 5) AS fraction FROM d""")
def unmix_fraction(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    ends = e.where("label in (0, 1)").select("label", F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg(F.when(F.col("label") == 0, F.col("v"))).alias("w"), F.avg(F.when(F.col("label") == 1, F.col("v"))).alias("l"))
    both = ends.agg(F.array_sort(F.collect_list(F.struct("i", "w", "l"))).alias("m"))  # one row of as many entries as bands
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    m = e.crossJoin(F.broadcast(both)).withColumn("g", F.transform("m", lambda k: k["w"] - k["l"])).withColumn("r", F.zip_with("x", "m", lambda x, k: x - k["l"]))
    return m.select("vec_id", F.round(spectral.clip(dot(F.col("r"), F.col("g")) / dot(F.col("g"), F.col("g")), 0.0, 1.0), 5).alias("fraction"))


@query(f"""WITH {OBS} SELECT period, round(quantile_cont(p, 0.02), 6) AS p2, round(quantile_cont(p, 0.98), 6) AS p98 FROM obs GROUP BY period""")
def stretch_percentiles(spark, d):
    o = regions.written(observations(spark, d).select("period", "p"))
    rows = [(k, *stats.quantiles(o.where(F.col("period") == k), "p", (0.02, 0.98))) for k in ("was", "now")]
    return spark.createDataFrame(rows, "period string, p2 double, p98 double").where("p2 is not null").select("period", F.round("p2", 6).alias("p2"), F.round("p98", 6).alias("p98"))
