"""Queries over whole chains: exposure and ranking of sites, field reports, sensor alerts, reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvia.functions import rules
from fluvia.operators import exposure, external, sites
from fluvia.plans.grid import table
from fluvia.plans.tables import _D2, _FIELD, _HAZ, _LABEL, _PLACES, _POINTS, _SITES, AUC, field_frames, places, points, site_frame
from fluvia.streaming import alerts

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def roads(spark, d, every: int = 1) -> DataFrame:
    k = F.col("s_suppkey")
    x1, y1 = k * 197 % 20011, k * 611 % 20023
    g = table(spark, d, "supplier").where(k % every == 0)
    return g.select(k.alias("sid"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"), (x1 + k % 900 - 450).cast("double").alias("x2"), (y1 + k * 7 % 900 - 450).cast("double").alias("y2"))


def layers(spark, d) -> dict[str, DataFrame]:
    """All layers but the crop raster, which is absent."""
    p = points(spark, d)
    built = p.where("pid % 3 = 0").withColumn("v", F.col("v") % 100).withColumn("cell_ha", F.lit(0.04))
    return {"population": p.withColumn("v", F.col("v") % 1000), "built_ha": built, "road_km": roads(spark, d), "embankment_km": roads(spark, d, 2), "facilities": p.where("pid % 5 = 0"), "places": places(spark, d)}


_SEG = "(SELECT s_suppkey AS sid, (s_suppkey * 197 % 20011)::DOUBLE AS x1, (s_suppkey * 611 % 20023)::DOUBLE AS y1, (s_suppkey * 197 % 20011 + s_suppkey % 900 - 450)::DOUBLE AS x2, (s_suppkey * 611 % 20023 + s_suppkey * 7 % 900 - 450)::DOUBLE AS y2 FROM supplier WHERE s_suppkey % {0} = 0)"


def _len(name: str, every: int) -> str:
    return f"""{name}c AS (SELECT id, (x2 - x1) ** 2 + (y2 - y1) ** 2 AS qa, (x1 - x) * (x2 - x1) + (y1 - y) * (y2 - y1) AS qb, (x1 - x) ** 2 + (y1 - y) ** 2 - 250000 AS qc FROM s0, {_SEG.format(every)} g),
{name} AS (SELECT id, sum(CASE WHEN qa > 0 AND qb * qb > qa * qc THEN (least(greatest((-qb + sqrt(qb * qb - qa * qc)) / qa, 0), 1) - least(greatest((-qb - sqrt(qb * qb - qa * qc)) / qa, 0), 1)) * sqrt(qa) ELSE 0 END) / 1000 AS km FROM {name}c GROUP BY id)"""


#: Exposure of the sites in s0(id, x, y).
_EXPOSED = f"""{_POINTS}, {_PLACES}, po AS (SELECT id, sum(v % 1000)::DOUBLE AS v FROM s0 s JOIN pt ON {_D2} <= 250000 GROUP BY id), bu AS (SELECT id, sum((v % 100) * 0.04::DOUBLE) AS v FROM s0 s JOIN pt ON pid % 3 = 0 AND {_D2} <= 250000 GROUP BY id),
fa AS (SELECT id, count(*)::DOUBLE AS v FROM s0 s JOIN pt ON pid % 5 = 0 AND {_D2} <= 250000 GROUP BY id), {_len("ro", 1)}, {_len("em", 2)},
np AS (SELECT id, name, sqrt(d2) AS m FROM (SELECT id, name, {_D2} AS d2, row_number() OVER (PARTITION BY id ORDER BY {_D2}, name) AS n FROM s0 s, pl) WHERE n = 1),
ex AS (SELECT s0.id, coalesce(po.v, 0) AS population, coalesce(bu.v, 0) AS built_ha, ro.km AS road_km, em.km AS embankment_km, coalesce(fa.v, 0) AS facilities, np.name AS nearest_place, round(np.m / 1000, 1) AS nearest_place_km FROM s0 LEFT JOIN po USING (id) LEFT JOIN bu USING (id) LEFT JOIN fa USING (id) JOIN ro USING (id) JOIN em USING (id) JOIN np USING (id)),
ei AS (SELECT *, round((0.35 * least(population / 2000, 1) + 0.15 * least(built_ha / 10, 1) + 0.1 * least(road_km / 3, 1) + 0.1 * least(embankment_km / 1, 1) + 0.15 * least(facilities / 2, 1)) / (0.35 + 0.15 + 0.1 + 0.1 + 0.15), 3) AS exposure_index FROM ex)"""


@query(f"""WITH {_SITES}, s0 AS (SELECT id, x, y FROM s WHERE id % 7 = 0), {_EXPOSED} SELECT id, round(population, 0) AS population, round(built_ha, 2) AS built_ha, NULL::DOUBLE AS crop_ha, round(road_km, 2) AS road_km, round(embankment_km, 2) AS embankment_km, facilities, exposure_index, nearest_place, nearest_place_km FROM ei""")
def site_exposure(spark, d):
    """Sites of one class of keys are the list here; every layer is read whole."""
    s = site_frame(spark, d).where("id % 7 = 0").select("id", "x", "y")
    return exposure.site_exposure(s, layers(spark, d)).select("id", "population", "built_ha", "crop_ha", "road_km", "embankment_km", "facilities", "exposure_index", "nearest_place", "nearest_place_km")


_RANKED = f"""{_HAZ}, s0 AS (SELECT * FROM h WHERE hazard > 0 ORDER BY hazard DESC, id LIMIT 300), {_EXPOSED}, pr AS (SELECT s0.*, ei.population AS people, ei.road_km AS road, ei.embankment_km AS emb, ei.facilities AS fac, exposure_index, nearest_place, hazard * (0.3 + (1 - 0.3) * exposure_index) AS priority FROM s0 JOIN ei USING (id)),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY priority DESC, id) AS own FROM pr), f AS (SELECT *, own <= CASE source WHEN 'change' THEN 30 WHEN 'ai' THEN 15 WHEN 'risk' THEN 5 END AS inq FROM o), t AS (SELECT * FROM f ORDER BY inq DESC, priority DESC, id LIMIT 50),
rk AS (SELECT *, row_number() OVER (ORDER BY priority DESC, id)::INT AS rank, {_LABEL} AS confidence, round(people, 0) >= 500 OR round(emb, 2) > 0.1 AS urgent, round(road, 2) > 0.2 OR round(emb, 2) > 0.1 OR fac > 0 AS assets FROM t),
ur AS (SELECT *, CASE WHEN starts_with(cls, 'Bank erosion') THEN (CASE WHEN urgent AND confidence IN ('High', 'Medium') THEN 'Immediate' WHEN urgent OR assets OR exposure_index >= 0.4 THEN 'Before monsoon' ELSE 'Routine' END) WHEN starts_with(cls, 'Char') OR starts_with(cls, 'Accretion') THEN 'Monitor'
  WHEN starts_with(cls, 'Likely') THEN (CASE WHEN round(people, 0) >= 500 OR assets THEN 'Before monsoon' ELSE 'Routine' END) WHEN cls = 'Very high' THEN 'Before monsoon' ELSE 'Routine' END AS urgency FROM rk)"""


def ranked(spark, d) -> DataFrame:
    s = site_frame(spark, d).select("id", F.col("cls").alias("class"), "source", F.col("area").alias("area_ha"), "conf", "prob", "x", "y")
    of = lambda k: s.where(F.col("source") == k).drop("source")
    frames = {
        "change": of("change").withColumnRenamed("conf", "confidence_score").drop("prob"), "risk": of("risk").drop("conf", "prob"),
        "ai": of("ai").withColumnRenamed("conf", "model_agreement").withColumnRenamed("prob", "mean_probability"),
    }
    return exposure.recommended(exposure.rank_sites(frames, layers(spark, d), rules.model_skill(F.lit(AUC))))


@query(f"""WITH {_SITES}, {_RANKED} SELECT id, source, cls AS class, rank, round(hazard, 3) AS hazard_score, round(priority, 3) AS priority_score, confidence, exposure_index, nearest_place, urgency FROM ur""")
def rank_sites(spark, d):
    return ranked(spark, d).select("id", "source", "class", "rank", "hazard_score", "priority_score", "confidence", "exposure_index", "nearest_place", "urgency")


@query(f"""WITH {_SITES}, {_RANKED} SELECT count(*) AS sites, count(*) FILTER (urgency = 'Immediate') AS immediate, coalesce(sum(round(people, 0)) FILTER (urgency = 'Immediate'), 0)::DOUBLE AS people_immediate, round(sum(round(area, 2)), 1) AS area_ha FROM ur""")
def key_figures(spark, d):
    return exposure.key_figures(ranked(spark, d))


@query(f"""WITH {_SITES}, {_RANKED} SELECT '9807-' || CASE WHEN rank < 10 THEN '0' ELSE '' END || rank AS name, split_part(cls, ' (', 1) AS site_class, urgency, rank::BIGINT AS rank, '#' || rank || ' ' || split_part(cls, ' (', 1) || ' near ' || nearest_place || printf(' (%.4f, %.4f)', 27 + id % 100 / 100.0, 94 + id % 50 / 100.0) AS label FROM ur
UNION ALL SELECT 'NEW', '', '', NULL, 'New site (not on the list)'""")
def site_list(spark, d):
    s = ranked(spark, d).withColumn("lat", 27 + F.col("id") % 100 / 100.0).withColumn("lon", 94 + F.col("id") % 50 / 100.0)
    return exposure.site_list(s, F.lit("1998-07-15").cast("date")).select("name", "site_class", "urgency", "rank", "label")


_TEXTS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.ACTIONS.items())


@query(f"""WITH {_SITES}, u AS (SELECT id, cls, (id % 17)::DOUBLE AS slope, {_LABEL} AS confidence, road_km > 0.2 OR embankment_km > 0.1 OR facilities > 0 AS assets, population >= 500 OR embankment_km > 0.1 AS urgent, population FROM s),
k AS (SELECT id, CASE WHEN starts_with(cls, 'Bank erosion') THEN (CASE WHEN urgent AND confidence IN ('High', 'Medium') THEN 'bank_urgent' WHEN urgent OR assets THEN 'bank_assets' ELSE 'bank_low' END) WHEN starts_with(cls, 'Char') THEN 'char' WHEN starts_with(cls, 'Likely') THEN 'ai' WHEN starts_with(cls, 'Accretion') THEN 'accretion'
  WHEN starts_with(cls, 'New inland water') THEN 'inland_water' WHEN starts_with(cls, 'Vegetation loss') THEN 'veg_loss' WHEN starts_with(cls, 'New bare soil') THEN 'bare_soil' WHEN cls IN ('High', 'Very high') THEN (CASE WHEN slope >= 8 THEN 'risk_steep' ELSE 'risk_gentle' END) ELSE 'other' END AS k FROM u)
SELECT id, CASE k {_TEXTS} END AS action, left(CASE k {_TEXTS} END, 254) AS short FROM k""")
def recommended_actions(spark, d):
    s = site_frame(spark, d).withColumn("confidence", rules.confidence_label(F.col("source"), F.col("conf"), F.col("conf"), F.col("prob"))).withColumn("mean_slope_deg", (F.col("id") % 17).cast("double"))
    r = exposure.recommended(s, "cls")
    return r.select("id", F.col("recommended_action").alias("action"), rules.cut_text(F.col("recommended_action")).alias("short"))


@query(f"""WITH {_SITES}, {_FIELD}, a AS (SELECT record_id, px IS NOT NULL AS gps, (record_id % 4 = 1)::INT AS yes, claimed, record_id % 50 = 0 AND claimed IS NULL AS fresh FROM rc),
v AS (SELECT count(*) AS visited, count(*) FILTER (verdict = 'Confirmed') AS confirmed, count(*) FILTER (verdict = 'Not confirmed') AS not_confirmed, round(count(*) FILTER (verdict = 'Confirmed') / nullif(count(*) FILTER (verdict IN ('Confirmed', 'Not confirmed')), 0), 3) AS rate FROM vd)
SELECT (SELECT count(*) FROM a) AS records, (SELECT count(*) FILTER (gps) FROM a) AS records_with_gps, (SELECT round(avg(yes), 3) FROM a) AS map_agreement, (SELECT count(*) FILTER (fresh) FROM a) AS new_sites, v.* FROM v""")
def field_report(spark, d):
    s, r = field_frames(spark, d)
    k = F.col("record_id")
    full = r.withColumn("map_agrees", F.when(k % 4 == 1, "Yes").when(k % 4 == 2, "no")).withColumn("claimed", F.coalesce("claimed", F.when(k % 50 == 0, "NEW")))
    return sites.field_report(full, s)


@query(f"""WITH {_SITES}, {_FIELD} SELECT site_class, count(*) AS visited, count(*) FILTER (verdict = 'Confirmed') AS confirmed FROM vd JOIN st USING (site_id) GROUP BY site_class""")
def field_by_type(spark, d):
    s, r = field_frames(spark, d)
    return sites.field_by_type(s, sites.field_status(s, r))


@query("""WITH r AS (SELECT o_orderdate::DATE AS day, count(*) AS n, avg(o_totalprice) AS p FROM orders GROUP BY ALL), l AS (SELECT * FROM r ORDER BY day DESC LIMIT 7) SELECT day, n, round(p, 4) AS p, n % 100 < 60 AS low_confidence, date_diff('day', day, DATE '1998-08-10') >= 13 AS due FROM l""")
def latest_reports(spark, d):
    r = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("p"))
    x = sites.trend(sites.latest_reports(r, "day").withColumn("c", F.col("n") % 100), "day", "c")
    return x.select("day", "n", F.round("p", 4).alias("p"), "low_confidence", sites.due(F.col("day"), F.lit("1998-08-10").cast("date")).alias("due"))


@query("""WITH a AS (SELECT o_orderpriority AS k, sum(o_custkey)::DOUBLE AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL), b AS (SELECT o_orderpriority AS k, sum(o_custkey)::DOUBLE AS v FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' GROUP BY ALL)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.v, 0) AS now, coalesce(b.v, 0) AS before, round(coalesce(a.v, 0) - coalesce(b.v, 0), 1) AS change FROM a FULL JOIN b ON a.k = b.k""")
def edition_differences(spark, d):
    o = table(spark, d, "orders")
    total = lambda c: o.where(c).groupBy(F.col("o_orderpriority").alias("k")).agg(F.sum("o_custkey").cast("double").alias("v"))
    return sites.differences(total("o_orderstatus = 'O'"), total("o_orderstatus = 'F' and o_orderpriority <> '1-URGENT'"), "k", "v")


@query("SELECT min(doc_id) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL)")
def next_unlabelled(spark, d):
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return sites.next_unlabelled(table(spark, d, "documents").select(F.col("doc_id").alias("id")), labels)


_REACH = "re AS (SELECT s_suppkey AS rid, (s_suppkey * 197 % 20011)::DOUBLE AS x, (s_suppkey * 611 % 20023)::DOUBLE AS y, (s_suppkey % 5)::DOUBLE AS rate, (1500 + s_suppkey * 97 % 3000)::DOUBLE AS length_m FROM supplier), ar(district, west, south, east, north) AS (VALUES ('A', 0, 0, 15000, 20023), ('B', 10000, 0, 20011, 15000)), vr AS (SELECT re.*, (SELECT min(district) FROM ar WHERE x BETWEEN west AND east AND y BETWEEN south AND north) AS district FROM re WHERE rate > 0 AND length_m > 2000)"


def reaches(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    r = table(spark, d, "supplier").select(k.alias("rid"), (k * 197 % 20011).cast("double").alias("x"), (k * 611 % 20023).cast("double").alias("y"), (k % 5).cast("double").alias("rate"), (1500 + k * 97 % 3000).cast("double").alias("length_m"))
    a = spark.createDataFrame([("A", 0.0, 0.0, 15000.0, 20023.0), ("B", 10000.0, 0.0, 20011.0, 15000.0)], "district string, west double, south double, east double, north double")
    return external.valid_reaches(r, a)


@query(f"""WITH {_SITES}, {_REACH}, v2 AS (SELECT * FROM vr WHERE district IS NOT NULL), p AS (SELECT id, x AS px, y AS py, area * 100 AS a FROM s WHERE cls LIKE 'Bank%' OR cls LIKE 'Char%'),
n AS (SELECT rid, a, rank() OVER (PARTITION BY id ORDER BY (px - x) ** 2 + (py - y) ** 2) AS n FROM p JOIN v2 ON (px - x) * (px - x) + (py - y) * (py - y) <= 9000000), g AS (SELECT rid, sum(a) AS a FROM n WHERE n = 1 GROUP BY rid)
SELECT v2.rid, district, round(coalesce(a, 0) / 1e4, 4) AS area_ha, round(coalesce(a, 0) / (2 * length_m) / 6.0, 4) AS mapped_rate FROM v2 LEFT JOIN g USING (rid)""")
def reach_rates(spark, d):
    r = reaches(spark, d)
    p = site_frame(spark, d).where("cls like 'Bank%' or cls like 'Char%'").select(F.col("id").alias("pid"), F.col("x").alias("px"), F.col("y").alias("py"), (F.col("area") * 100).alias("area_m2"))
    got = external.reach_rates(p, r, 6.0)
    return got.join(r.select("rid", "district"), "rid").select("rid", "district", F.round("area_ha", 4).alias("area_ha"), F.round("mapped_rate", 4).alias("mapped_rate"))


@query("""WITH c AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'a' ELSE 'b' END AS collection, (s_suppkey % 90)::DOUBLE AS w, (s_suppkey % 40)::DOUBLE AS s, (s_suppkey % 100)::DOUBLE AS cloud, DATE '1995-01-01' + (s_suppkey % 700)::INT AS day FROM supplier)
SELECT id, cloud FROM c WHERE collection = 'a' AND w <= 60 AND w + 3 >= 20 AND s <= 30 AND s + 2 >= 5 AND day BETWEEN DATE '1995-01-01' AND DATE '1996-06-30' AND cloud < 80""")
def scene_search(spark, d):
    from fluvia.sources.tables import scenes

    k = F.col("s_suppkey")
    c = table(spark, d, "supplier").select(
        k.alias("id"), F.when(k % 2 == 0, "a").otherwise("b").alias("collection"), (k % 90).cast("double").alias("west"), (k % 40).cast("double").alias("south"), (k % 90 + 3).cast("double").alias("east"), (k % 40 + 2).cast("double").alias("north"),
        (k % 100).cast("double").alias("cloud"), F.date_add(F.lit("1995-01-01").cast("date"), (k % 700).cast("int")).alias("date"),
    )
    return scenes(c, "a", (20.0, 5.0, 60.0, 30.0), "1995-01-01", "1996-06-30", 80.0).select("id", "cloud")


METRICS = ["level_m", "rain_mm", "pore_kpa", "soil_30", "battery_v", "tilt"]
_METRIC = "CASE event_id % 6 " + " ".join(f"WHEN {k} THEN '{m}'" for k, m in enumerate(METRICS)) + " END"
_VALUE = "CASE event_id % 6 WHEN 0 THEN value / 10 WHEN 1 THEN value WHEN 2 THEN value WHEN 3 THEN value / 2 WHEN 4 THEN 3 + value / 100 ELSE value / 8 END"


def station_readings(spark, d) -> DataFrame:
    e, v = F.col("event_id") % 6, F.col("value")
    metric = F.element_at(F.array(*[F.lit(m) for m in METRICS]), (e + 1).cast("int"))
    value = F.when(e == 0, v / 10).when(e == 3, v / 2).when(e == 4, 3 + v / 100).when(e == 5, v / 8).otherwise(v)
    x = table(spark, d, "events").select("event_id", F.col("user_id").alias("station"), F.col("ts").cast("timestamp").alias("ts"), metric.alias("metric"), F.when(e == 5, 5 + 5 * (F.floor(F.col("event_id") / 6) % 2)).otherwise(0).cast("int").alias("setback"), F.when(F.col("event_id") % 23 != 0, value).alias("value"))
    return x


def station_table(spark, d) -> DataFrame:
    ids = table(spark, d, "events").select(F.col("user_id").alias("station")).distinct().unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("station")))
    s = F.col("station")
    return ids.select("station", F.when(s % 2 == 0, 8.0).otherwise(9.0).alias("level_warning_m"), F.when(s % 3 == 0, 4.0).alias("piezo_tip_m"), F.array(F.lit(5), F.lit(10), F.lit(15)).alias("setbacks"))


_SENSOR = f"""rd AS (SELECT event_id, user_id AS station, epoch_us(ts) AS us, {_METRIC} AS metric, CASE WHEN event_id % 6 = 5 THEN 5 + 5 * ((event_id // 6) % 2) ELSE 0 END AS setback, {_VALUE} AS value FROM events WHERE event_id % 23 <> 0),
st AS (SELECT station, CASE WHEN station % 2 = 0 THEN 8.0 ELSE 9.0 END AS warn, CASE WHEN station % 3 = 0 THEN 4.0 END AS tip FROM (SELECT DISTINCT user_id AS station FROM events UNION SELECT -1)), nw AS (SELECT max(epoch_us(ts)) + 3600000000 AS now FROM events),
la AS (SELECT *, max(us) OVER (PARTITION BY station, metric, setback) AS last FROM rd), l AS (SELECT station, metric, setback, max(us) AS us, arg_max(value, event_id) FILTER (us = last) AS value, min(value) FILTER (last - us < 86400000000) AS low, sum(value) FILTER (last - us < 86400000000) AS total, arg_max(value, us) FILTER (last - us >= 21600000000) AS old FROM la GROUP BY ALL),
lv AS (SELECT st.*, value AS level, value - old AS change FROM st JOIN l USING (station) WHERE metric = 'level_m'),
po AS (SELECT lv.station, l.value - l.low AS rise, l.value - 9.81 * (level - coalesce(tip, warn - 5)) AS excess FROM lv JOIN l ON l.station = lv.station AND metric = 'pore_kpa'),
nd AS (SELECT st.station, n.setback, l.value AS tilt, l.value - l.low AS change, now - l.us > 7200000000 AS silent FROM st CROSS JOIN (VALUES (5), (10), (15)) n(setback) CROSS JOIN nw LEFT JOIN l ON l.station = st.station AND l.metric = 'tilt' AND l.setback = n.setback WHERE st.station IN (SELECT station FROM l)),
al AS (SELECT station, 'level_fall_6h' AS rule, NULL::INT AS setback, 'warning' AS severity, change AS value FROM lv WHERE change <= -0.5 UNION ALL SELECT station, 'level_rise_6h', NULL, 'watch', change FROM lv WHERE change >= 1 UNION ALL SELECT station, 'level_high', NULL, 'warning', level FROM lv WHERE level >= warn
  UNION ALL SELECT station, 'rain_24h', NULL, 'warning', total FROM l WHERE metric = 'rain_mm' AND total >= 64.5 UNION ALL SELECT station, 'pore', NULL, CASE WHEN excess >= 10 THEN 'warning' ELSE 'watch' END, CASE WHEN excess >= 10 THEN excess ELSE rise END FROM po WHERE excess >= 10 OR rise >= 5
  UNION ALL SELECT station, 'soil_wet', NULL, 'watch', value FROM l WHERE metric = 'soil_30' AND value >= 45 UNION ALL SELECT station, 'battery_low', NULL, 'info', value FROM l WHERE metric = 'battery_v' AND value < 3.5
  UNION ALL SELECT * FROM (SELECT station, 'tilt', setback, CASE WHEN tilt IS NULL THEN 'warning' WHEN silent THEN (CASE WHEN tilt >= 10 OR change >= 3 THEN 'critical' ELSE 'info' END) WHEN tilt >= 10 THEN 'critical' WHEN change >= 3 THEN 'warning' WHEN change >= 1 THEN 'watch' END AS sev, tilt FROM nd) WHERE sev IS NOT NULL
  UNION ALL SELECT station, 'no_data', NULL, 'warning', NULL FROM st WHERE station NOT IN (SELECT station FROM l)), sv(severity, rank) AS (VALUES ('critical', 3), ('warning', 2), ('watch', 1), ('info', 0))"""


def _evaluated(spark, d) -> tuple[DataFrame, DataFrame]:
    now = table(spark, d, "events").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0] + 3_600_000_000
    s = station_table(spark, d)
    return s, alerts.evaluated(s, station_readings(spark, d), F.timestamp_micros(F.lit(now)))


@query(f"WITH {_SENSOR} SELECT station, rule, setback::INT AS setback, severity, rank, round(value, 6) AS value FROM al JOIN sv USING (severity)")
def sensor_alerts(spark, d):
    """All rules: levels, rain, pore pressure, soil, tilt nodes, battery, stations that never reported."""
    return _evaluated(spark, d)[1].withColumn("value", F.round("value", 6))


@query(f"WITH {_SENSOR} SELECT st.station, coalesce(arg_max(severity, rank), 'normal') AS status, count(severity) AS n_alerts FROM st LEFT JOIN (SELECT * FROM al JOIN sv USING (severity)) USING (station) GROUP BY st.station")
def sensor_status(spark, d):
    s, a = _evaluated(spark, d)
    return alerts.statuses(s, a)
