"""Queries over sites, points, samples and sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvia.functions import rules
from fluvia.functions.coordinates import from_utm, to_mercator, to_utm
from fluvia.operators import accuracy, sites, spatial, stats
from fluvia.plans.grid import table
from fluvia.streaming import alerts

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


CLASSES = list(rules.HAZARD_WEIGHTS) + ["New inland water", "Low"]
_CLS = "CASE o_orderkey % 10 " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(CLASSES)) + " END"
_SRC = "CASE WHEN o_orderkey % 10 IN (1, 5, 9) THEN 'risk' WHEN o_orderkey % 10 = 2 THEN 'ai' ELSE 'change' END"
_CONF = "CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey % 101) / 100.0 END"
_PROB = "CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 97) / 96.0 END"
#: One site an order: class and source by key, area by price, exposure layers by key.
_SITES = f"""s AS (SELECT o_orderkey AS id, {_CLS} AS cls, {_SRC} AS source, o_totalprice / 1000.0 AS area, {_CONF} AS conf, {_PROB} AS prob, (o_orderkey * 7 % 3001)::DOUBLE AS population, (o_orderkey % 13)::DOUBLE AS built_ha,
  (o_orderkey % 47)::DOUBLE AS crop_ha, (o_orderkey % 5) / 2.0 AS road_km, (o_orderkey % 9) / 8.0 AS embankment_km, (o_orderkey % 4)::DOUBLE AS facilities, (o_orderkey % 83)::DOUBLE AS retreat, o_orderdate::DATE AS day,
  (o_orderkey * 37 % 20011)::DOUBLE AS x, (o_orderkey * 101 % 20023)::DOUBLE AS y FROM orders)"""
_WEIGHT = "CASE cls " + " ".join(f"WHEN '{c}' THEN {w}" for c, w in rules.HAZARD_WEIGHTS.items()) + " END"
_HAZ = f"""h AS (SELECT *, {_WEIGHT} * ln(1 + area) * CASE source WHEN 'change' THEN coalesce(conf, 1.0) WHEN 'ai' THEN CASE WHEN prob IS NULL THEN 1.0 ELSE least(greatest(prob / 0.5, 0), 1) * ((0.894 - 0.5) / 0.4) END ELSE 1.0 END AS hazard FROM s)"""
_EXP = "(" + " + ".join(f"{w} * least(greatest({k} / {t}, 0), 1)" for k, (w, t) in rules.EXPOSURE.items()) + ") / 1.0"
_PRI = f"p AS (SELECT *, {_EXP} AS expo, round(hazard * (0.3 + (1 - 0.3) * {_EXP}), 6) AS priority FROM h WHERE hazard > 0)"


def site_frame(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    x = o.select(
        k.alias("id"), F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (k % 10 + 1).cast("int")).alias("cls"), F.when((k % 10).isin(1, 5, 9), "risk").when(k % 10 == 2, "ai").otherwise("change").alias("source"),
        (F.col("o_totalprice") / 1000.0).alias("area"), F.when(k % 11 != 0, (k % 101) / 100.0).alias("conf"), F.when(k % 7 != 0, (k % 97) / 96.0).alias("prob"), (k * 7 % 3001).cast("double").alias("population"), (k % 13).cast("double").alias("built_ha"),
        (k % 47).cast("double").alias("crop_ha"), ((k % 5) / 2.0).alias("road_km"), ((k % 9) / 8.0).alias("embankment_km"), (k % 4).cast("double").alias("facilities"), (k % 83).cast("double").alias("retreat"), F.to_date("o_orderdate").alias("day"),
        (k * 37 % 20011).cast("double").alias("x"), (k * 101 % 20023).cast("double").alias("y"),
    )
    return x


#: The model's area under the curve that the sites' predictions are weighed with.
AUC = 0.894


def with_hazard(x: DataFrame) -> DataFrame:
    return x.withColumn("hazard", rules.hazard(F.col("cls"), F.col("area"), rules.evidence(F.col("source"), F.col("conf"), F.col("prob"), rules.model_skill(F.lit(AUC)))))


def with_priority(x: DataFrame) -> DataFrame:
    e = rules.exposure_index({k: F.col(k) for k in rules.EXPOSURE})
    return with_hazard(x).where("hazard > 0").withColumn("expo", e).withColumn("priority", F.round(rules.priority(F.col("hazard"), F.col("expo")), 6))


@query(f"WITH {_SITES}, {_HAZ}, {_PRI} SELECT id, round(hazard, 6) AS hazard, priority FROM p")
def hazard_priority(spark, d):
    return with_priority(site_frame(spark, d)).select("id", F.round("hazard", 6).alias("hazard"), "priority")


@query(f"""WITH {_SITES}, {_HAZ}, {_PRI}, c AS (SELECT * FROM p ORDER BY round(hazard, 6) DESC, id LIMIT 300), o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY priority DESC, id) AS own FROM c),
f AS (SELECT *, own <= CASE source WHEN 'change' THEN 30 WHEN 'ai' THEN 15 WHEN 'risk' THEN 5 END AS inq FROM o), t AS (SELECT * FROM f ORDER BY inq DESC, priority DESC, id LIMIT 50)
SELECT id, source, priority, row_number() OVER (ORDER BY priority DESC, id)::INT AS rank FROM t""")
def quota_topk(spark, d):
    c = sites.candidates(with_priority(site_frame(spark, d)).withColumn("hazard", F.round("hazard", 6)), "hazard", "id")
    return sites.quota_top(c, "priority", "id").select("id", "source", "priority", "rank")


@query(f"WITH {_SITES} SELECT id, round({_EXP}, 6) AS expo FROM s")
def exposure_index(spark, d):
    return site_frame(spark, d).select("id", F.round(rules.exposure_index({k: F.col(k) for k in rules.EXPOSURE}), 6).alias("expo"))


_LABEL = """CASE WHEN source = 'change' THEN (CASE WHEN conf IS NULL THEN 'Not assessed' WHEN conf >= 0.9 THEN 'High' WHEN conf >= 0.75 THEN 'Medium' ELSE 'Low' END)
  WHEN source = 'ai' AND conf IS NOT NULL THEN (CASE WHEN conf >= 0.9 AND coalesce(prob, 0) >= 0.5 THEN 'High' WHEN conf >= 0.8 THEN 'Medium' ELSE 'Low' END) WHEN source = 'risk' THEN 'Not validated' ELSE 'Unknown' END"""


def label_column():
    return rules.confidence_label(F.col("source"), F.col("conf"), F.col("conf"), F.col("prob"))


@query(f"WITH {_SITES} SELECT id, {_LABEL} AS confidence FROM s")
def confidence_labels(spark, d):
    return site_frame(spark, d).select("id", label_column().alias("confidence"))


_URG = f"""u AS (SELECT *, {_LABEL} AS confidence, {_EXP} AS expo, road_km > 0.2 OR embankment_km > 0.1 OR facilities > 0 AS assets, population >= 500 OR embankment_km > 0.1 OR retreat >= 50 AS urgent FROM s),
v AS (SELECT *, CASE WHEN starts_with(cls, 'Bank erosion') THEN (CASE WHEN urgent AND confidence IN ('High', 'Medium') THEN 'Immediate' WHEN urgent OR assets OR expo >= 0.4 THEN 'Before monsoon' ELSE 'Routine' END)
  WHEN starts_with(cls, 'Char') OR starts_with(cls, 'Accretion') THEN 'Monitor' WHEN starts_with(cls, 'Likely') THEN (CASE WHEN population >= 500 OR assets THEN 'Before monsoon' ELSE 'Routine' END)
  WHEN cls IN ('New inland water', 'Vegetation loss', 'New bare soil', 'High') THEN 'Routine' WHEN cls = 'Very high' THEN 'Before monsoon' ELSE 'Monitor' END AS urgency FROM u)"""


def urgency_frame(spark, d) -> DataFrame:
    x = site_frame(spark, d).withColumn("confidence", label_column()).withColumn("expo", rules.exposure_index({k: F.col(k) for k in rules.EXPOSURE}))
    return x.withColumn("urgency", rules.urgency(*[F.col(c) for c in ("cls", "population", "road_km", "embankment_km", "facilities", "retreat", "expo", "confidence")]))


@query(f"""WITH {_SITES}, {_URG} SELECT id, urgency, CASE WHEN starts_with(cls, 'Bank erosion') AND urgency <> 'Routine' OR starts_with(cls, 'Char') THEN 'Water Resources Dept' WHEN starts_with(cls, 'Accretion') THEN 'Revenue / Soil Conservation Dept'
  WHEN cls = 'New inland water' THEN 'Water Resources / Agriculture Dept' ELSE 'Soil Conservation Dept' END AS agency FROM v""")
def urgency_rules(spark, d):
    return urgency_frame(spark, d).select("id", "urgency", rules.lead_agency(F.col("cls"), F.col("urgency")).alias("agency"))


@query(f"""WITH {_SITES}, {_URG}, o(urgency, place) AS (VALUES ('Immediate', 0), ('Before monsoon', 1), ('Routine', 2), ('Monitor', 3), ('None', 4)), n AS (SELECT urgency, count(*) AS n FROM v GROUP BY ALL) SELECT urgency, place, coalesce(n, 0) AS n FROM o LEFT JOIN n USING (urgency)""")
def urgency_counts(spark, d):
    return sites.counted(urgency_frame(spark, d), "urgency", ["Immediate", "Before monsoon", "Routine", "Monitor", "None"])


_PLACES = "pl AS (SELECT s_name AS name, (s_suppkey * 197 % 20011)::DOUBLE AS px, (s_suppkey * 611 % 20023)::DOUBLE AS py FROM supplier)"
_POINTS = "pt AS (SELECT c_custkey AS pid, (c_custkey * 59 % 20011)::DOUBLE AS px, (c_custkey * 83 % 20023)::DOUBLE AS py, round(greatest(c_acctbal, 0) * 100)::BIGINT AS v FROM customer)"


def places(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(F.col("s_name").alias("name"), (k * 197 % 20011).cast("double").alias("px"), (k * 611 % 20023).cast("double").alias("py"))


def points(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("pid"), (k * 59 % 20011).cast("double").alias("px"), (k * 83 % 20023).cast("double").alias("py"), F.round(F.greatest("c_acctbal", F.lit(0.0)) * 100).cast("long").alias("v"))


_D2 = "(s.x - px) * (s.x - px) + (s.y - py) * (s.y - py)"


@query(f"WITH {_SITES}, {_PLACES}, r AS (SELECT id, name, {_D2} AS d2, row_number() OVER (PARTITION BY id ORDER BY {_D2}, name) AS n FROM s, pl) SELECT id, name, round(sqrt(d2), 6) AS distance FROM r WHERE n = 1")
def nearest_place(spark, d):
    return spatial.nearest(site_frame(spark, d).select("id", "x", "y"), places(spark, d), "id", "name").withColumn("distance", F.round("distance", 6))


@query(f"WITH {_SITES}, {_POINTS}, m AS (SELECT id, sum(v)::DOUBLE AS total, count(*) AS n FROM s JOIN pt ON {_D2} <= 250000 GROUP BY id) SELECT id, coalesce(total, 0) AS total, coalesce(n, 0) AS n FROM s LEFT JOIN m USING (id)")
def within_distance_sum(spark, d):
    return spatial.sum_within(site_frame(spark, d).select("id", "x", "y"), points(spark, d).withColumn("v", F.col("v").cast("double")), "id", "v", 500.0)


@query(f"WITH {_SITES}, {_POINTS}, n AS (SELECT pid, v FROM pt WHERE EXISTS (SELECT 1 FROM s WHERE cls LIKE 'Bank%' AND {_D2} <= 250000)) SELECT count(*) AS points, sum(v)::BIGINT AS total FROM n")
def people_near(spark, d):
    zone = site_frame(spark, d).where("cls like 'Bank%'").select("x", "y")
    return spatial.near_any(points(spark, d), zone, 500.0).agg(F.count(F.lit(1)).alias("points"), F.sum("v").alias("total"))


@query(f"WITH {_SITES}, {_PLACES}, r AS (SELECT id, name, {_D2} AS d2, rank() OVER (PARTITION BY id ORDER BY {_D2}) AS n FROM s JOIN pl ON {_D2} <= 9000000) SELECT id, name, round(sqrt(d2), 6) AS distance FROM r WHERE n = 1")
def bounded_nearest(spark, d):
    return spatial.bounded_nearest(site_frame(spark, d).select("id", "x", "y"), places(spark, d), "id", "name", 3000.0).withColumn("distance", F.round("distance", 6))


RING = [(1000.0, 1000.0), (18000.0, 2500.0), (15000.0, 17000.0), (9000.0, 8000.0), (2000.0, 16000.0)]
_EDGES = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(RING, RING[1:] + RING[:1], strict=True))


@query(f"""WITH {_SITES}, e(ax, ay, bx, b_y) AS (VALUES {_EDGES}), c AS (SELECT id, count(*) AS n FROM s JOIN e ON (ay > y) <> (b_y > y) AND x < (y - ay) * ((bx - ax) / (b_y - ay)) + ax GROUP BY id)
SELECT id, coalesce(n, 0) % 2 = 1 AS inside FROM s LEFT JOIN c USING (id)""")
def point_in_polygon(spark, d):
    return spatial.inside_polygon(site_frame(spark, d).select("id", "x", "y"), RING).select("id", "inside")


_FIELD = """st AS (SELECT 'S' || id AS site_id, split_part(cls, ' (', 1) AS site_class, x, y FROM s),
rc AS (SELECT c_custkey AS record_id, CASE WHEN c_custkey % 3 = 0 THEN 'S' || (c_custkey % 500) END AS claimed, CASE WHEN c_custkey % 19 <> 0 THEN (c_custkey * 59 % 20011)::DOUBLE END AS px, (c_custkey * 83 % 20023)::DOUBLE AS py,
  CASE c_custkey % 4 WHEN 0 THEN 'erosion_mainland' WHEN 1 THEN 'accretion' WHEN 2 THEN 'unsure' END AS ref, CASE c_custkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS seen, 'D' || lpad((c_custkey % 90)::VARCHAR, 2, '0') AS today FROM customer),
r2 AS (SELECT * FROM rc WHERE px IS NOT NULL), ex AS (SELECT site_id, record_id FROM r2 JOIN st ON claimed = site_id),
nr AS (SELECT site_id, record_id, row_number() OVER (PARTITION BY site_id ORDER BY (x - px) * (x - px) + (y - py) * (y - py), record_id) AS n FROM st JOIN r2 ON (x - px) * (x - px) + (y - py) * (y - py) <= 90000
  WHERE site_id NOT IN (SELECT site_id FROM ex) AND record_id NOT IN (SELECT record_id FROM ex)), mt AS (SELECT * FROM ex UNION ALL SELECT site_id, record_id FROM nr WHERE n = 1),
lt AS (SELECT site_id, count(*) AS visits, arg_max(record_id, today || lpad(record_id::VARCHAR, 12, '0')) AS record_id FROM mt JOIN rc USING (record_id) GROUP BY site_id),
vd AS (SELECT lt.site_id, visits, CASE WHEN site_class IN ('Bank erosion', 'Char or sandbar lost', 'Accretion', 'New inland water') AND coalesce(ref, '') NOT IN ('', 'unsure', 'nan')
  THEN (CASE WHEN site_class IN ('Bank erosion', 'Char or sandbar lost') AND ref = 'erosion_mainland' OR site_class = 'Accretion' AND ref = 'accretion' THEN 'Confirmed' ELSE 'Not confirmed' END)
  WHEN seen = 'yes' THEN 'Confirmed' WHEN seen = 'no' THEN 'Not confirmed' ELSE 'Unsure' END AS verdict FROM lt JOIN rc USING (record_id) JOIN st ON st.site_id = lt.site_id)"""


def field_frames(spark, d) -> tuple[DataFrame, DataFrame]:
    s = site_frame(spark, d).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("site_id"), rules.short_class(F.col("cls")).alias("site_class"), "x", "y")
    k = F.col("c_custkey")
    r = table(spark, d, "customer").select(
        k.alias("record_id"), F.when(k % 3 == 0, F.concat(F.lit("S"), (k % 500).cast("string"))).alias("claimed"), F.when(k % 19 != 0, (k * 59 % 20011).cast("double")).alias("px"), (k * 83 % 20023).cast("double").alias("py"),
        F.when(k % 4 == 0, "erosion_mainland").when(k % 4 == 1, "accretion").when(k % 4 == 2, "unsure").alias("reference_class"), F.when(k % 3 == 0, "yes").when(k % 3 == 1, "no").alias("erosion_present"), F.format_string("D%02d", k % 90).alias("today"),
    )
    return s, r


@query(f"WITH {_SITES}, {_FIELD} SELECT site_id, visits, verdict FROM vd")
def field_match(spark, d):
    s, r = field_frames(spark, d)
    return sites.field_status(s, r)


@query(f"WITH {_SITES}, {_FIELD} SELECT count(*) AS visited, count(*) FILTER (verdict = 'Confirmed') AS confirmed, count(*) FILTER (verdict = 'Not confirmed') AS not_confirmed, round(count(*) FILTER (verdict = 'Confirmed') / nullif(count(*) FILTER (verdict IN ('Confirmed', 'Not confirmed')), 0), 3) AS rate FROM vd")
def field_summary(spark, d):
    s, r = field_frames(spark, d)
    return sites.field_summary(sites.field_status(s, r))


_SAMPLE = """sm AS (SELECT lang AS stratum, quality, toxic FROM labels JOIN documents USING (doc_id)), sz AS (SELECT lang AS stratum, count(*) AS size FROM documents GROUP BY ALL), tt AS (SELECT sum(size)::DOUBLE AS total FROM sz)"""


def sample(spark, d) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", F.col("lang").alias("stratum"))
    return table(spark, d, "labels").join(docs, "doc_id"), docs.groupBy("stratum").agg(F.count(F.lit(1)).alias("size"))


@query(f"""WITH {_SAMPLE}, p AS (SELECT stratum, avg((quality = toxic)::INT) AS m, coalesce(var_samp((quality = toxic)::INT), 0) AS s2, count(*) AS n FROM sm GROUP BY ALL)
SELECT round(sum(size / total * m), 8) AS mean, round(sqrt(sum(size / total * size / total * s2 / n)), 8) AS se FROM p JOIN sz USING (stratum), tt""")
def stratified_accuracy(spark, d):
    s, z = sample(spark, d)
    return accuracy.stratified_mean(s, z, "stratum", (F.col("quality") == F.col("toxic")).cast("double")).select(F.round("mean", 8).alias("mean"), F.round("se", 8).alias("se"))


@query(f"""WITH {_SAMPLE}, p AS (SELECT stratum, avg(quality * toxic) AS my, avg(quality) AS mx, coalesce(var_samp(quality * toxic), 0) AS vy, coalesce(var_samp(quality), 0) AS vx, coalesce(covar_samp(quality * toxic, quality), 0) AS vxy, count(*) AS n FROM sm GROUP BY ALL),
w AS (SELECT *, size / total AS w FROM p JOIN sz USING (stratum), tt), a AS (SELECT sum(w * my) AS my, sum(w * mx) AS mx, sum(w * w * vy / n) AS vy, sum(w * w * vx / n) AS vx, sum(w * w * vxy / n) AS vxy FROM w)
SELECT round(my / mx, 8) AS ratio, round(sqrt(greatest(vy + my / mx * my / mx * vx - 2 * my / mx * vxy, 0)) / mx, 8) AS se FROM a""")
def ratio_estimator(spark, d):
    s, z = sample(spark, d)
    r = accuracy.ratio(s, z, "stratum", (F.col("quality") * F.col("toxic")).cast("double"), F.col("quality").cast("double"))
    return r.select(F.round("ratio", 8).alias("ratio"), F.round("se", 8).alias("se"))


@query(f"""WITH {_SAMPLE}, n AS (SELECT stratum, count(*) AS n FROM sm GROUP BY ALL), k AS (SELECT stratum, quality, toxic, count(*) AS k FROM sm GROUP BY ALL) SELECT quality, toxic, round(sum(size / total * k / n), 8) AS share FROM k JOIN n USING (stratum) JOIN sz USING (stratum), tt GROUP BY quality, toxic""")
def area_matrix(spark, d):
    s, z = sample(spark, d)
    return accuracy.area_matrix(s, z, "stratum", "quality", "toxic").withColumn("share", F.round("share", 8))


@query(f"""WITH {_SAMPLE}, c AS (SELECT stratum, count(*) FILTER (toxic = 1 AND quality = 1) AS tp, count(*) FILTER (toxic = 1 AND quality = 0) AS fp, count(*) FILTER (toxic = 0 AND quality = 1) AS fn, count(*) FILTER (toxic = 0 AND quality = 0) AS tn FROM sm GROUP BY ALL)
SELECT stratum, tp, fp, fn, tn, round((tp + tn) / nullif(tp + fp + fn + tn, 0), 8) AS accuracy, round(2 * tp / nullif(2 * tp + fp + fn, 0), 8) AS f1, round(tp / nullif(tp + fp + fn, 0), 8) AS iou, round(tp / nullif(tp + fp, 0), 8) AS users, round(tp / nullif(tp + fn, 0), 8) AS producers FROM c""")
def confusion_scores(spark, d):
    s, _ = sample(spark, d)
    c = accuracy.confusion(s.withColumn("p", F.col("toxic") == 1).withColumn("t", F.col("quality") == 1), ["stratum"], "p", "t")
    return c.select("stratum", "tp", "fp", "fn", "tn", *[F.round(k, 8).alias(k) for k in ("accuracy", "f1", "iou", "users", "producers")])


_SCORES = "sc AS (SELECT o_orderkey AS id, (o_orderkey * 31 % 997)::DOUBLE AS score, (CASE WHEN (o_orderkey * 31 % 997) + (o_orderkey % 400) > 900 THEN 1 ELSE 0 END) AS y FROM orders)"


def scores(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k.alias("id"), (k * 31 % 997).cast("double").alias("score"), F.when((k * 31 % 997) + (k % 400) > 900, 1).otherwise(0).alias("y"))


@query(f"WITH {_SCORES}, r AS (SELECT y, rank() OVER (ORDER BY score) AS a, count(*) OVER (PARTITION BY score) AS k FROM sc) SELECT round((sum(a + (k - 1) / 2) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 8) AS auc FROM r")
def roc_auc(spark, d):
    return stats.roc_auc(scores(spark, d), "score", "y").select(F.round("auc", 8).alias("auc"))


@query(f"WITH {_SCORES}, g AS (SELECT score, sum(y) AS p, count(*) AS k FROM sc GROUP BY score), c AS (SELECT p, sum(p) OVER w AS cp, sum(k) OVER w AS ck FROM g WINDOW w AS (ORDER BY score DESC)) SELECT round(sum(p * cp / ck) / sum(p), 8) AS average_precision FROM c")
def average_precision(spark, d):
    return stats.average_precision(scores(spark, d), "score", "y").select(F.round("average_precision", 8).alias("average_precision"))


@query(f"WITH {_SCORES}, t AS (SELECT y, row_number() OVER (ORDER BY score DESC, id) AS n, count(*) OVER () AS m FROM sc) SELECT round(sum(y) FILTER (n <= m * 10 // 100) / sum(y), 8) AS captured FROM t")
def captured_top_q(spark, d):
    return stats.captured(scores(spark, d), "score", "y", 10, "id").select(F.round("captured", 8).alias("captured"))


@query(f"WITH {_SCORES} SELECT round(avg((score / 997 - y) * (score / 997 - y)), 8) AS brier FROM sc")
def brier(spark, d):
    e = F.col("score") / 997 - F.col("y")
    return scores(spark, d).agg(F.round(F.avg(e * e), 8).alias("brier"))


@query("WITH r AS (SELECT rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2 AS a, rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2 AS b FROM part) SELECT count(*) AS n, round(corr(a, b), 8) AS rho FROM r")
def spearman(spark, d):
    p = table(spark, d, "part").select("p_size", "p_retailprice")
    return stats.spearman(p, "p_size", "p_retailprice").select("n", F.round("rho", 8).alias("rho"))


@query()
def bootstrap_ci(spark, d):
    s, _ = sample(spark, d)
    per = s.groupBy("stratum").agg(F.sum("quality").alias("q"), F.count(F.lit(1)).alias("n"))
    return stats.bootstrap(per, ["q", "n"], F.try_divide(F.col("q"), F.col("n")))


@query()
def stratified_sample(spark, d):
    s, _ = sample(spark, d)
    return stats.stratified_sample(s.select("doc_id", "stratum"), "stratum", "doc_id", 20)


@query("SELECT o_orderkey AS run, o_orderdate::DATE AS day, o_totalprice AS area, NULL::VARCHAR AS note FROM orders WHERE o_orderstatus <> 'O' UNION ALL SELECT o_orderkey, o_orderdate::DATE, o_totalprice + 1, 'new' FROM orders WHERE o_orderstatus = 'O'")
def history_upsert(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("run"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("area"), "o_orderstatus")
    new = o.where("o_orderstatus = 'O'").withColumn("area", F.col("area") + 1).withColumn("note", F.lit("new"))
    return sites.upsert(o.drop("o_orderstatus"), new.drop("o_orderstatus"), "run")


@query(f"WITH {_SITES} SELECT id, cls, conf, NULL::DOUBLE AS prob FROM s WHERE source = 'change' UNION ALL SELECT id, cls, NULL, prob FROM s WHERE source = 'ai' UNION ALL SELECT id, cls, NULL, NULL FROM s WHERE source = 'risk'")
def union_sites(spark, d):
    s = site_frame(spark, d)
    frames = [s.where(F.col("source") == k).select("id", "cls", *more) for k, more in (("change", ["conf"]), ("ai", ["prob"]), ("risk", []))]
    return frames[0].unionByName(frames[1], allowMissingColumns=True).unionByName(frames[2], allowMissingColumns=True)


_READ = "rd AS (SELECT event_id, user_id AS station, ts, value, epoch_us(ts) AS us FROM events)"


def readings(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.col("user_id").alias("station"), F.col("ts").cast("timestamp").alias("ts"), "value")


@query(f"WITH {_READ} SELECT event_id, station, round(sum(value) OVER (PARTITION BY station ORDER BY us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW), 4) AS total FROM rd")
def sliding_rain_24h(spark, d):
    return alerts.trailing_sum(readings(spark, d)).select("event_id", "station", F.round("total", 4).alias("total"))


_CHG = f"{_READ}, cg AS (SELECT *, value - last_value(value IGNORE NULLS) OVER (PARTITION BY station ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 21600000000 PRECEDING) AS change, sum(value) OVER (PARTITION BY station ORDER BY us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS total FROM rd)"


@query(f"WITH {_CHG} SELECT event_id, station, round(change, 4) AS change FROM cg")
def level_change_6h(spark, d):
    return alerts.lagged_change(readings(spark, d)).select("event_id", "station", F.round("change", 4).alias("change"))


@query(f"""WITH {_READ}, m AS (SELECT station, us, ts FROM rd WHERE event_id % 3 <> 0), o AS (SELECT * FROM rd WHERE event_id % 3 = 0)
SELECT o.event_id, o.station, coalesce((SELECT min(ts) FROM m WHERE m.station = o.station AND m.us >= o.us), (SELECT max(ts) FROM m WHERE m.station = o.station AND m.us < o.us)) AS main_ts FROM o""")
def tilt_asof(spark, d):
    r = readings(spark, d)
    return alerts.forward_asof(r.where("event_id % 3 <> 0"), r.where("event_id % 3 = 0")).select("event_id", "station", "main_ts")


@query(f"""WITH {_CHG}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY us DESC, event_id DESC) AS n FROM cg) WHERE n = 1),
a AS (SELECT *, (coalesce(total >= 64.5, false))::INT + (coalesce(change <= -0.5, false))::INT + (coalesce(value >= 100, false))::INT AS w, (coalesce(change >= 1.0, false))::INT AS c FROM l)
SELECT station, round(total, 4) AS rain, round(change, 4) AS change, value AS level, CASE WHEN w > 0 THEN 'warning' WHEN c > 0 THEN 'watch' ELSE 'normal' END AS status, (w + c)::INT AS n_alerts FROM a""")
def station_alerts(spark, d):
    return alerts.stations(readings(spark, d), F.lit(100.0)).withColumn("rain", F.round("rain", 4)).withColumn("change", F.round("change", 4))


@query("SELECT o_orderkey AS id, (o_orderdate::DATE - INTERVAL 120 DAY)::DATE AS start, (o_orderdate::DATE - to_years((year(o_orderdate) - 1996)::INT))::DATE AS baseline FROM orders")
def date_window_shift(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.date_sub(day, 120).alias("start"), rules.baseline_date(day, 1996).alias("baseline"))


@query(f"WITH {_SITES} SELECT id, strftime(day, '%y%m') || '-' || CASE WHEN id % 300 < 10 THEN '0' ELSE '' END || (id % 300)::VARCHAR AS site_id, split_part(cls, ' (', 1) AS short FROM s")
def site_ids(spark, d):
    return site_frame(spark, d).select("id", rules.site_id(F.col("day"), (F.col("id") % 300).cast("int")).alias("site_id"), rules.short_class(F.col("cls")).alias("short"))


@query("""WITH n AS (SELECT o_orderkey AS id, floor(o_totalprice * 37)::BIGINT AS v FROM orders), s AS (SELECT id, v::VARCHAR AS t FROM n)
SELECT id, CASE WHEN length(t) <= 3 THEN t WHEN length(t) <= 5 THEN left(t, length(t) - 3) || ',' || right(t, 3) WHEN length(t) <= 7 THEN left(t, length(t) - 5) || ',' || substr(t, length(t) - 4, 2) || ',' || right(t, 3)
  ELSE left(t, length(t) - 7) || ',' || substr(t, length(t) - 6, 2) || ',' || substr(t, length(t) - 4, 2) || ',' || right(t, 3) END AS grouped FROM s""")
def indian_grouping(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), rules.indian_grouping(F.floor(F.col("o_totalprice") * 37)).alias("grouped"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END || (o_orderkey % 90 + 10)::VARCHAR AS change, strftime(o_orderdate::DATE, '%d-%m-%Y') AS day, round(date_diff('day', o_orderdate::DATE, DATE '1999-01-01') / 365.25, 6) AS years FROM orders")
def report_texts(spark, d):
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    change = F.when(k % 2 == 0, k % 90 + 10).otherwise(-(k % 90 + 10))
    return table(spark, d, "orders").select(k.alias("id"), rules.signed(change).alias("change"), rules.day_first(day).alias("day"), F.round(rules.years_between(day, F.lit("1999-01-01").cast("date")), 6).alias("years"))


@query("""WITH n AS (SELECT o_orderkey AS id, 'dw_' || CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '' END || (o_orderkey % 180) || 'p' || (o_orderkey % 9) || '_' || (o_orderkey % 80) || 'p5-x' AS name FROM orders)
SELECT id, (CASE WHEN id % 2 = 0 THEN '-' ELSE '' END || (id % 180) || '.' || (id % 9))::DOUBLE AS lon, ((id % 80) || '.5')::DOUBLE AS lat, 'R' || (id % 99) AS tile, DATE '1970-01-01' + (id % 20000)::INT AS day FROM n""")
def tile_names(spark, d):
    k = F.col("o_orderkey")
    text = lambda x: x.cast("string")
    name = F.concat(F.lit("dw_"), F.when(k % 2 == 0, "-").otherwise(""), text(k % 180), F.lit("p"), text(k % 9), F.lit("_"), text(k % 80), F.lit("p5-x"))
    lon, lat = rules.tile_place(name)
    tile, day = rules.scene_key(F.concat(F.lit("S2A_X_TR"), text(k % 99)), (k % 20000) * 86_400_000 + 1000)
    return table(spark, d, "orders").select(k.alias("id"), lon.alias("lon"), lat.alias("lat"), tile.alias("tile"), day.alias("day"))


@query(f"WITH {_SITES} SELECT id, trim(regexp_replace(lower(split_part(cls, ' (', 1)), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM s")
def class_slugs(spark, d):
    return site_frame(spark, d).select("id", rules.slug(F.col("cls")).alias("slug"))


@query()
def utm_round_trip(spark, d):
    """Coordinates to UTM and back; the difference is under a millimetre."""
    k = F.col("o_orderkey")
    p = table(spark, d, "orders").select(k.alias("id"), (94.5 + (k % 100) / 100.0).alias("lon"), (27.0 + (k % 77) / 100.0).alias("lat"))
    e, n = to_utm(F.col("lon"), F.col("lat"))
    p = p.withColumn("e", e).withColumn("n", n)
    lon, lat = from_utm(F.col("e"), F.col("n"))
    mx, my = to_mercator(F.col("lon"), F.col("lat"))
    return p.select("id", "e", "n", (lon - F.col("lon")).alias("d_lon"), (lat - F.col("lat")).alias("d_lat"), mx.alias("mx"), my.alias("my"))
