"""What is at stake around sites, and the ranked list of sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvia.functions import rules
from fluvia.operators.regions import written
from fluvia.operators.sites import candidates, quota_top
from fluvia.operators.spatial import nearest, sums_by_key
from fluvia.operators.unmix import length_within

BUFFER = 500.0
POINTS, LINES = ("population", "built_ha", "crop_ha"), ("road_km", "embankment_km")


def site_exposure(sites: DataFrame, layers: dict[str, DataFrame], key: str = "id", d: float = BUFFER) -> DataFrame:
    """sites with a column for each layer that there is (NULL without), exposure_index, and the nearest place.

    layers: points (px, py, v) for population, built_ha and crop_ha (v times
    cell_ha where the points have it), segments (sid, x1, y1, x2, y2) for road_km
    and embankment_km, points for facilities, and places (name, px, py).
    """
    sites = written(sites)  # read by each layer's join
    own, out = sites.select(key, "x", "y"), sites
    for name in POINTS:
        if layers.get(name) is not None:
            p = layers[name]
            v = F.col("v") * F.coalesce(F.col("cell_ha"), F.lit(1.0)) if "cell_ha" in p.columns else F.col("v")
            got = sums_by_key(own, p.select("px", "py", v.cast("double").alias("v")), key, "v", d).select(key, F.round("total", 2 if name.endswith("_ha") else 0).alias(name), F.col("total").alias(f"_{name}"))
            out = out.join(got, key)
    for name in LINES:
        if layers.get(name) is not None:
            got = length_within(own, layers[name], key, d).select(key, F.round(F.col("length") / 1000, 2).alias(name), (F.col("length") / 1000).alias(f"_{name}"))
            out = out.join(got, key)
    if layers.get("facilities") is not None:
        n = sums_by_key(own, layers["facilities"].select("px", "py", F.lit(1.0).alias("v")), key, "v", d).select(key, F.col("n").cast("double").alias("facilities"))
        out = out.join(n, key, "left").withColumn("facilities", F.coalesce("facilities", F.lit(0.0))).withColumn("_facilities", F.col("facilities"))
    there = {k for k in rules.EXPOSURE if f"_{k}" in out.columns}
    index = rules.exposure_index({k: F.col(f"_{k}") for k in there}, there)
    out = out.withColumn("exposure_index", F.round(index, 3)).drop(*[f"_{k}" for k in there])
    for k in rules.EXPOSURE:
        if k not in there:
            out = out.withColumn(k, F.lit(None).cast("double"))
    if layers.get("places") is not None:
        near = nearest(own, layers["places"], key, "name").select(key, F.col("name").alias("nearest_place"), F.round(F.col("distance") / 1000, 1).alias("nearest_place_km"))
        out = out.join(near, key, "left")
    return out


def rank_sites(frames: dict[str, DataFrame], layers: dict[str, DataFrame], skill: Column | float = 1.0, n: int = 50, key: str = "id", floor: float = 0.3) -> DataFrame:
    """Sites of all sources (class, area_ha, x, y and, by source, confidence_score, model_agreement, mean_probability) from the most urgent, with scores, exposure, confidence and rank."""
    known = list(rules.HAZARD_WEIGHTS)
    every = None
    for source, df in frames.items():
        own = df.where(F.col("class").isin(known)).withColumn("source", F.lit(source))
        every = own if every is None else every.unionByName(own, allowMissingColumns=True)
    for c in ("confidence_score", "model_agreement", "mean_probability"):
        if c not in every.columns:
            every = every.withColumn(c, F.lit(None).cast("double"))
    e = rules.evidence(F.col("source"), F.col("confidence_score"), F.col("mean_probability"), skill)
    best = candidates(every.withColumn("hazard_score", rules.hazard(F.col("class"), F.col("area_ha"), e)), "hazard_score", key, n)
    exposed = site_exposure(best, layers, key)
    there = any(layers.get(k) is not None for k in rules.EXPOSURE)
    scored = exposed.withColumn("priority_score", rules.priority(F.col("hazard_score"), F.col("exposure_index"), floor, there))
    label = rules.confidence_label(F.col("source"), F.col("confidence_score"), F.col("model_agreement"), F.col("mean_probability"))
    top = quota_top(scored.withColumn("confidence", label), "priority_score", key, n=n)
    return top.withColumn("priority_score", F.round("priority_score", 3)).withColumn("hazard_score", F.round("hazard_score", 3)).withColumn("area_ha", F.round("area_ha", 2))


def recommended(sites: DataFrame, cls: str = "class", slope: str = "mean_slope_deg") -> DataFrame:
    """Adds urgency, lead_agency and recommended_action."""
    col = lambda c: F.col(c) if c in sites.columns else F.lit(None).cast("double")
    text = lambda c: F.col(c) if c in sites.columns else F.lit(None).cast("string")
    u = rules.urgency(F.col(cls), *[col(c) for c in ("population", "road_km", "embankment_km", "facilities", "retreat_m_per_yr", "exposure_index")], text("confidence"))
    return sites.withColumn("urgency", u).withColumn("lead_agency", rules.lead_agency(F.col(cls), F.col("urgency"))).withColumn("recommended_action", rules.recommended_action(F.col(cls), F.col("urgency"), col(slope)))


def key_figures(sites: DataFrame) -> DataFrame:
    """One row: sites, urgent ones, and the people near those."""
    now = F.col("urgency") == "Immediate"
    return sites.agg(F.count(F.lit(1)).alias("sites"), F.count_if(now).alias("immediate"), F.coalesce(F.sum(F.when(now, rules.number(F.col("population")))), F.lit(0.0)).alias("people_immediate"), F.round(F.sum("area_ha"), 1).alias("area_ha"))


def site_list(sites: DataFrame, end: Column, cls: str = "class", place: str = "nearest_place") -> DataFrame:
    """(name, label, lat, lon, rank, site_class, urgency, action) for field teams, with a row for a site that isn't listed, which has no rank."""
    short = rules.short_class(F.col(cls))
    near = F.when(F.length(F.col(place)) > 0, F.concat(F.lit(" near "), F.col(place))).otherwise("")
    label = F.concat(F.lit("#"), F.col("rank").cast("string"), F.lit(" "), short, near, F.format_string(" (%.4f, %.4f)", "lat", "lon"))
    own = sites.select(rules.site_id(end, F.col("rank").cast("int")).alias("name"), label.alias("label"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.col("rank").cast("long").alias("rank"), short.alias("site_class"), F.col("urgency"), F.col("recommended_action").alias("action"))
    new = sites.sparkSession.range(1).select(F.lit("NEW").alias("name"), F.lit("New site (not on the list)").alias("label"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("long").alias("rank"), F.lit("").alias("site_class"), F.lit("").alias("urgency"), F.lit("").alias("action"))
    return own.unionByName(new)
