"""Survey files, boundaries, site tables, run history, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the site table and of survey records.
SITE_SCHEMA = T.StructType([
    T.StructField("rank", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("site_id", "class", "source", "urgency", "lead_agency", "recommended_action", "confidence", "nearest_place", "field_status", "field_date", "field_visits")],
    *[T.StructField(c, T.DoubleType()) for c in ("area_ha", "footprint_ha", "p_value", "mean_soil_loss_t_ha_yr", "mean_slope_deg", "max_retreat_m", "retreat_m_per_yr", "mean_probability", "model_agreement", "confidence_score", "population", "built_ha", "crop_ha", "road_km", "embankment_km", "facilities", "nearest_place_km", "exposure_index", "hazard_score", "priority_score", "lat", "lon")],
])


def site_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of sites by header names; ids stay text, columns that the file lacks are NULL."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in SITE_SCHEMA])


def column_of(df: DataFrame, name: str) -> Column:
    """A survey column by its name or by the last part of a grouped one (group/name); NULL where there is none."""
    for c in df.columns:
        if c == name or c.replace(":", "/").rsplit("/", 1)[-1] == name:
            return F.col(f"`{c}`")
    return F.lit(None).cast("string")


def survey(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """Field records, all text, with lat and lon from their own columns or from "lat lon alt accuracy"."""
    if delimiter is None:
        head = spark.read.text(path).first()
        line = head[0] if head else ""
        delimiter = max(",;\t", key=line.count)
    raw = spark.read.option("header", True).option("sep", delimiter).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    parts = F.split(column_of(raw, "gps"), " ")
    names = ("site_id", "today", "officer", "erosion_present", "erosion_type", "severity", "reference_class", "map_agrees", "urgency", "households_at_risk", "retreat_m", "photo_1")
    lat, lon = (F.coalesce(column_of(raw, f"_gps_{n}").try_cast("double"), F.get(parts, F.lit(k)).try_cast("double")) for k, n in enumerate(("latitude", "longitude")))
    # a column that the file lacks, and an empty field, are empty text
    return raw.select(*[F.coalesce(column_of(raw, n), F.lit("")).alias(n) for n in names], lat.alias("lat"), lon.alias("lon"))


def boundary(spark: SparkSession, path: str) -> DataFrame:
    """(name, ring, place, lon, lat) of the outer rings of a GeoJSON file's polygons."""
    raw = spark.read.option("multiLine", True).text(path, wholetext=True)
    kind = "struct<features:array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>>"
    f = raw.select(F.explode(F.from_json("value", kind)["features"]).alias("f"))
    polygon = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    rings = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.get(polygon, 0))).otherwise(F.transform(many, lambda p: F.get(p, 0)))
    rows = f.select(F.lower(F.trim(F.col("f.properties")["shapeName"])).alias("name"), F.posexplode(rings).alias("ring", "points"))
    return rows.select("name", "ring", F.posexplode("points").alias("place", "p")).select("name", "ring", "place", F.get("p", F.lit(0)).alias("lon"), F.get("p", F.lit(1)).alias("lat"))


def area_of(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """(ring, place, lon, lat) of the places called ``name`` (trimmed, any case), all without one."""
    rings = boundary(spark, path)
    own = rings.where(F.col("name") == name.strip().lower()) if name else rings
    return own.drop("name")


def bounds(points: DataFrame, fallback: tuple[float, float, float, float] | None = None) -> tuple[float, ...] | None:
    """West, south, east, north to five decimals; the fallback where there are no points."""
    r = points.agg(F.min("lon"), F.min("lat"), F.max("lon"), F.max("lat")).first()
    return fallback if r[0] is None else tuple(round(v, 5) for v in r)


def scenes(catalogue: DataFrame, collection: str, box: tuple[float, float, float, float], start: str, end: str, cloud: float | None = None) -> DataFrame:
    """Scenes (collection, west, south, east, north, date, cloud) of a collection that meet a box and a span of days, under a share of cloud; the tests reach the scan."""
    west, south, east, north = box
    got = catalogue.where((F.col("collection") == collection) & (F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south))
    got = got.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return got if cloud is None else got.where(F.col("cloud") < cloud)


def layer(spark: SparkSession, path: str) -> DataFrame | None:
    """An optional Parquet layer; none where it is absent or has no rows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    df = spark.read.parquet(path)
    return None if df.isEmpty() else df


def zipped_tables(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> DataFrame:
    """Rows of the CSV members of zip files, with the member's name; each file is one task's."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(frames):
        import csv
        import io
        import zipfile

        import pandas as pd

        for frame in frames:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in sorted(n for n in z.namelist() if n.endswith(".csv")):
                        rows = list(csv.DictReader(io.StringIO(z.read(member).decode("utf-8-sig")), delimiter=delimiter))
                        yield pd.DataFrame({"member": [member] * len(rows)} | {n: [r.get(n) for r in rows] for n in names})

    text = ", ".join(f"{n} string" for n in names)
    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, f"member string, {text}")
    return raw.select("member", *[F.col(x.split()[0]).try_cast(x.split()[1]).alias(x.split()[0]) for x in schema.split(", ")])


def osm_lines(spark: SparkSession, path: str) -> DataFrame:
    """(id, type, place, lon, lat): the points of ways with geometry, in order."""
    kind = "struct<elements:array<struct<id:bigint,type:string,tags:map<string,string>,geometry:array<struct<lat:double,lon:double>>>>>"
    e = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)["elements"]).alias("e")).where("e.type = 'way' and size(e.geometry) > 1")
    tags = [F.col("e.tags")[t] for t in ("highway", "railway", "amenity", "place", "man_made", "embankment")]
    return e.select(F.col("e.id").alias("id"), F.coalesce(*tags).alias("type"), F.posexplode("e.geometry").alias("place", "p")).select("id", "type", "place", "p.lon", "p.lat")


def segments(points: DataFrame, key: str = "id", order: str = "place", x: str = "x", y: str = "y") -> DataFrame:
    """(sid, x1, y1, x2, y2) between the points of each line that follow each other."""
    w = Window.partitionBy(key).orderBy(order)
    s = points.select(F.xxhash64(key, order).alias("sid"), F.col(x).alias("x1"), F.col(y).alias("y1"), F.lead(x).over(w).alias("x2"), F.lead(y).over(w).alias("y2"))
    return s.where("x2 is not null")


def nested(rows: DataFrame, path: str) -> None:
    """Rows as JSON, one document a line."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(path)


def blind_sample(drawn: DataFrame, stratum: str) -> tuple[DataFrame, DataFrame]:
    """The sample as labellers see it, and the strata of its ids, kept apart."""
    return drawn.drop(stratum), drawn.select("id", stratum)


def depth_soil(layers: DataFrame, keys: list[str], thickness: dict[str, float], scale: dict[str, float]) -> DataFrame:
    """Thickness-weighted means (keys, prop) of soil properties (keys, prop, depth, v), in their units."""
    mean = depth_mean(layers, "depth", "v", thickness, [*keys, "prop"])
    factor = F.create_map(*[F.lit(x) for kv in scale.items() for x in kv])[F.col("prop")]
    return mean.withColumn("v", F.col("v") / F.coalesce(factor, F.lit(1.0)))


def osm_elements(spark: SparkSession, path: str) -> DataFrame:
    """(id, kind, name, type, lon, lat): the type is the first tag that there is."""
    kind = "struct<elements:array<struct<id:bigint,type:string,lat:double,lon:double,tags:map<string,string>>>>"
    e = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)["elements"]).alias("e"))
    tags = [F.col("e.tags")[t] for t in ("highway", "railway", "amenity", "place", "man_made", "embankment")]
    return e.select(F.col("e.id").alias("id"), F.col("e.type").alias("kind"), F.col("e.tags")["name"].alias("name"), F.coalesce(*tags).alias("type"), F.col("e.lon").alias("lon"), F.col("e.lat").alias("lat"))


def depth_mean(layers: DataFrame, depth: str, value: str, thickness: dict[str, float], keys: list[str]) -> DataFrame:
    """Thickness-weighted mean over the depths that have a value."""
    w = F.create_map(*[F.lit(x) for kv in thickness.items() for x in kv])[F.col(depth)]
    w = F.when(F.col(value).isNotNull(), w)
    return layers.groupBy(*keys).agg((F.sum(F.col(value) * w) / F.sum(w)).alias(value))


def annual_mean(days: DataFrame, keys: list[str], year: str, value: str, days_of_year: int = 365, share: float = 0.9) -> DataFrame:
    """Mean over years of annual sums; a year needs so many of its days."""
    sums = days.groupBy(*keys, year).agg(F.sum(value).alias("s"), F.count(value).alias("n")).where(F.col("n") >= share * days_of_year)
    return sums.groupBy(*keys).agg(F.avg("s").alias(value))


def scaled(x: Column, factor: float, low: int, high: int, missing: int) -> Column:
    """Integers for export: rounded, clipped, missing as a code."""
    held = F.least(F.greatest(F.round(x * factor), F.lit(low)), F.lit(high))  # these two pass NULL over
    return F.when(x.isNotNull(), held).otherwise(F.lit(missing)).cast("int")


def write_geojson(sites: DataFrame, path: str) -> None:
    """One feature a line."""
    props = F.struct(*[c for c in sites.columns if c not in ("lon", "lat")])
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    sites.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), props.alias("properties"))).alias("value")).write.text(path)


def cached(spark: SparkSession, path: str, needs: list[str], compute) -> DataFrame:
    """A Parquet table if it is there and has the columns, else computed and written."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        df = spark.read.parquet(path)
        if set(needs) <= set(df.columns):
            return df
    compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def channel_readings(feeds: DataFrame, fields: dict[str, tuple[str, int]]) -> DataFrame:
    """(station, event_id, ts, metric, setback, value) from wide feeds (station, event_id, ts, field1..): a row for each field that has a number."""
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(s).cast("int").alias("setback"), F.col(c).try_cast("double").alias("value")) for c, (m, s) in fields.items()])
    return feeds.select("station", "event_id", "ts", F.explode(each).alias("r")).select("station", "event_id", "ts", "r.*").where(F.col("value").isNotNull() & ~F.isnan("value"))


def simulated(spark: SparkSession, stations: DataFrame, start: str, hours: int, step_minutes: int = 15, seed: int = 42) -> DataFrame:
    """Readings (station, event_id, ts, metric, setback, value) that depend on station, time and seed only: a daily wave of the level, rain in some three-hour blocks, a slow tilt."""
    n = hours * 60 // step_minutes
    t = spark.range(n).withColumnRenamed("id", "k")
    x = stations.select("station").crossJoin(F.broadcast(t))  # a row for each reading to make
    x = x.withColumn("ts", F.timestamp_micros(F.unix_micros(F.lit(start).cast("timestamp")) + F.col("k") * step_minutes * 60_000_000))
    draw = lambda *key: F.pmod(F.xxhash64("station", *key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    block = F.floor(F.col("k") * step_minutes / 180)
    level = 5 + F.sin(F.col("k") * (step_minutes * 2 * 3.141592653589793 / 1440)) + 0.1 * draw("k")
    rain = F.when(draw(block, F.lit(1)) < 0.15, 3 * draw("k", F.lit(2))).otherwise(0.0)
    tilt = F.col("k") * step_minutes / 1440 * 0.05 + 0.02 * draw("k", F.lit(3))
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(s).cast("int").alias("setback"), v.alias("value")) for m, s, v in (("level_m", 0, level), ("rain_mm", 0, rain), ("tilt", 5, tilt), ("battery_v", 0, 3.7 + 0.3 * draw("k", F.lit(4))))])
    return x.select("station", "ts", "k", F.posexplode(each).alias("m", "r")).select("station", (F.col("k") * 4 + F.col("m")).alias("event_id"), "ts", "r.*")


def gathered_sources(readers: dict) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """What each reader gives; those that fail are told by name, the others go on."""
    got, failed = {}, {}
    for name, read in readers.items():
        try:
            got[name] = read()
        except Exception as e:  # one source must not stop the rest
            failed[name] = f"{type(e).__name__}: {e}".splitlines()[0]
    return got, failed
