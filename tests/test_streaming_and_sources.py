"""Alerts as a stream, and readers over files made here."""

import json
import time

from pyspark.sql import functions as F

from fluvia.sources import tables
from fluvia.streaming import alerts


def test_rain_alerts_stream(spark, tmp_path):
    rows = [(1, k, f"2024-01-01 {k:02d}:00:00", 10.0) for k in range(12)] + [(1, 3, "2024-01-01 03:00:00", 10.0), (2, 50, "2024-01-01 05:00:00", 1.0), (1, 99, "2024-01-05 00:00:00", 0.0)]
    src = tmp_path / "in"
    spark.createDataFrame(rows, "station long, event_id long, t string, value double").select("station", "event_id", F.to_timestamp("t").alias("ts"), "value").coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema("station long, event_id long, ts timestamp, value double").parquet(str(src))
    q = alerts.rain_alerts(stream).writeStream.format("memory").queryName("rain").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("rain").collect()
    assert got and {r.station for r in got} == {1} and max(r.rain for r in got) == 120.0


def test_silent_stations_stream(spark, tmp_path):
    src = tmp_path / "in"
    schema = "station long, event_id long, ts timestamp, value double"
    for k, rows in enumerate([[(1, 1, "2024-01-01 00:00:00"), (2, 2, "2024-01-01 00:00:00")], [(2, 3, "2024-01-01 09:00:00")], [(2, 4, "2024-01-01 18:00:00")]]):
        spark.createDataFrame(rows, "station long, event_id long, t string").select("station", "event_id", F.to_timestamp("t").alias("ts"), F.lit(1.0).alias("value")).coalesce(1).write.mode("append").parquet(str(src))
        time.sleep(1.1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = alerts.silent_stations(stream).writeStream.format("memory").queryName("silent").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert 1 in {r.station for r in spark.table("silent").collect()}


def test_survey_with_grouped_columns(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("grp/site_id;grp/today;gps;grp/erosion_present\n2611-01;2026-11-01;27.4 94.9 0 5;yes\n;2026-11-02;bad;no\n")
    got = tables.survey(spark, str(p)).collect()
    assert (got[0].site_id, got[0].lat, got[0].lon) == ("2611-01", 27.4, 94.9)
    assert got[1].lat is None and got[1].officer == "" and got[1].photo_1 == ""


def test_boundary_and_elements(spark, tmp_path):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    (tmp_path / "b.geojson").write_text(json.dumps({"features": [{"properties": {"shapeName": " Some Place "}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"properties": {"shapeName": "x"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]}))
    got = tables.boundary(spark, str(tmp_path / "b.geojson")).collect()
    assert len(got) == 12 and got[0].name == "some place" and {r.ring for r in got if r.name == "x"} == {0, 1}
    (tmp_path / "o.json").write_text(json.dumps({"elements": [{"id": 1, "type": "node", "lat": 1.0, "lon": 2.0, "tags": {"place": "village", "name": "n"}}]}))
    r = tables.osm_elements(spark, str(tmp_path / "o.json")).first()
    assert (r.id, r.name, r.type, r.lon) == (1, "n", "village", 2.0)


def test_site_table_keeps_ids_as_text(spark, tmp_path):
    (tmp_path / "h.csv").write_text("rank,site_id,class,area_ha\n1,2611-01,High,2.5\n2,2611-02,High,\n")
    got = tables.site_table(spark, str(tmp_path / "h.csv")).collect()
    assert got[0].site_id == "2611-01" and got[1].area_ha is None and got[0].p_value is None


def test_weighted_depths_and_years(spark):
    df = spark.createDataFrame([(1, "0-5cm", 10.0), (1, "5-15cm", 20.0), (1, "15-30cm", None)], "cell int, depth string, v double")
    assert tables.depth_mean(df, "depth", "v", {"0-5cm": 5, "5-15cm": 10, "15-30cm": 15}, ["cell"]).first().v == (10 * 5 + 20 * 10) / 15
    days = spark.createDataFrame([(1, 2020, 1.0)] * 365 + [(1, 2021, 9.0)] * 100, "cell int, year int, v double")
    assert tables.annual_mean(days, ["cell"], "year", "v").first().v == 365.0


def test_cached(spark, tmp_path):
    made = []

    def compute():
        made.append(1)
        return spark.range(3)

    path = f"file://{tmp_path}/c"
    for needs in (["id"], ["id"], ["other"]):
        assert tables.cached(spark, path, needs, compute).count() == 3
    assert len(made) == 2


def test_streamed_rain_is_as_the_batch_has_it(spark, tmp_path):
    """A total over the limit in a span that fits no full hour; a late and a repeated reading."""
    rows = [(1, 1, "2024-01-01 00:20:00", 30.0), (1, 2, "2024-01-01 23:50:00", 30.0), (1, 3, "2024-01-02 00:10:00", 10.0), (1, 2, "2024-01-01 23:50:00", 30.0), (1, 4, "2024-01-02 00:30:00", 1.0)]
    schema = "station long, event_id long, ts timestamp, value double"
    df = spark.createDataFrame(rows, "station long, event_id long, t string, value double").select("station", "event_id", F.to_timestamp("t").alias("ts"), "value")
    src = tmp_path / "in"
    df.coalesce(1).write.parquet(str(src))
    q = alerts.rain_alerts(spark.readStream.schema(schema).parquet(str(src))).writeStream.format("memory").queryName("rain24").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = alerts.trailing_sum(df.distinct()).where(F.col("total") >= alerts.RAIN_24H)
    assert sorted((r.until, r.rain) for r in spark.table("rain24").collect()) == sorted((r.ts, r.total) for r in batch.collect()) != []


def test_alert_rules_by_hand(spark):
    t = "2024-01-02 00:00:00"
    rows = [(1, "level_m", 0, "2024-01-01 12:00:00", 5.0), (1, "level_m", 0, t, 4.0), (1, "pore_kpa", 0, t, 60.0), (1, "soil_30", 0, t, 50.0), (1, "battery_v", 0, t, 3.4), (1, "rain_mm", 0, "2024-01-01 00:00:00", 99.0), (1, "rain_mm", 0, t, 70.0), (1, "tilt", 5, "2024-01-01 20:00:00", 1.0), (1, "tilt", 5, t, 4.5), (1, "tilt", 10, "2024-01-01 10:00:00", 12.0), (1, "tilt", 15, t, None), (1, "level_m", 0, "2024-01-02 00:30:00", None)]
    r = spark.createDataFrame([(*x, k) for k, x in enumerate(rows)], "station long, metric string, setback int, t string, value double, event_id long").withColumn("ts", F.to_timestamp("t"))
    st = spark.createDataFrame([(1, 9.0, None, [5, 10, 15]), (2, 9.0, None, [5])], "station long, level_warning_m double, piezo_tip_m double, setbacks array<int>")
    got = {(x.station, x.rule, x.setback): x.severity for x in alerts.evaluated(st, r, F.to_timestamp(F.lit("2024-01-02 01:00:00"))).collect()}
    assert got == {
        (1, "level_fall_6h", None): "warning", (1, "rain_24h", None): "warning", (1, "pore", None): "warning", (1, "soil_wet", None): "watch", (1, "battery_low", None): "info",
        (1, "tilt", 5): "warning", (1, "tilt", 10): "critical", (1, "tilt", 15): "warning", (2, "no_data", None): "warning",
    }
    status = {x.station: (x.status, x.n_alerts) for x in alerts.statuses(st, alerts.evaluated(st, r, F.to_timestamp(F.lit("2024-01-02 01:00:00")))).collect()}
    assert status == {1: ("critical", 8), 2: ("warning", 1)}


def test_more_sources(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("a/meta.csv", "id,v\n1,2.5\n2,\n")
        z.writestr("readme.txt", "no table")
    got = tables.zipped_tables(spark, str(tmp_path / "t.zip"), "id long, v double").collect()
    assert [(r.member, r.id, r.v) for r in got] == [("a/meta.csv", 1, 2.5), ("a/meta.csv", 2, None)]
    way = {"id": 7, "type": "way", "tags": {"highway": "track"}, "geometry": [{"lat": 1.0, "lon": 2.0}, {"lat": 1.0, "lon": 3.0}, {"lat": 2.0, "lon": 3.0}]}
    (tmp_path / "w.json").write_text(json.dumps({"elements": [way, {"id": 8, "type": "node"}]}))
    s = tables.segments(tables.osm_lines(spark, str(tmp_path / "w.json")), x="lon", y="lat").collect()
    assert sorted((r.x1, r.y1, r.x2, r.y2) for r in s) == [(2.0, 1.0, 3.0, 1.0), (3.0, 1.0, 3.0, 2.0)]
    ring = [[0.123456, 0.0], [1.0, 0.0], [1.0, 1.0], [0.123456, 0.0]]
    (tmp_path / "b.geojson").write_text(json.dumps({"features": [{"properties": {"shapeName": " Place "}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    area = tables.area_of(spark, str(tmp_path / "b.geojson"), "PLACE")
    assert tables.bounds(area) == (0.12346, 0.0, 1.0, 1.0) and tables.bounds(area.where("lon > 9"), (1.0, 2.0, 3.0, 4.0)) == (1.0, 2.0, 3.0, 4.0)
    path = f"file://{tmp_path}/layer"
    assert tables.layer(spark, path) is None
    spark.range(2).write.parquet(path)
    assert tables.layer(spark, path).count() == 2
    spark.range(0).write.mode("overwrite").parquet(path)
    assert tables.layer(spark, path) is None
    tables.nested(spark.range(2).selectExpr("id", "array(id, id + 1) AS a"), f"{tmp_path}/nested")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/nested").collect()) == ['{"id":0,"a":[0,1]}', '{"id":1,"a":[1,2]}']
    tables.write_geojson(spark.createDataFrame([(1, 94.0, 27.0)], "rank int, lon double, lat double"), f"{tmp_path}/geo")
    assert json.loads(spark.read.text(f"{tmp_path}/geo").first().value)["geometry"]["coordinates"] == [94.0, 27.0]
    blind, strata = tables.blind_sample(spark.createDataFrame([("P001", "a", 1)], "id string, stratum string, x int"), "stratum")
    assert blind.columns == ["id", "x"] and strata.columns == ["id", "stratum"]
    soil = spark.createDataFrame([(1, "sand", "0-5cm", 100.0), (1, "sand", "5-15cm", 400.0), (1, "soc", "0-5cm", 50.0)], "cell int, prop string, depth string, v double")
    assert {r.prop: r.v for r in tables.depth_soil(soil, ["cell"], {"0-5cm": 5, "5-15cm": 10}, {"sand": 10, "soc": 100}).collect()} == {"sand": 30.0, "soc": 0.5}
    assert spark.range(1).select(tables.scaled(F.lit(0.126), 100, 0, 100, 255), tables.scaled(F.lit(None), 100, 0, 100, 255), tables.scaled(F.lit(9.0), 100, 0, 100, 255)).first()[:] == (13, 255, 100)


def test_rasters_round_trip(spark, tmp_path):
    import numpy as np

    from fluvia.sources import rasters

    rng = np.random.default_rng(1)
    for kind in (np.float32, np.uint8, np.int16):
        a = (rng.random((2, 9, 7)) * 100).astype(kind)
        got, grid, none = rasters.bands_of(rasters.file_of(a, 100.0, 900.0, 20.0, -1.0))
        assert np.array_equal(got, a) and grid == (100.0, 900.0, 20.0) and none == -1.0
    cells = spark.createDataFrame([(r, c, float(r * 10 + c), None if c == 3 else 1.5) for r in range(5) for c in range(6)], "row int, col int, a double, b double")
    rasters.write_raster(cells, f"{tmp_path}/tiles", ["a", "b"], 0.0, 100.0, 10.0, tile=4)
    for t in spark.read.parquet(f"{tmp_path}/tiles").collect():
        (tmp_path / f"t{t.tile_row}{t.tile_col}.tif").write_bytes(bytes(t.content))
    back = rasters.raster(spark, f"{tmp_path}/*.tif", ["a", "b"]).collect()
    assert sorted((r.x, r.y, r.a, r.b or 0) for r in back) == sorted((c * 10 + 5.0, 95.0 - r * 10, float(r * 10 + c), 0 if c == 3 else 1.5) for r in range(5) for c in range(6))


def test_feeds_simulation_and_failing_sources(spark):
    feeds = spark.createDataFrame([(1, 1, "2024-01-01 00:00:00", "4.5", "bad"), (1, 2, "2024-01-01 00:15:00", None, "0.25")], "station long, event_id long, t string, field1 string, field2 string").withColumn("ts", F.to_timestamp("t"))
    got = tables.channel_readings(feeds, {"field1": ("level_m", 0), "field2": ("tilt", 5)}).collect()
    assert sorted((r.event_id, r.metric, r.setback, r.value) for r in got) == [(1, "level_m", 0, 4.5), (2, "tilt", 5, 0.25)]
    st = spark.createDataFrame([(1,), (2,)], "station long")
    one, two = (tables.simulated(spark, s, "2024-01-01 00:00:00", 24) for s in (st, st.repartition(5)))
    assert one.count() == 2 * 96 * 4 and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    ok, failed = tables.gathered_sources({"a": lambda: spark.range(1), "b": lambda: 1 / 0})
    assert set(ok) == {"a"} and failed == {"b": "ZeroDivisionError: division by zero"}
