"""Sums, nearest points and lengths by tiles: brute force's results, and no more rows dealt out than a few for each of the input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvia.operators import exposure, external, ml, sites, spatial, tiles, trees, unmix

N = 1200


def dealt(spark, df):
    """Rows that the stages of df write for shuffles."""
    sc, gateway = spark.sparkContext, spark.sparkContext._gateway

    def written():
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    sc._jsc.sc().listenerBus().waitUntilEmpty()
    before, rows = written(), df().collect()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    return written() - before, rows


def crowd(spark, x="x", y="y", key="id"):
    """Many rows within ten metres of one another."""
    k = F.col("id")
    return spark.range(N).select(k.alias(key), (k * 37 % 1009 / 101.0).alias(x), (k * 101 % 1013 / 102.0).alias(y))


def near(spark):
    p = crowd(spark, "px", "py", "pid")
    return p.withColumn("v", (F.col("pid") % 7).cast("double"))


def roads(spark):
    return crowd(spark, "x1", "y1", "sid").withColumn("x2", F.col("x1") + 700.0).withColumn("y2", F.col("y1") + 3.0)


def field(spark):
    s = crowd(spark).select(F.concat(F.lit("S"), F.col("id")).alias("site_id"), F.lit("Accretion").alias("site_class"), "x", "y")
    r = crowd(spark, "px", "py", "record_id").select("*", F.lit(None).cast("string").alias("claimed"), F.lit("accretion").alias("reference_class"), F.lit("yes").alias("erosion_present"), F.lit("D01").alias("today"))
    return s, r


CASES = {
    "F1 field_match": lambda s: sites.field_status(*field(s)),
    "F2 field_report": lambda s: sites.field_report(field(s)[1].withColumn("map_agrees", F.lit("yes")), field(s)[0]),
    "F3 site_exposure": lambda s: exposure.site_exposure(crowd(s), {"population": near(s), "road_km": roads(s), "facilities": near(s)}),
    "F4 road_length": lambda s: unmix.length_within(crowd(s), roads(s), "id", 500.0),
    "F5 bounded_nearest": lambda s: spatial.bounded_nearest(crowd(s), near(s), "id", "pid", 3000.0),
    "F6 field_by_type": lambda s: sites.field_by_type(field(s)[0], sites.field_status(*field(s))),
    "F7 field_summary": lambda s: sites.field_summary(sites.field_status(*field(s))),
    "F8 reach_rates": lambda s: external.reach_rates(near(s).withColumn("area_m2", F.col("v")), crowd(s, key="rid").withColumn("length_m", F.lit(100.0)), 6.0),
    "F9 within_distance_sum": lambda s: spatial.sum_within(crowd(s), near(s), "id", "v", 500.0),
}


@pytest.mark.parametrize("case", CASES)
def test_no_row_for_a_pair(spark, case):
    rows, got = dealt(spark, lambda: CASES[case](spark))
    assert got and 0 < rows < {"F9": 9, "F3": 60}.get(case[:2], 20) * N


@pytest.mark.parametrize("cut", [False, True])
def test_tiles_give_what_brute_force_gives(spark, monkeypatch, cut):
    if cut:
        monkeypatch.setattr(tiles, "SITES", 25), monkeypatch.setattr(tiles, "POINTS", 20), monkeypatch.setattr(tiles, "TASK", 50)
    rng, d = np.random.default_rng(5), 30.0
    xy, p, v = rng.integers(-150, 150, (300, 2)).astype(float), rng.integers(-150, 150, (200, 2)).astype(float), rng.normal(size=200)
    e = p + rng.normal(size=p.shape) * 20
    s = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(xy)] + [(900, None, 1.0), (901, float("nan"), 1.0), (902, 0.0, 0.0), (902, 9.0, 9.0)], "id int, x double, y double")
    xy = np.concatenate([xy, [(0.0, 0.0), (9.0, 9.0)]])
    keys = [*range(300), 902, 902]
    q = spark.createDataFrame([(k, *map(float, (*p[k], v[k], *e[k]))) for k in range(200)] + [(500, None, 0.0, 1.0, 0.0, 0.0)], "pid int, px double, py double, v double, x2 double, y2 double")
    d2 = ((xy[:, None] - p[None]) ** 2).sum(axis=2)
    inside = d2 <= d * d
    want = {k: (sum(float(v[i].sum()) for i, o in zip(inside, keys, strict=True) if o == k), sum(int(i.sum()) for i, o in zip(inside, keys, strict=True) if o == k)) for k in keys} | {900: (0.0, 0), 901: (0.0, 0)}
    got = spatial.sum_within(s, q, "id", "v", d).collect()
    assert len(got) == 304 and all(r.n == want[r.id][1] and abs(r.total - want[r.id][0]) < 1e-9 for r in got)
    ties = {(k, int(j)) for k, r in zip(keys[:300], d2, strict=False) for j in np.flatnonzero((r == r.min()) & (r <= d * d))}
    assert {(r.id, r.pid) for r in spatial.bounded_nearest(s.where("id < 300"), q, "id", "pid", d).collect()} == ties
    t = np.linspace(0, 1, 4001)[:, None, None]
    on = p + t * (e - p)
    share = [float((((on - c) ** 2).sum(axis=2) <= d * d).mean(axis=0) @ np.hypot(*(e - p).T)) for c in xy[:40]]
    lines = q.select(F.col("pid").alias("sid"), F.col("px").alias("x1"), F.col("py").alias("y1"), "x2", "y2")
    lengths = {r.id: r.length for r in unmix.length_within(s, lines, "id", d).collect()}
    assert len(lengths) == 303 and lengths[900] == 0 and all(abs(lengths[k] - w) < 0.2 for k, w in enumerate(share))


def test_scored_rows_are_dealt_out(spark, monkeypatch):
    """what is written has few files; its rows are scored by a task for each SCORED of them."""
    monkeypatch.setattr(ml, "SCORED", 100)
    rows = spark.range(900).coalesce(1).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"), (F.col("id") % 3).alias("block"), (F.col("id") % 7 > 3).cast("int").alias("label"))
    out = ml.cross_validated(rows, lambda: ml.Susceptibility(["v"], trees=2, rounds=2, sample=150), 3)
    assert out.rdd.getNumPartitions() == 9 and out.count() == 900


def test_rows_go_down_a_tree_together(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5000, 3))
    bins = trees.binned(x, trees.edges_of(x))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    tree = trees.grow(bins, y, np.ones(len(y)), 9, 5.0, 0.0, lambda m: np.ones((m, 3), bool))
    monkeypatch.setattr(trees, "CHUNK", 64)
    want = []
    for b in bins:
        at = 0
        while tree["feature"][at] >= 0:
            at = tree["child"][at] + int(b[tree["feature"][at]] > tree["cut"][at])
        want.append(tree["value"][at])
    assert trees.apply(tree, bins).tolist() == want
