"""Operators on small grids and rows, against brute force and known values."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvia.functions import rules, special, spectral
from fluvia.functions.coordinates import from_utm, to_utm
from fluvia.operators import composite, focal, regions, spatial, stats, threshold
from fluvia.plans import all_queries

RNG = np.random.default_rng(5)


def grid(spark, a, name="cls"):
    rows = [(int(r), int(c), a[r, c].item()) for r in range(a.shape[0]) for c in range(a.shape[1])]
    return spark.createDataFrame(rows, f"row int, col int, {name} {'int' if a.dtype.kind in 'ib' else 'double'}")


def labels_of(a):
    out, n = -np.ones(a.shape, int), 0
    for r, c in itertools.product(*map(range, a.shape)):
        if out[r, c] < 0:
            stack = [(r, c)]
            while stack:
                i, j = stack.pop()
                if 0 <= i < a.shape[0] and 0 <= j < a.shape[1] and out[i, j] < 0 and a[i, j] == a[r, c]:
                    out[i, j] = n
                    stack += [(i + x, j + y) for x in (-1, 0, 1) for y in (-1, 0, 1)]
            n += 1
    return out


@pytest.mark.parametrize("tile", [3, 5, 64])
def test_components_whatever_the_tiles(spark, tile):
    a = RNG.integers(0, 2, (14, 17))
    got = {(r.row, r.col): r.region for r in regions.components(grid(spark, a), tile).collect()}
    want = labels_of(a)
    first = {}
    for (r, c), k in np.ndenumerate(want):
        first.setdefault(k, r * 2**31 + c)
    assert got == {(r, c): first[k] for (r, c), k in np.ndenumerate(want)}


def test_components_of_line_spiral_and_nothing(spark):
    line = spark.createDataFrame([(0, c) for c in range(40)], "row int, col int")
    assert regions.components(line, 4).select("region").distinct().count() == 1
    assert regions.components(line.where("col < 0"), 4).count() == 0
    two = spark.createDataFrame([(0, 0), (1, 1), (3, 3)], "row int, col int")  # diagonal neighbours are one region
    assert regions.components(two, 2).select("region").distinct().count() == 2


def test_sieve_takes_the_largest_neighbour(spark):
    a = np.zeros((6, 9), int)
    a[:, 3:] = 1
    a[2, 2] = 2  # touches both; the class 1 side is larger
    got = {(r.row, r.col): r.cls for r in regions.sieve(grid(spark, a), 2).collect()}
    assert got[2, 2] == 1 and got[0, 0] == 0 and len(got) == a.size


def test_dilation_and_erosion(spark):
    a = RNG.random((12, 12)) < 0.5
    mask = grid(spark, a.astype(int)).where("cls = 1")
    for cross in (True, False):
        steps = focal.offsets(2, cross)
        at = lambda r, c: 0 <= r < 12 and 0 <= c < 12 and bool(a[r, c])
        want = {(r, c) for r in range(-2, 14) for c in range(-2, 14) if any(at(r + x, c + y) for x, y in steps)}
        assert {tuple(x) for x in focal.dilate(mask, 2, cross).collect()} == want
        kept = {(r, c) for r in range(12) for c in range(12) if all(at(r + x, c + y) for x, y in steps)}
        assert {tuple(x) for x in focal.erode(mask, 2, cross).collect()} == kept


def test_box_mean_repeats_the_edge(spark):
    a = RNG.random((7, 5))
    p = np.pad(a, 2, mode="edge")
    got = {(r.row, r.col): r.box_mean for r in focal.box_mean(grid(spark, a, "v"), "v", 5, 7, 5).collect()}
    assert all(abs(got[r, c] - p[r : r + 5, c : c + 5].mean()) < 1e-12 for r in range(7) for c in range(5))


def test_distance_is_exact_within_reach(spark):
    a = RNG.random((15, 15)) < 0.06
    cells = grid(spark, a.astype(int))
    got = {(r.row, r.col): r.distance for r in regions.distance_to(cells, cells.where("cls = 1"), 10.0, 4).collect()}
    on = np.argwhere(a)
    for r, c in itertools.product(range(15), range(15)):
        d = min((math.hypot(r - x, c - y) for x, y in on), default=99)
        assert got[r, c] is None if d > 4 else abs(got[r, c] - 10 * d) < 1e-9


def test_distance_without_reach_is_whole(spark):
    a = RNG.random((40, 33)) < 0.01
    a[:3, :4] = a[-1, -1] = True
    a[10:39] = False
    cells = grid(spark, a.astype(int))
    on = np.argwhere(a)
    got = {(r.row, r.col): r.distance for r in regions.distance_to(cells, cells.where("cls = 1"), 10.0).collect()}
    want = {(r, c): 10 * min(math.hypot(r - x, c - y) for x, y in on) for r, c in itertools.product(range(40), range(33))}
    assert got.keys() == want.keys() and max(want.values()) > 100
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {r.distance for r in regions.distance_to(cells, cells.where("cls = 7"), 10.0).collect()} == {None}
    assert regions.distance_to(cells.where("cls = 7"), cells, 10.0).count() == 0


def test_retreat_distance_has_no_bound(spark, tmp_path):
    """Water in one corner of a grid that is more than 100 m wide."""
    day = "1998-07-01"
    rows = [(k, day, 1, 1, 1.0, 1.0, 0.10 if k == 0 else 0.0, 0.0, "F") for k in range(20) for _ in range(2)]
    cols = "l_partkey long, l_shipdate string, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_linestatus string"
    spark.createDataFrame(rows, cols).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.col: r.distance for r in all_queries()["retreat_distance"](spark, str(tmp_path)).collect()}
    assert got == {k: 20.0 * k for k in range(1, 20)}


def test_ml_scores_registers_whole_models(spark, sf, monkeypatch):
    from fluvia.operators import ml

    seen = {}
    monkeypatch.setattr(ml, "cross_validated", lambda rows, make, blocks: seen.update(model=make(), blocks=blocks) or rows)
    rows = all_queries()["ml_scores"](spark, sf)
    assert (seen["model"].trees, seen["model"].rounds, seen["blocks"]) == (300, 400, 6)
    assert {r.block for r in rows.select("block").distinct().collect()} == set(range(6))


def test_blocks_score_every_row_by_the_others(spark):
    from fluvia.operators import ml

    rows = spark.createDataFrame([(k, float(k % 7), k % 3, int(k % 7 > 3)) for k in range(900)] + [(1000, 1.0, 3, 0)], "k int, v double, block int, label int")
    out = ml.cross_validated(rows, lambda: ml.Susceptibility(["v"], trees=5, rounds=30), 4).collect()
    assert sorted(r.k for r in out) == [*range(900), 1000]
    assert all((r.probability > 0.5) == (r.label == 1) for r in out)
    one_kind = ml.cross_validated(rows.where("label = 0"), lambda: ml.Susceptibility(["v"], trees=2, rounds=2), 4).collect()
    assert {r.probability for r in one_kind} == {0.0}


def test_susceptibility_learns_and_agrees_with_itself(spark):
    from fluvia.operators import ml

    x = RNG.normal(size=(1500, 3))
    rows = spark.createDataFrame([(*map(float, v), int(v[0] + v[1] * v[1] > 0.8)) for v in x] + [(None, float("nan"), 0.0, 0)], "a double, b double, c double, label int")
    fitted = ml.Susceptibility(["a", "b", "c"], trees=40, rounds=80).fit(rows)
    got = fitted.transform(rows).collect()
    assert sum((r.probability > 0.5) == (r.label == 1) for r in got) > 0.93 * len(got)
    assert all(abs(r.agreement) <= 1 and r["class"] in (1, 2, 3, 4, 5) for r in got)
    names = [k for k, _ in fitted.importance()]
    assert set(names[:2]) == {"a", "b"} and abs(sum(v for _, v in fitted.importance()) - 1) < 1e-6
    assert not ml.learnable(rows) and ml.learnable(rows, positive=10, least=100)
    assert ml.drawn(rows.withColumn("k", F.xxhash64("a", "b")), "k", 7).count() == 7


def test_trees_split_where_the_gain_is():
    from fluvia.operators import trees

    x = np.array([[0.0, 5], [1, 5], [2, 5], [10, 5], [11, 5], [12, 5]])
    y = np.array([0.0, 0, 0, 1, 1, 1])
    t = trees.grow(trees.binned(x, trees.edges_of(x)), y, np.ones(6), 3, 1.0, 0.0, lambda m: np.ones((m, 2), bool))
    assert t["feature"][0] == 0 and trees.apply(t, trees.binned(x, trees.edges_of(x))).tolist() == y.tolist()


def test_otsu_splits_two_heaps(spark):
    v = np.concatenate([RNG.normal(0, 1, 300), RNG.normal(10, 1, 300)]).reshape(20, 30)
    t = threshold.otsu(grid(spark, v, "v"), "v").first().threshold
    assert 2 < t < 8
    assert threshold.edge_otsu(grid(spark, v, "v"), "v", 5.0, least=10**6).first().threshold == 5.0


def test_classes_are_half_open(spark):
    df = spark.createDataFrame([(5.0,), (5.1,), (None,), (40.0,), (41.0,)], "x double")
    assert [r[0] for r in df.select(spectral.classify(F.col("x"), (5, 10, 20, 40))).collect()] == [1, 2, None, 4, 5]


def test_missing_never_counts(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (None, 1.0), (0.0, 0.0), (3.0, 1.0)], "a double, b double")
    a = spectral.known(F.col("a"))
    assert [r[0] for r in df.select(spectral.normalized_difference(a, F.col("b"))).collect()] == [None, None, None, 0.5]


def test_tails(spark):
    df = spark.createDataFrame([(2.0, 10.0), (-2.0, 10.0), (0.0, 3.5), (40.0, 5.0)], "t double, df double")
    got = [r[0] for r in df.select(special.student_upper("t", "df")).collect()]
    assert got == pytest.approx([0.03669401738537018, 0.9633059826146299, 0.5, 9.2e-08], rel=0.02)
    z = spark.createDataFrame([(1.959963984540054,), (0.0,)], "z double").select(special.normal_upper("z")).collect()
    assert [r[0] for r in z] == pytest.approx([0.025, 0.5])
    back = spark.createDataFrame([(0.025,), (1e-320,), (1.0,)], "p double").select(special.normal_quantile_upper("p")).collect()
    assert back[0][0] == pytest.approx(1.95996, abs=1e-4) and back[1][0] == 40 and back[2][0] < -8
    # k = 7 of n = 10: 1 - I_0.5(8, 4)
    conf = spark.createDataFrame([(7, 10), (0, 0)], "k int, n int").select(special.label_confidence(F.col("k"), F.col("n"))).collect()
    want = 1 - sum(math.comb(11, j) for j in range(8, 12)) / 2**11
    assert conf[0][0] == pytest.approx(want) and conf[1][0] is None


def test_fisher_against_enumeration(spark):
    def upper(ka, na, kb, nb):
        t, g = na + nb, ka + kb
        return sum(math.comb(g, j) * math.comb(t - g, nb - j) for j in range(kb, min(g, nb) + 1)) / math.comb(t, nb)

    rows = [(a, 5, b, 7) for a in range(6) for b in range(8)]
    df = spark.createDataFrame(rows, "ka int, na int, kb int, nb int")
    got = df.select("*", stats.fisher(*[F.col(c) for c in ("ka", "na", "kb", "nb")])["p_up"].alias("p")).collect()
    assert all(r.p == pytest.approx(min(1.0, upper(r.ka, r.na, r.kb, r.nb)), abs=1e-9) for r in got)


@pytest.mark.parametrize("p", [[0.2] * 6, [0.9, 0.8], [0.001, 0.002], [0.01, 0.02, 0.02, 0.03, 0.5, 0.9, None], []])
def test_false_discovery_control(spark, p):
    known = sorted(x for x in p if x is not None)
    cut = max((x for k, x in enumerate(known, 1) if x * len(known) <= 0.05 * max(j for j, y in enumerate(known, 1) if y == x)), default=-1)
    df = spark.createDataFrame([(x,) for x in p], "p double")
    got = stats.benjamini_hochberg(df, "p").collect()
    assert all(r.rejected == (r.p is not None and r.p <= cut) for r in got) and len(got) == len(p)


def test_points_within(spark):
    s = [(k, float(RNG.integers(0, 100)), float(RNG.integers(0, 100))) for k in range(40)]
    p = [(k, float(RNG.integers(0, 100)), float(RNG.integers(0, 100)), 1.0) for k in range(60)]
    sites, pts = spark.createDataFrame(s, "id int, x double, y double"), spark.createDataFrame(p, "pid int, px double, py double, v double")
    got = {r.id: r.n for r in spatial.sum_within(sites, pts, "id", "v", 13.0).collect()}
    assert got == {k: sum(math.hypot(x - a, y - b) <= 13 for _, a, b, _ in p) for k, x, y in s}
    near = {r.id: (r.pid, round(r.distance, 9)) for r in spatial.nearest(sites, pts.select("pid", "px", "py"), "id", "pid").collect()}
    assert near == {k: min(((math.hypot(x - a, y - b), j) for j, a, b, _ in p))[::-1] and (min((math.hypot(x - a, y - b), j) for j, a, b, _ in p)[1], round(min(math.hypot(x - a, y - b) for _, a, b, _ in p), 9)) for k, x, y in s}


def test_coordinates_go_there_and_back(spark):
    df = spark.createDataFrame([(94.9, 27.47), (93.0, 27.0)], "lon double, lat double")
    e, n = to_utm(F.col("lon"), F.col("lat"))
    df = df.withColumn("e", e).withColumn("n", n)
    lon, lat = from_utm(F.col("e"), F.col("n"))
    for r in df.select("lon", "lat", "e", lon.alias("a"), lat.alias("b")).collect():
        assert r.a == pytest.approx(r.lon, abs=1e-8) and r.b == pytest.approx(r.lat, abs=1e-8)
    assert df.where("lon = 93").first().e == pytest.approx(500000)


def test_labels_of_sites(spark):
    df = spark.createDataFrame([("Bank erosion (land to water)", 600, "High"), ("Bank erosion (land to water)", None, "Low"), ("Very high", None, None), (None, None, None)], "cls string, people int, conf string")
    zero = F.lit(None).cast("double")
    got = df.select(rules.urgency(F.col("cls"), F.col("people"), zero, zero, zero, zero, zero, F.col("conf"))).collect()
    assert [r[0] for r in got] == ["Immediate", "Routine", "Before monsoon", "Monitor"]
    ids = spark.sql("select date'2026-11-05' d, 7 r union all select date'2026-11-05', 123").select(rules.site_id(F.col("d"), F.col("r"), "S")).collect()
    assert [r[0] for r in ids] == ["S2611-07", "S2611-123"]
    n = spark.createDataFrame([(1234567,), (-12,), (1000,)], "x long").select(rules.indian_grouping(F.col("x"))).collect()
    assert [r[0] for r in n] == ["12,34,567", "-12", "1,000"]
    leap = spark.sql("select date'2024-02-29' d").select(rules.baseline_date(F.col("d"), 2021)).first()[0]
    assert str(leap) == "2021-02-28"


def test_split_halves_of_one_window_show_no_change(spark, sf):
    from fluvia.plans.maps import null_test

    r = null_test(spark, sf).first()
    assert r.tested > 100 and r.rejected <= 0.02 * r.tested


def test_odd_and_even_dates_are_of_the_whole_cube(spark):
    rows = [(0, 0, "2020-01-01", 1.0), (0, 1, "2020-01-02", 2.0), (0, 0, "2020-01-03", 3.0)]
    df = spark.createDataFrame(rows, "row int, col int, date string, v double")
    got = {(r.col, r.subset): r.n for r in composite.subset_statistics(df, "v").collect()}
    assert got == {(0, "all"): 2, (0, "odd"): 2, (1, "all"): 1, (1, "even"): 1}


def test_contour_crosses_between_cells(spark):
    from fluvia.operators import unmix

    a = np.array([[0.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 0.0]])
    lines = unmix.contour(grid(spark, a, "v"), "v")
    got = lines.collect()
    assert len(got) == 4  # a diamond around the middle
    assert sum(math.hypot(r.x2 - r.x1, r.y2 - r.y1) for r in got) == pytest.approx(4 * math.hypot(0.5, 0.5))
    saddle = unmix.contour(grid(spark, np.array([[1.0, 0.0], [0.0, 1.0]]), "v"), "v").collect()
    assert len(saddle) == 2


def test_length_in_circle(spark):
    from fluvia.operators import unmix

    sites = spark.createDataFrame([(1, 0.0, 0.0), (2, 500.0, 500.0)], "id int, x double, y double")
    lines = spark.createDataFrame([(1, -50.0, 0.0, 50.0, 0.0), (2, 0.0, 6.0, 100.0, 6.0), (3, 3.0, 3.0, 3.0, 3.0)], "sid int, x1 double, y1 double, x2 double, y2 double")
    got = {r.id: r.length for r in unmix.length_within(sites, lines, "id", 10.0).collect()}
    assert got == {1: pytest.approx(20 + 8), 2: 0.0}


def test_fraction_and_blocks(spark):
    from fluvia.operators import ml, unmix

    df = spark.createDataFrame([(0.5, 1.0, 0.0), (2.0, 1.0, 0.0), (0.5, 0.5, 0.5)], "b double, w double, l double")
    assert [r[0] for r in df.select(unmix.fraction([F.col("b")], [F.col("w")], [F.col("l")])).collect()] == [0.5, 1.0, None]
    rows = spark.createDataFrame([(float(k), 2.0 * k) for k in range(90)], "x double, y double")
    assert sorted(r.n for r in ml.spatial_blocks(rows, 3).groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()) == [30, 30, 30]


def test_nearest_place_without_rows_far_away_and_without_coordinates(spark):
    sites = spark.createDataFrame([(1, 0.0, 0.0), (2, 5e6, 5e6), (3, None, 1.0), (4, 10.0, 0.0)], "id int, x double, y double")
    places = spark.createDataFrame([("b", 5.0, 0.0), ("a", -5.0, 0.0), ("c", 5.0, 0.0), ("d", None, 0.0)], "name string, px double, py double")
    got = {r.id: (r.name, r.distance) for r in spatial.nearest(sites, places, "id", "name").collect()}
    assert got == {1: ("a", 5.0), 2: ("b", math.hypot(5e6 - 5, 5e6)), 4: ("b", 5.0)}
    assert spatial.nearest(sites, places.limit(0), "id", "name").collect() == []
    assert spatial.nearest(sites.limit(0), places, "id", "name").collect() == []


def test_quantiles_and_running_sums(spark):
    v = RNG.normal(size=501).round(1)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double").repartition(7)
    shares = (0.0, 0.01, 0.5, 0.98, 1.0)
    assert np.allclose(stats.quantiles(df, "v", shares), np.quantile(v, shares))
    assert stats.quantiles(df.where("v > 99"), "v", (0.5,)) == [None]
    rows, total = stats.running(df.where("v is not null").withColumn("one", F.lit(1)), [F.col("v")], {"r": "one"})
    assert total["r"] == 501 and sorted(r.r for r in rows.collect()) == list(range(1, 502))
    plan = rows._jdf.queryExecution().toString()
    assert "_part" in plan  # windows are by ranges, not over the table


def test_no_window_without_partition(spark, sf):
    for name in ("roc_auc", "average_precision", "captured_top_q", "spearman", "bh_fdr"):
        plan = all_queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in "".join(x for x in plan.splitlines() if "Window" in x)


def test_spearman_p(spark):
    x = RNG.normal(size=60)
    df = spark.createDataFrame([(float(a), float(a + b)) for a, b in zip(x, RNG.normal(size=60) * 3, strict=True)], "x double, y double")
    r = stats.spearman_test(df, "x", "y").first()
    t = abs(r.rho) * math.sqrt(58 / (1 - r.rho**2))
    # numeric integral of Student's density
    u = np.linspace(t, 60, 400001)
    density = math.gamma(59 / 2) / (math.sqrt(58 * math.pi) * math.gamma(29)) * (1 + u * u / 58) ** (-59 / 2)
    assert r.p == pytest.approx(2 * float(((density[1:] + density[:-1]) / 2 * np.diff(u)).sum()), abs=1e-5)
    assert stats.spearman_test(df.withColumn("y", F.col("x")), "x", "y").first().p == 0.0


def test_bootstrap_of_equal_rows_and_differences(spark):
    """Equal rows draw for themselves: the interval of 200 equal groups of each kind is that of 200 draws."""
    groups = spark.createDataFrame([(1, 0, 1)] * 200 + [(0, 1, 1)] * 200, "a int, b int, n int")
    r = stats.bootstrap(groups, ["a", "n"], F.col("a") / F.col("n"), 400).first()
    assert 0.44 < r.low < 0.48 and 0.52 < r.high < 0.56
    d = stats.bootstrap_difference(groups, ["a", "b", "n"], F.col("a") / F.col("n"), F.col("b") / F.col("n"), 400).first()
    assert abs(d.mean) < 0.02 and d.low < 0 < d.high and 0.3 < d.share_positive < 0.7


def test_nearest_with_one_place_far_away(spark):
    places = [(f"p{k:03d}", float(k % 20), float(k // 20)) for k in range(400)] + [("far", 1e9, 1e9), ("twin", 3.0, 4.0)]
    sites = [(k, float(x), float(y)) for k, (x, y) in enumerate(RNG.uniform(0, 20, (300, 2)))] + [(900, 9e8, 9e8), (901, None, 1.0)]
    got = {r.id: (r.name, r.distance) for r in spatial.nearest(spark.createDataFrame(sites, "id int, x double, y double"), spark.createDataFrame(places, "name string, px double, py double"), "id", "name").collect()}
    for k, x, y in sites[:-1]:
        d, name = min((math.hypot(x - a, y - b), n) for n, a, b in places)
        assert got[k][0] == name and got[k][1] == pytest.approx(d)
    assert 901 not in got


def test_ranking_rules_by_hand(spark):
    """Quotas 30, 15, 5; evidence 1 without a probability; priority is the hazard without layers; infinity is 0."""
    from fluvia.operators import exposure

    assert rules.QUOTAS == {"change": 30, "ai": 15, "risk": 5}
    df = spark.createDataFrame([("change", None, 0.2), ("change", 0.7, None), ("ai", 0.9, None), ("ai", None, 0.25), ("risk", 0.1, 0.1)], "source string, c double, p double")
    assert [r[0] for r in df.select(rules.evidence(F.col("source"), F.col("c"), F.col("p"), 0.5)).collect()] == [1.0, 0.7, 1.0, 0.25, 1.0]
    assert df.select(rules.number(F.lit(float("inf"))), rules.number(F.lit("-Infinity")), rules.number(F.lit(None)), rules.number(F.lit("7"))).first()[:] == (0.0, 0.0, 0.0, 7.0)
    sites = spark.createDataFrame([(k, "Bank erosion (land to water)", float(k + 1), 0.0, 0.0) for k in range(40)], "id int, class string, area_ha double, x double, y double")
    ai = sites.withColumn("class", F.lit("Likely bank erosion (AI prediction)")).withColumn("id", F.col("id") + 100)
    risk = sites.withColumn("class", F.lit("Very high")).withColumn("id", F.col("id") + 200)
    top = exposure.rank_sites({"change": sites, "ai": ai, "risk": risk}, {}).collect()
    assert {s: sum(r.source == s for r in top) for s in ("change", "ai", "risk")} == {"change": 30, "ai": 15, "risk": 5}
    assert all(r.priority_score == r.hazard_score and r.exposure_index is None for r in top)
    assert [r.rank for r in sorted(top, key=lambda r: -r.priority_score)][0] == 1


def test_patch_tests(spark):
    from fluvia.operators import patches

    cells = [(r, c, 0.9, 1e-6, True) for r in range(3) for c in range(3)] + [(10, 10, 0.9, 0.4, True)] + [(20, c, 0.05, 1e-6, True) for c in range(3)]
    t = spark.createDataFrame(cells, "row int, col int, d double, p_up double, rejected boolean")
    px, table = patches.loss_patches(t, 0.01)
    got = {r.region: r for r in table.collect()}
    assert set(got) == {0, 10 * 2**31 + 10} and got[0].kept and not got[10 * 2**31 + 10].kept
    assert got[0].area_ha == pytest.approx(9 * 0.9 * 0.01) and got[0].p < 1e-6
    assert patches.kept_cells(px, table).count() == 9
    base = patches.baseline_test(t.select("row", "col"), t, 0.04).first()
    assert (base.patches, base.significant, base.share_patches, base.share_area, base.loss_ha) == (3, 2, 0.667, 0.923, 0.5)
    tested = patches.tested_patches(t.withColumn("cls", F.when(F.col("row") < 2, 5).otherwise(1)), 0.01).collect()
    first = next(r for r in tested if r.region == 0)
    assert (first.cls, first.pixels) == (5, 9) and first.confidence > 0.999 and first.lost_ha == pytest.approx(0.081)


def test_lines_are_chained_and_measured(spark):
    from fluvia.operators import lines, unmix

    a = np.zeros((30, 60))
    a[:, 30:] = 1.0
    cells = grid(spark, a, "v")
    river = cells.where("v = 1").select("row", "col")
    kept = lines.bank_lines(cells, "v", river, 20.0, least=100.0)
    got = lines.line_lengths(kept, 20.0).collect()
    assert len(got) == 1 and got[0].metres == pytest.approx(29 * 20, abs=1)
    assert lines.bank_lines(cells, "v", river, 20.0, least=1000.0).count() == 0
    assert lines.bank_lines(cells, "v", river.where("col > 50"), 20.0, least=100.0).count() == 0  # far from the edge
    ring = spark.createDataFrame([(float(x), 0.0, float(x + 1), 0.0) for x in range(5)] + [(9.0, 9.0, 10.0, 9.0)], "x1 double, y1 double, x2 double, y2 double")
    assert lines.chained(ring).select("line").distinct().count() == 2
    b = np.roll(a, 5, axis=1)
    b[:, :5] = 0
    current = unmix.contour(cells, "v", 0.5)
    base = unmix.contour(grid(spark, b, "v"), "v", 0.5)
    patch = cells.where("row between 5 and 20 and col between 29 and 35").select(F.lit(1).cast("long").alias("region"), "row", "col")
    assert lines.retreat(patch, base, current, 20.0).first().retreat == pytest.approx(100.0, abs=0.2)
    assert lines.retreat(patch, base.where("x1 < 0"), current, 20.0).first().retreat is None


def test_gaussian_like_a_convolution(spark):
    from fluvia.operators import lines

    a = RNG.random((9, 7))
    r = int(4 * lines.SIGMA + 0.5)
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / lines.SIGMA) ** 2)
    w /= w.sum()
    p = np.pad(a, r, mode="symmetric")
    p = np.stack([np.convolve(x, w, "valid") for x in p])
    want = np.stack([np.convolve(x, w, "valid") for x in p.T]).T
    got = {(x.row, x.col): x.smooth for x in lines.gaussian(grid(spark, a, "v"), "v").collect()}
    assert all(abs(got[k] - v) < 1e-12 for k, v in np.ndenumerate(want))


def test_texts_of_reports(spark):
    r = spark.range(1).select(rules.signed(F.lit(143664)), rules.signed(F.lit(-5)), rules.signed(F.lit(0)), rules.slug(F.lit("Char or sandbar lost (within river belt)"))).first()
    assert r[:] == ("+1,43,664", "-5", "0", "char_or_sandbar_lost")
