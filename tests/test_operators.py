import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from noisefield.functions import arrays as A, geodesy
from noisefield.operators import correlate, gather, inventory, lookup, pairs, rotate, vectors


def distaz(spark, *rows):
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rows)], "k int, la double, lo double, lb double, mo double")
    return [r for r in geodesy.with_distaz(df, "la", "lo", "lb", "mo").orderBy("k").collect()]


def test_known_distances(spark):
    same, east, north, pole = distaz(spark, (10, 20, 10, 20), (0, 0, 0, 1), (0, 0, 1, 0), (90, 0, 0, 0))
    assert (same.gcarc_deg, same.azimuth_deg, same.back_azimuth_deg, same.distance_km) == (0, 0, 0, 0)
    assert east.distance_km == pytest.approx(111.3195, abs=1e-3) and east.azimuth_deg == pytest.approx(90, abs=1e-5) and east.back_azimuth_deg == pytest.approx(270, abs=1e-5)
    assert north.distance_km == pytest.approx(110.5744, abs=1e-2) and min(north.azimuth_deg, 360 - north.azimuth_deg) < 1e-5
    assert pole.gcarc_deg == pytest.approx(90, abs=1e-6) and pole.distance_km == pytest.approx(10001.966, abs=0.05)


def _section_km(la, lo, lb, mo):
    """The plane through one end's vertical and the other end cuts the ellipsoid; the arc is added up from very many short chords."""
    a, f = 6378.137, 1 / 298.257223563
    b = a * (1 - f)
    if lb <= 0:
        la, lo, lb, mo = lb, mo, la, lo
    place = lambda p, q: np.array([a * math.cos(u := math.atan2(b * math.sin(math.radians(p)), a * math.cos(math.radians(p)))) * math.cos(math.radians(q)), a * math.cos(u) * math.sin(math.radians(q)), b * math.sin(u)])
    p, q = place(la, lo), place(lb, mo)
    up = np.array([math.cos(math.radians(la)) * math.cos(math.radians(lo)), math.cos(math.radians(la)) * math.sin(math.radians(lo)), math.sin(math.radians(la))])
    # rays from the middle of the earth in the plane's own frame do not all stay in it: shoot from the foot of the vertical instead
    foot = p - up * a
    side = (q - foot) - ((q - foot) @ up) * up
    side /= np.linalg.norm(side)
    end = math.atan2((q - foot) @ side, (q - foot) @ up)
    t = np.linspace(0, end, 20_001)[:, None]
    ray = np.cos(t) * up + np.sin(t) * side
    scale = np.array([1 / a, 1 / a, 1 / b])
    r, m = ray * scale, foot * scale
    k2, k1, k0 = (r * r).sum(1), (r * m).sum(1), (m * m).sum() - 1
    hit = foot + ((-k1 + np.sqrt(k1 * k1 - k2 * k0)) / k2)[:, None] * ray
    return np.linalg.norm(np.diff(hit, axis=0), axis=1).sum()


def test_distances_against_short_chords(spark):
    rng = np.random.default_rng(11)
    rows = [(*rng.uniform((-90, -180), (90, 180)), *rng.uniform((-90, -180), (90, 180))) for _ in range(60)]
    rows += [(90, 0, -89.5, 3), (-90, 10, 45, 20), (0, 0, 0.3, 179.2), (10, 20, -9.9, -160.1), (89.9, 5, 89.9, -170), (45, 0, 45.00001, 0.00001), (0, 0, 0, 90), (-33.9, 18.4, 35.7, 139.7), (90, 0, -90, 0)]
    for want, got in zip(rows, distaz(spark, *rows), strict=True):
        if want != (90, 0, -90, 0):  # no single plane: any meridian will do
            assert got.distance_km == pytest.approx(_section_km(*map(float, want)), abs=5e-5)
        else:
            assert got.distance_km == pytest.approx(2 * 10001.965729, abs=1e-4)


def test_azimuths_at_poles_and_across_the_date_line(spark):
    from_pole, to_pole, east, west, far = distaz(spark, (90, 0, 10, 50), (10, 50, -90, 0), (10, 179.5, 10, -179.5), (10, -179.5, 10, 179.5), (0, 0, 0, 180))
    assert from_pole.back_azimuth_deg % 360 == pytest.approx(0, abs=1e-6) and to_pole.azimuth_deg == pytest.approx(180, abs=1e-6)
    assert east.azimuth_deg == pytest.approx(89.913, abs=1e-2) and west.azimuth_deg == pytest.approx(270.087, abs=1e-2)
    assert east.distance_km == pytest.approx(west.distance_km, abs=1e-6) and far.gcarc_deg == pytest.approx(180, abs=1e-6)


def test_station_numbers_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, "a", 0.0, 0.0), (10_002, "a", 0.0, 0.1)], "nsl_id int, group string, lat double, lon double")
    with pytest.raises(Exception, match="up to 9999, not 10002"):
        pairs.station_pairs(df).collect()
    assert pairs.station_pairs(df, id_base=1_000_000).first().path_id == 1_010_002
    many = spark.range(10_000).select(F.lit("g").alias("group"), F.lit("N").alias("network"), F.col("id").cast("string").alias("station"), F.lit("00").alias("location"), F.lit("Z").alias("component"), F.lit("p").alias("path"))
    with pytest.raises(ValueError, match="more than 9999 stations"):
        inventory.stations(many)


def test_pairs_inside_groups_are_an_equi_join(nodes):
    plan = pairs.station_pairs(nodes, group_mode="intra", autocorr="include")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_null_coordinates(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, 3.0)], "a double, b double, c double, d double")
    assert geodesy.with_distaz(df, "a", "b", "c", "d").first().distance_km is None


@pytest.fixture()
def nodes(spark):
    return spark.createDataFrame([(1, "a", 0.0, 0.0), (2, "a", 0.0, 0.1), (3, "b", 10.0, 10.0), (4, "b", None, None)], "nsl_id int, group string, lat double, lon double")


@pytest.mark.parametrize(
    ("kw", "want"),
    [
        ({}, {10002, 10003, 10004, 20003, 20004, 30004}),
        ({"group_mode": "intra"}, {10002, 30004}),
        ({"group_mode": "auto"}, {10003, 10004, 20003, 20004}),
        ({"autocorr": "only"}, {10001, 20002, 30003, 40004}),
        ({"distance_km": (0, 20)}, {10002}),
        ({"distance_km": (20, 40000)}, {10003, 20003}),
        ({"distance_km": (-1, 50000)}, {10002, 10003, 10004, 20003, 20004, 30004}),
        ({"azimuth": [(80, 100)]}, {10002}),
    ],
)
def test_pairs(nodes, kw, want):
    assert {r.path_id for r in pairs.station_pairs(nodes, **kw).collect()} == want


def test_near_and_far_joins_agree(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(k, "g", float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for k in range(1, 150)], "nsl_id int, group string, lat double, lon double")
    near = {r.path_id for r in pairs.station_pairs(df, distance_km=(0, 2500)).collect()}
    assert near == {r.path_id for r in pairs.station_pairs(df).where("distance_km <= 2500").collect()} and near


@pytest.mark.parametrize("limits", [(3500, 20000), (500, 2800), (4000, 5200), (9000, 9500), (15000, 20100), (0, 3200)])
def test_far_pairs_through_caps(spark, limits):
    rng = np.random.default_rng(5)
    places = [(float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for _ in range(90)] + [(float(rng.normal(40, 2)), float(rng.normal(10, 2))) for _ in range(60)]
    places += [(90.0, 0.0), (-90.0, 10.0), (89.99, 179.9), (0.0, 180.0), (0.0, -180.0), (10.0, 179.99), (10.0, -179.99), (0.0, 0.0), (0.0, 360.0), (-0.0, 90.0)]
    df = spark.createDataFrame([(k, "g", *p) for k, p in enumerate(places, 1)] + [(500, "g", None, 1.0)], "nsl_id int, group string, lat double, lon double")
    want = {r.path_id for r in pairs.station_pairs(df).where(F.col("distance_km").between(*limits)).collect()}
    assert {r.path_id for r in pairs.station_pairs(df, distance_km=limits).collect()} == want and want


def test_caps_leave_out_most_pairs(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(float(rng.normal(c, 1)), float(rng.normal(20 * c, 1))) for c in range(-4, 5) for _ in range(30)], "src_lat double, src_lon double")
    cells = df.select(pairs._cell("src_lat", "src_lon").alias("i")).groupBy("i").count()
    tested = lambda low, high: pairs.cap_pairs(df, low, high).join(cells.withColumnRenamed("count", "a"), "i").join(cells.withColumnsRenamed({"i": "j", "count": "b"}), "j").agg(F.sum(F.col("a") * F.col("b"))).first()[0]
    assert tested(0, 21000) == 270 * 270 and tested(4300, 4600) < 270 * 270 / 4 and not tested(30000, 40000)


def test_all_pairs_are_dealt_over_tasks(spark):
    df = spark.range(1, 101).select(F.col("id").cast("int").alias("nsl_id"), F.lit("g").alias("group"), (F.col("id") / 2).alias("lat"), (F.col("id") * 3.0 - 170).alias("lon")).coalesce(1)
    made = pairs.station_pairs(df)
    assert made.count() == 4950 and made.select(F.spark_partition_id().alias("k")).distinct().count() > 1


@pytest.mark.parametrize(
    "kw",
    [
        {},
        {"azimuth": [(300, 60)]},
        {"distance_km": (10.0, 1500.0)},
        {"distance_km": (4000.0, 9000.0)},
        {"group_mode": "intra", "autocorr": "include"},
        {"group_mode": "inter"},
    ],
)
def test_two_places_are_measured_once(spark, monkeypatch, kw):
    places = [(10.0, 20.0), (12.0, 21.0), (-40.0, 60.0), (0.0, 0.0), (None, None)]
    rows = [(k, "ab"[k % 2], *places[k * 7 % 5]) for k in range(1, 101)]
    schema = "nsl_id int, group string, lat double, lon double"
    seen, real = [], pairs.with_distaz
    monkeypatch.setattr(pairs, "with_distaz", lambda df, *a: seen.append(df) or real(df, *a))
    monkeypatch.setattr(pairs, "MEMBERS", 16, raising=False)
    made = pairs.station_pairs(spark.createDataFrame(rows, schema), **kw)
    got = {tuple(r) for r in made.collect()}
    # at most 5 places, 2 groups and 2 parts of each
    assert seen[-1].count() <= 400
    group, both = kw.get("group_mode", "all"), "include" if kw.get("autocorr") else "off"
    met = [(a, b) for a in rows for b in rows if a[0] < b[0] and (group == "all" or (a[1] == b[1]) == (group == "intra")) or (both == "include" and a[0] == b[0])]
    ends = spark.createDataFrame([(a[0] * 10_000 + b[0], a[0], b[0], a[1], b[1], a[2], a[3], b[2], b[3]) for a, b in met], "path_id long, src_id int, rec_id int, src_group string, rec_group string, la double, lo double, lb double, mo double")
    want = real(ends, "la", "lo", "lb", "mo").drop("la", "lo", "lb", "mo")
    if "distance_km" in kw:
        want = want.where(F.col("distance_km").between(*kw["distance_km"]))
    if "azimuth" in kw:
        want = want.where(" or ".join(f"{c} >= 300 or {c} <= 60" for c in ("azimuth_deg", "back_azimuth_deg")))
    assert got == {tuple(r) for r in want.select(*made.columns).collect()} and got


@pytest.mark.parametrize(("kw", "broadcast"), [({"group_mode": "intra"}, "0"), ({"distance_km": (0.0, 2000.0)}, "0"), ({"distance_km": (3500.0, 9000.0)}, "10m")])
def test_pairs_of_few_places_are_dealt_over_tasks(spark, kw, broadcast):
    df = spark.range(1, 201).selectExpr("cast(id as int) nsl_id", "id % 2 group", "cast(id % 40 as double) lat", "cast(id * 9 % 160 as double) lon").coalesce(1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert pairs.station_pairs(df, **kw).select(F.spark_partition_id().alias("k")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kw", [{}, {"azimuth": [(350.0, 20.0)]}, {"group_mode": "inter"}])
def test_tasks_of_all_pairs_do_not_grow_with_the_square_of_partitions(spark, kw):
    df = spark.range(1, 201).selectExpr("cast(id as int) nsl_id", "id % 2 group", "cast(id % 40 as double) lat", "cast(id * 9 % 160 as double) lon")
    kept = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "20"}
    before = {k: spark.conf.get(k) for k in kept}
    try:
        for k, v in kept.items():
            spark.conf.set(k, v)
        assert 20 <= pairs.station_pairs(df, **kw).rdd.getNumPartitions() <= 20 * 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_many_stations_at_one_place(spark, monkeypatch):
    monkeypatch.setattr(pairs, "MEMBERS", 8, raising=False)
    made = pairs.station_pairs(spark.range(1, 101).selectExpr("cast(id as int) nsl_id", "'g' group", "1.0 lat", "2.0 lon"), distance_km=(0.0, 5.0))
    assert made.count() == 4950 == made.distinct().count() and made.where("distance_km = 0 and src_id < rec_id").count() == 4950


def test_retained_stations_read_the_pairs_once(spark, nodes):
    got = pairs.retained(nodes, pairs.station_pairs(nodes, distance_km=(0.0, 20.0)))
    assert {r.nsl_id for r in got.collect()} == {1, 2} and got._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_azimuths_at_opposite_points_and_both_arcs(spark):
    """The azimuth of an opposite point is what the difference of longitudes leaves: due east or west."""
    there, back = distaz(spark, (-30, -150, 30, 30), (30, 30, -30, -150))
    assert [there.azimuth_deg, there.back_azimuth_deg, back.azimuth_deg, back.back_azimuth_deg] == [90, 270, 270, 90] and there.distance_km == pytest.approx(20003.9315, abs=1e-4)
    rng = np.random.default_rng(8)
    at = [rng.uniform(-b, b, 20_000) for b in (90, 180, 90, 180)]
    exact, simpson, finer = (geodesy.distaz(*at, steps)[1] for steps in (0, 128, 512))
    assert 1e-8 < np.abs(exact - simpson).max() < 2e-7 and np.abs(exact - finer).max() < 2e-9


@pytest.mark.parametrize(("tile_bytes", "blocks", "ranges"), [(40_000, 4, 2), (400_000, 32, 1)])
def test_tiles_of_blocks_and_ranges_give_the_same_lags(spark, monkeypatch, tile_bytes, blocks, ranges):
    rng = np.random.default_rng(9)
    length, half, steps = 128, 20, 2
    numbers = length // 2 + 1
    assert correlate.layout(3 * 16 * numbers * steps, 8 * (2 * half + 1), numbers, tile_bytes) == (blocks, ranges)
    z = {(t, s, c, k): rng.normal(size=numbers) + 1j * rng.normal(size=numbers) for t in range(2) for s in range(1, 8) for c in "EZ" for k in range(steps) if (t, s, k) != (1, 3, 1)}
    spec = spark.createDataFrame([(*k, v.real.tolist(), v.imag.tolist()) for k, v in z.items()], "timestamp long, nsl_id int, component string, step int, re array<double>, im array<double>")
    paths = spark.createDataFrame([(a * 10000 + b, a, b) for a in range(1, 8) for b in range(a, 8) if (a + b) % 5], "path_id long, src_id int, rec_id int")
    got = {(r.timestamp, r.path_id, r.slot): (r.steps, r.data) for r in correlate.correlate_spectra(spec, paths, half, length, 0.5, steps, tile_bytes).collect()}
    want = {}
    for t in range(2):
        for p in paths.collect():
            for i, a in ((0, "E"), (2, "Z")):
                for j, b in ((0, "E"), (2, "Z")):
                    each = [np.fft.irfft(np.conj(z[t, p.src_id, a, k]) * z[t, p.rec_id, b, k], length) / 0.5 for k in range(steps) if (t, p.src_id, a, k) in z and (t, p.rec_id, b, k) in z]
                    mean = np.mean(each, axis=0)
                    want[t, p.path_id, 3 * i + j] = (len(each), np.concatenate([mean[length - half :], mean[: half + 1]]))
    assert got.keys() == want.keys()
    assert all(got[k][0] == n and np.allclose(got[k][1], x) for k, (n, x) in want.items())


def test_layout_at_real_sizes():
    """A day of 24 steps at 18,523 frequencies: a tile stays below its bound, and a spectrum is sent to blocks, not to pairs."""
    numbers, steps, lags = 18_523, 24, 2001
    station = 3 * 16 * numbers * steps
    block, ranges = correlate.layout(station, 8 * lags, numbers)
    assert block >= 16 and ranges > 1 and 2 * block * station / ranges <= correlate.TILE_BYTES
    sent = lambda b, r: station / b + (9 * r * 8 * lags / 2 if r > 1 else 0)  # noqa: E731  (bytes a pair of stations)
    assert sent(block, ranges) < sent(1, 1) / 8
    assert correlate.layout(3 * 16 * 33, 8 * 17, 33) == (64, 1)


def test_shuffled_bytes_grow_with_blocks(spark):
    """Forty stations: what the tiles are sent, counted in the plan's own rows, is a spectrum a block and not a spectrum a pair."""
    stations, numbers = 40, 513
    block, ranges = correlate.layout(3 * 16 * numbers, 8 * 21, numbers, 1 << 17)
    assert block >= 8 and ranges > 1
    paths = spark.createDataFrame([(a * 10000 + b, a, b) for a in range(1, stations + 1) for b in range(a + 1, stations + 1)], "path_id long, src_id int, rec_id int")
    of = lambda c: F.floor(F.col(c) / block)
    ends = paths.select(F.col("src_id").alias("s"), of("src_id").alias("i"), of("rec_id").alias("j")).union(paths.select("rec_id", of("src_id"), of("rec_id"))).distinct()
    blocks = -(-(stations + 1) // block)
    assert ends.count() <= stations * (blocks + 1) < 2 * paths.count() / 4


def test_pattern_back_reference_and_wildcards(spark):
    p = inventory.PathPattern("{home}/{station}/{?}/{YYYY}{JJJ}.{station}.{*}.{component}", "/d")
    df = spark.createDataFrame([("/d/AB1/x/2022137.AB1.q.w.BHZ",), ("/d/AB1/x/2022137.AB2.q.BHZ",), ("/e/AB1/x/2022137.AB1.q.BHZ",), (None,)], "path string")
    got = p.match(df).collect()
    assert [(r.station, r.component, r.channel, r.network, str(r.time)) for r in got] == [("AB1", "BHZ", "BHZ", "VV", "2022-05-17 00:00:00")]


@pytest.mark.parametrize("bad", ["{home}/{YYYY}{JJJ}.{component}", "{home}/{station}.{component}.{DD}", "{home}/{YYYY}{JJJ}{station}", "{YYYY}{JJJ}{station}.{component}", "{home}/{what}{YYYY}{JJJ}{station}.{component}"])
def test_bad_patterns(bad):
    with pytest.raises(ValueError):
        inventory.PathPattern(bad, "/d")


def test_component_labels(spark):
    df = spark.createDataFrame([("BHZ",), ("BHN",), ("BHE",), ("LOG",)], "component string")
    assert sorted((r.raw_component, r.component) for r in inventory.relabel_components(df, ["BHE", "BHN", "BHZ"]).collect()) == [("BHE", "E"), ("BHN", "N"), ("BHZ", "Z")]
    assert [r.component for r in inventory.relabel_components(df, ["BHZ"]).collect()] == ["BHZ"]
    with pytest.raises(ValueError):
        inventory.relabel_components(df, ["A", "B"])


def test_time_spellings(spark):
    df = spark.createDataFrame([("20220517T10:20",), ("2022.137.1020",), ("2022-05-17 10:20:00",), ("202205171020",), ("nonsense",)], "t string")
    assert [str(r[0]) for r in df.select(inventory.read_time(F.col("t"))).collect()] == ["2022-05-17 10:20:00"] * 4 + ["None"]


def one(spark, column, data):
    return spark.createDataFrame([(data,)], "x array<double>").select(column(F.col("x")).alias("y")).first().y


def test_array_functions(spark):
    assert one(spark, A.detrend, [float(2 * k + 1) for k in range(20)]) == pytest.approx([0] * 20, abs=1e-9)
    assert one(spark, A.detrend, [7.0]) == [0.0]
    assert one(spark, A.sanitize, [1.0, math.nan, math.inf, None]) == [1.0, 0.0, 0.0, 0.0]
    assert one(spark, lambda x: A.segments(x, 4, 3), [float(k) for k in range(9)]) == [[0, 1, 2, 3], [3, 4, 5, 6]]
    assert one(spark, lambda x: A.segments(x, 4, 3), [1.0]) == []
    assert one(spark, lambda x: A.fit_length(x, 3), [1.0]) == [1.0, 0.0, 0.0]
    assert one(spark, lambda x: A.taper(x, 4), [1.0] * 6) == pytest.approx([0, *(0.5 * (1 - math.cos(math.pi * k / 4)) for k in (1, 2, 3)), 0.5 * (1 - math.cos(math.pi * 2 / 4)), 0.5 * (1 - math.cos(math.pi / 4))])
    assert one(spark, A.normalized, [0.0, 0.0]) == [0.0, 0.0]


def test_rotation_of_a_seeded_tensor(spark):
    rng = np.random.default_rng(11)
    enz = rng.normal(size=(9, 16))
    az, baz = 37.5, 221.25
    s, c, sb, cb = (f(math.radians(v)) for v in (az, baz) for f in (math.sin, math.cos))
    src = np.array([[s, c, 0], [c, -s, 0], [0, 0, 1]])
    rec = np.array([[-sb, -cb, 0], [-cb, sb, 0], [0, 0, 1]])
    want = np.kron(src, rec) @ enz
    df = spark.createDataFrame([(10002, k, [float(v) for v in row]) for k, row in enumerate(enz)] + [(10003, 0, [0.0])], "path_id long, slot int, data array<double>")
    geo = spark.createDataFrame([(10002, az, baz), (10003, az, baz)], "path_id long, azimuth_deg double, back_azimuth_deg double")
    got = {r.slot: r.data for r in rotate.rotate(df, geo).collect()}
    assert np.array([got[k] for k in range(9)]) == pytest.approx(want, abs=1e-9)
    assert [r.path_id for r in rotate.incomplete(df).collect()] == [10003]


def test_direct_and_spectral_correlations_agree(spark):
    rng = np.random.default_rng(2)
    rows = [(d, s, c, [float(v) for v in rng.normal(size=64)]) for d in range(3) for s in (1, 2) for c in "ENZ"]
    ch = spark.createDataFrame(rows, "timestamp long, nsl_id int, component string, data array<double>")
    paths = spark.createDataFrame([(10002, 1, 2), (10001, 1, 1)], "path_id long, src_id int, rec_id int")
    chain = correlate.Conditioning(1.0, 64, 64, 8, normalize="OFF", whiten="OFF")
    base = ch.withColumn("data", A.detrend(A.demean(F.col("data"))))
    key = lambda r: (r.timestamp, r.path_id, r.slot)
    direct = {key(r): r.data for r in correlate.correlate_direct(base, paths, 8).collect()}
    fft = {key(r): r.data for r in correlate.correlate_spectra(correlate.spectra(ch, chain), paths, 8, chain.length, 1.0).collect()}
    assert direct.keys() == fft.keys() and len(direct) == 3 * 18
    for k, v in direct.items():
        assert v == pytest.approx(fft[k], abs=1e-9)


def test_long_arrays_are_summed_like_short_ones(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(k % 3, None if k % 5 == 0 else "a", [float(v) for v in rng.normal(size=7)]) for k in range(40)]
    df = spark.createDataFrame(rows, "k int, name string, data array<double>").repartition(3)
    order = lambda rows: sorted(((r.k, str(r.name), r.n, [round(v, 9) for v in r.data]) for r in rows))
    short = order(vectors.mean_arrays(df, ["k", "name"], 7, "n").collect())
    monkeypatch.setattr(vectors, "JVM_WIDTH", 2)
    assert order(vectors.mean_arrays(df, ["k", "name"], 7, "n").collect()) == short and len(short) == 6
    assert vectors.mean_arrays(df.where("false"), ["k", "name"], 7, "n").count() == 0


def test_gaussian_smoothing_keeps_constants_and_sums():
    x = np.zeros((9, 41))
    x[4, 20] = 1
    out = gather.gaussian_smooth(x, (1.0, 2.0))
    assert out.sum() == pytest.approx(1, abs=1e-3) and out[4, 20] == out.max()
    assert gather.gaussian_smooth(np.full((3, 5), 2.5), (1.0, 3.0)) == pytest.approx(np.full((3, 5), 2.5))


def test_windows_leave_zeros_outside_the_trace(spark):
    x = [1.0, 2.0, 3.0, 4.0]
    for t1, t2, want in ((-2, 2, [0, 0, 1, 2]), (1, 6, [2, 3, 4, 0, 0]), (9, 11, [0, 0]), (-9, -7, [0, 0])):
        assert one(spark, lambda c, t1=t1, t2=t2: A.window(c, F.lit(0.0), 1.0, t1, t2), x) == want


def test_records_of_a_pair(spark):
    rows = [("t:1", "N1", "A", "00", "BHE", "N2", "B", "", "BHZ"), ("t:1", "N3", "A", "00", "BHE", "N2", "B", "", "BHZ"), ("t:1", "N2", "B", "", "BHZ", "N1", "A", "00", "BHE")]
    names = [f"{p}_{k}" for p in ("src", "rec") for k in ("network", "station", "location", "component")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["timestamp", *names]))
    with pytest.raises(LookupError, match="src_network"):
        lookup.one(lookup.extract(df, "t_1", "A", "B", "BHE-BHZ"))
    assert lookup.one(lookup.extract(df, "t_1", "A", "B", "BHE/BHZ", src_network="N3")).first().src_network == "N3"
    both = lookup.extract(df, None, "A", "B", "BHE-BHZ", allow_reverse=True, src_network="N1").collect()
    assert sorted(r.reversed for r in both) == [False, True]
    with pytest.raises(LookupError, match="no record"):
        lookup.one(lookup.extract(df, "t_2", "A", "B", "BHE-BHZ"))
    with pytest.raises(ValueError, match="BHE-BHZ"):
        lookup.parse_component_pair("BHE")
    back = df.select(*(v.alias(k) for k, v in lookup.parse_final_path(lookup.final_path({c: F.col(c) for c in names})).items())).first().asDict()
    assert back == dict(zip(names, rows[0][1:], strict=True))
    assert df.select(lookup.safe_name(F.lit("a b/c:d")).alias("x"), lookup.id_text(F.lit(7), 4).alias("y")).first() == ("a-b-c_d", "0007")


def test_receivers_and_distances(spark):
    df = spark.createDataFrame([("N", "A", "00", 1.0), ("N", "B", "00", 5.0), ("M", "B", "00", 9.0)], "rec_network string, rec_station string, rec_location string, distance double")
    assert {r.distance for r in gather.select_receivers(df, ["B"]).collect()} == {5.0, 9.0}
    assert {r.distance for r in gather.select_receivers(df, ["N.B", "A"], (None, 4.0)).collect()} == {1.0}
    assert gather.select_receivers(df, None, (5.0, None)).count() == 2
    with pytest.raises(ValueError, match="C"):
        gather.select_receivers(df, ["A", "C"])
    grid = lambda n: spark.range(n).select(F.col("id").alias("slot"))
    assert gather.grid_layout(grid(1)) == (1, 1) and gather.grid_layout(grid(9)) == (3, 3)
    with pytest.raises(ValueError, match="not 4"):
        gather.grid_layout(grid(4))
    assert gather.frequency_range(spark.range(10).select(F.col("id").alias("k")), 0.2, 0.5, 0.1).count() == 4


def test_rotation_refuses_other_lengths(spark):
    df = spark.createDataFrame([(1, k, [1.0] * (3 if k else 4)) for k in range(9)], "path_id long, slot int, data array<double>")
    geometry = spark.createDataFrame([(1, 10.0, 200.0)], "path_id long, azimuth_deg double, back_azimuth_deg double")
    with pytest.raises(Exception, match="different lengths"):
        rotate.rotate(df, geometry).collect()
    assert rotate.rotate(df.withColumn("data", F.slice("data", 1, 3)), geometry).count() == 9
    assert rotate.incomplete(df.where("slot < 8")).first().n_slots == 8


def test_channels_of_every_station(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "station string, k int")
    assert inventory.channel_count(df.where("station = 'a'"), "station") == 2
    with pytest.raises(ValueError, match="between 1 and 2"):
        inventory.channel_count(df, "station")
