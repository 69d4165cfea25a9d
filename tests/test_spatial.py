"""Boxes, grids, neighbourhoods and kriging."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import kriging as K
from gridtide.operators import spatial as S
from gridtide.plans.weather import interpolate_weather, station_months, weather_of_runs
from gridtide.schemas import WEATHER


def km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1, a)))


def ring_loop(r0, distances, extra=3, step=10):
    """Rings grown one by one; all points if there are too few."""
    if sum(d > r0 for d in distances) < extra:
        return set(range(len(distances)))
    radius = r0
    while sum(r0 < d <= radius for d in distances) < extra:
        radius += step
    return {i for i, d in enumerate(distances) if d <= radius}


@pytest.mark.parametrize("spread, n", [(1.5, 60), (20, 40), (170, 30), (3, 5), (3, 2)])
def test_ring_neighbours_equal_the_loop(spark, spread, n):
    random.seed(n)
    sites = [(f"s{i}", random.uniform(-spread, spread), random.uniform(-min(spread, 80), min(spread, 80))) for i in range(n)]
    centres = [(f"c{j}", random.uniform(-spread, spread), random.uniform(-min(spread, 80), min(spread, 80)), float(random.choice([0, 5, 60]))) for j in range(8)]
    stations = spark.createDataFrame(sites, "station_code string, longitude double, latitude double")
    boxes = spark.createDataFrame(centres, "k string, c_lon double, c_lat double, r0 double")
    got = {}
    for r in S.ring_neighbours(boxes, stations, "k").collect():
        got.setdefault(r.k, set()).add(int(r.station_code[1:]))
    for name, lon, lat, r0 in centres:
        assert got[name] == ring_loop(r0, [km(lat, lon, y, x) for _, x, y in sites])


def test_centres_oceans_away_from_a_crowd(spark):
    """Most points crowd at one place; far centres meet few of them, and single points beside them count."""
    random.seed(6)
    sites = [(i, random.gauss(139.7, 4), random.gauss(35.7, 4)) for i in range(4000)] + [(5000, -120.0, -60.0), (5001, 170.0, -44.0)]
    sites += [(6000 + i, 139.7, 35.7) for i in range(300)]
    centres = [(j, random.uniform(-180, 180), random.uniform(-80, 80), random.choice([0.0, 100.0, 5000.0])) for j in range(40)] + [(99, 139.7, 35.7, 0.0), (98, -180.0, 90.0, 10.0)]
    points = spark.createDataFrame(sites, "s int, longitude double, latitude double")
    got = {r.k: r.radius_km for r in S.ring_radius(spark.createDataFrame(centres, "k int, c_lon double, c_lat double, r0 double"), points, "k").collect()}
    for name, lon, lat, r0 in centres:
        third = sorted(d for _, x, y in sites if (d := km(lat, lon, y, x)) > r0)[2]
        assert got[name] == r0 + 10 * math.ceil((third - r0) / 10)
    asked = spark.createDataFrame(centres, "k int, c_lon double, c_lat double, r0 double").where("k < 40")
    x, y = S._cell(8, "longitude", "latitude")
    counted = points.selectExpr(f"int(pmod({x}, 256)) AS cx", f"int({y}) AS cy").groupBy("cx", "cy").agg(F.count("*").alias("n"))
    every = asked.select("k", "c_lon", "c_lat", "r0").crossJoin(counted)
    left = S._nearest_cells(every, ["k", "c_lon", "c_lat", "r0"], ("c_lon", "c_lat"), 8, 3)
    most = left.groupBy("k").agg(F.count("*").alias("cells")).agg(F.max("cells")).first()[0]
    assert 5 * most < counted.count()


def test_pairs_across_the_date_line(spark):
    stations = spark.createDataFrame([("e", 179.9, 10.0), ("w", -179.9, 10.0), ("far", 0.0, 10.0)], "station_code string, longitude double, latitude double")
    centre = spark.createDataFrame([("c", 179.95, 10.0, 40.0)], "k string, c_lon double, c_lat double, r double")
    assert {r.station_code for r in S.pairs_within(centre, stations, "r").collect()} == {"e", "w"}


def test_pairs_at_any_radius_equal_brute_force(spark):
    random.seed(5)
    sites = [(i, random.uniform(-180, 180), random.uniform(-89, 89)) for i in range(60)]
    centres = [(j, random.uniform(-180, 180), random.uniform(-89, 89), random.choice([30.0, 500.0, 3000.0, 9000.0])) for j in range(30)]
    got = S.pairs_within(
        spark.createDataFrame(centres, "k int, c_lon double, c_lat double, r double"),
        spark.createDataFrame(sites, "s int, longitude double, latitude double"),
        "r",
    )
    expected = {(c[0], s[0]) for c in centres for s in sites if km(c[2], c[1], s[2], s[1]) <= c[3]}
    assert sorted((r.k, r.s) for r in got.collect()) == sorted(expected)


def box(spark, lon, lat, n):
    rows = [("f", -50.0, -20.0)] * (n - 1) + [("f", -50.0 + lon, -20.0 + lat)]
    return S.bounding_boxes(spark.createDataFrame(rows, "code string, longitude double, latitude double"), "code")


@pytest.mark.parametrize(
    "lon, lat, n, points",
    [
        (0.0, 0.0, 1, 1),  # a single pole
        (0.05, 0.05, 99, 1),  # few poles: the centre
        (0.05, 0.05, 100, 5),  # many: sides and centre
        (0.15, 0.15, 100, 5),  # 2 x 2 cells
        (0.25, 0.25, 10, 10),  # 3 x 3 lattice and centre
        (0.0, 0.6, 10, 8),  # a line of 7 points: no step across
    ],
)
def test_evaluation_grid(spark, lon, lat, n, points):
    grid = S.eval_grid(box(spark, lon, lat, n), "code").collect()
    assert len(grid) == points
    assert all(-50 - 1e-9 <= p.lon <= -50 + lon + 1e-9 and -20 - 1e-9 <= p.lat <= -20 + lat + 1e-9 for p in grid)


def test_box_geometry(spark):
    b = box(spark, 0.3, 0.4, 3).first()
    assert b.width_km == pytest.approx(km(-19.6, -50, -19.6, -49.7))
    assert b.height_km == pytest.approx(km(-20, -50, -19.6, -50))
    assert b.r0 == math.ceil(math.hypot(b.width_km, b.height_km) / 2)


def test_kriging_reproduces_samples_and_order_does_not_matter():
    rng = np.random.default_rng(1)
    xy, v = rng.random((9, 2)), rng.random((9, 2))

    def at(fit, p):
        trend, sx, sy, w, pts = fit
        return trend + (w * np.exp(-0.5 * (((p - pts) / (sx, sy)) ** 2).sum(axis=1))).sum()

    fits = [(*f, xy) for f in K.solve(xy, v)]
    for j, f in enumerate(fits):
        assert [at(f, p) for p in xy] == pytest.approx(v[:, j], abs=1e-4)
    turn = rng.permutation(9)
    again = [(*f, xy[turn]) for f in K.solve(xy[turn], v[turn])]
    probe = np.array([0.4, 0.6])
    assert [at(f, probe) for f in fits] == pytest.approx([at(f, probe) for f in again], rel=1e-6)


def samples(spark, rows):
    return spark.createDataFrame(rows, "k string, longitude double, latitude double, a double, b double")


def grid(spark, *keys):
    return spark.createDataFrame(
        [(k, [([-50.0], [-20.0]), ([-49.0], [-19.5])]) for k in keys], "k string, lattices array<struct<lons:array<double>,lats:array<double>>>"
    )


def test_kriging_of_simple_fields(spark):
    rows = [
        ("one", -50.0, -20.0, 7.0, 0.0),
        *[("flat", -50.0 + i, -20.0 + i * i, 3.0, float(i)) for i in range(5)],
        *[("twin", -50.0, -20.0, float(i), 0.0) for i in range(2)],
    ]
    made = K.krige(samples(spark, rows), grid(spark, "one", "flat", "twin"), ["k"], ("longitude", "latitude"), ["a", "b"], ["k"])
    got = {r.k: r for r in made.collect()}
    assert got["one"].a == pytest.approx(7.0) and got["one"].b == 0.0
    assert got["flat"].a == pytest.approx(3.0) and 0 < got["flat"].b < 4
    assert got["twin"].a == pytest.approx(0.5) and got["twin"].b == 0.0


def test_failed_fit_is_reported(spark):
    rows = [("bad", float("nan"), -20.0, 1.0, 1.0), ("bad", -50.0, -20.0, 2.0, 1.0), ("good", -50.0, -20.0, 2.0, 1.0)]
    fitted = K.fit_kriging(samples(spark, rows), ["k"], ("longitude", "latitude"), ["a", "b"])
    assert {r.k for r in fitted.where("error is not null").collect()} == {"bad"}
    assert {r.k for r in K.predict_kriging(fitted, grid(spark, "bad", "good"), ["k"], ["a", "b"], ["k"]).collect()} == {"good"}


def test_store_fits_only_what_it_lacks(spark, tmp_path, monkeypatch):
    rows = [(k, m, -50.0 + x, -20.0 + x * x, float(x * m), float(m == 2) * x) for k in ("a", "b") for m in (1, 2, 3) for x in range(4)]
    frame = spark.createDataFrame(rows, "k string, month int, lon double, lat double, v double, z double")
    store = K.FieldStore(spark, str(tmp_path / "store"))
    args = (["k", "month"], ("lon", "lat"), ["v", "z"])
    plain = lambda df: sorted((r.k, r.month, r.variable, r.trend, r.scale_lon, r.scale_lat, [tuple(w) for w in r.weights], r.error) for r in df.collect())
    early = frame.where("month < 3 and k = 'a'")
    assert plain(store.fields(early, *args)) == plain(K.fit_kriging(early, *args))
    rows = K.gathered(frame, *args)
    assert {(r.k, r.month) for r in store.missing(rows, args[0]).collect()} == {("a", 3), ("b", 1), ("b", 2), ("b", 3)}
    everything = plain(store.fields(frame, *args))
    assert everything == plain(K.fit_kriging(frame, *args)) and store.missing(rows, args[0]).isEmpty()
    monkeypatch.setattr(K, "_fit_rows", None)  # nothing is left to fit
    assert plain(store.fields(frame, *args)) == everything
    assert plain(store.fields(early, *args)) == [r for r in everything if r[:2] in {("a", 1), ("a", 2)}]
    monkeypatch.undo()
    changed = frame.withColumn("v", F.when((F.col("month") == 2) & (F.col("lon") == -50), 9.0).otherwise(F.col("v")))
    assert {(r.k, r.month) for r in store.missing(K.gathered(changed, *args), args[0]).collect()} == {("a", 2), ("b", 2)}
    assert plain(store.fields(changed, *args)) == plain(K.fit_kriging(changed, *args))
    assert K.FieldStore(spark, str(tmp_path / "none")).fields(frame.where("false"), *args).collect() == []


def weather_fixture(spark, gap=lambda y, m: False):
    stations = spark.createDataFrame([(f"s{i}", -50.0 + i / 10, -20.0) for i in range(5)], "station_code string, longitude double, latitude double")
    months = [(y, m) for y in (2018, 2019) for m in range(1, 13) if not gap(y, m)]
    history = spark.createDataFrame(
        [(f"s{i}", y, m, *[float(y - 2000 + m)] * 6, 0.0) for i in range(5) for y, m in months],
        "station_code string, year int, month int, " + ", ".join(f"{v} double" for v in WEATHER),
    )
    points = spark.createDataFrame([("f1", -50.0, -20.0), ("f1", -49.95, -20.0), ("f2", -49.9, -20.1)], "cod_alim string, longitude double, latitude double")
    return points, stations, history


def spans(spark, *feeders):
    return spark.createDataFrame([("c", dt.date(2019, 12, 1), f, dt.date(2018, 1, 1)) for f in feeders], "conjunto string, pred_month date, cod_alim string, first_month date")


def test_weather_gaps_are_filled_once(spark):
    """Gaps in the first, a middle and the last month; a calendar month without any value."""
    gap = lambda y, m: (y, m) in {(2018, 1), (2019, 3), (2019, 12)} or m == 7
    full, errors = weather_of_runs(*weather_fixture(spark, gap), spans(spark, "f1", "f2"))
    rows = full.where("cod_alim = 'f1'").collect()
    by_month = {r.month: r for r in rows}
    assert len(rows) == len(by_month) == 24 and errors.count() == 0
    assert by_month[dt.date(2018, 2, 1)].temp_max == pytest.approx(20.0)
    assert by_month[dt.date(2018, 1, 1)].temp_max == pytest.approx(20.0)  # as in January 2019
    assert by_month[dt.date(2019, 3, 1)].temp_max == pytest.approx(21.0)
    assert by_month[dt.date(2019, 12, 1)].precipitation == pytest.approx(30.0)
    assert by_month[dt.date(2019, 7, 1)].temp_max is None
    assert by_month[dt.date(2019, 5, 1)].windvelo_mean == 0.0


def test_feeder_without_points_or_values_is_reported(spark):
    points, stations, history = weather_fixture(spark)
    once = spark.createDataFrame([(f, dt.date(2018, 1, 1), dt.date(2018, 3, 1)) for f in ("f1", "ghost")], "cod_alim string, start date, end date")
    values, errors = interpolate_weather(points, stations, history, once)
    assert {r.cod_alim for r in values.collect()} == {"f1"}
    assert [(r.cod_alim, r.reason) for r in errors.collect()] == [("ghost", "no coordinates")]
    values, errors = interpolate_weather(points, stations, history.where("year < 2018"), once)
    assert values.count() == 0
    assert {(r.cod_alim, r.month, r.reason) for r in errors.collect()} == {("f1", None, "no station near has values"), ("ghost", None, "no coordinates")}


def test_failing_month_is_reported(spark):
    points, stations, history = weather_fixture(spark)
    broken = history.withColumn("temp_max", F.when((F.col("year") == 2018) & (F.col("month") == 2), F.lit(float("inf"))).otherwise(F.col("temp_max")))
    once = spark.createDataFrame([("f1", dt.date(2018, 1, 1), dt.date(2018, 3, 1))], "cod_alim string, start date, end date")
    values, errors = interpolate_weather(points, stations, broken, once)
    assert {r.month for r in values.collect()} == {dt.date(2018, 1, 1), dt.date(2018, 3, 1)}
    assert [(r.cod_alim, r.month) for r in errors.collect()] == [("f1", dt.date(2018, 2, 1))]


def log_likelihood(xy, field, scales):
    """The profile log likelihood, written out."""
    n = len(xy)
    k = np.array([[math.exp(-0.5 * (((p - q) / scales) ** 2).sum()) for q in xy] for p in xy]) + K.NUGGET * np.eye(n)
    inverse, one = np.linalg.inv(k), np.ones(n)
    rest = field - (one @ inverse @ field) / (one @ inverse @ one)
    return -0.5 * (n * math.log(rest @ inverse @ rest / n) + np.linalg.slogdet(k)[1])


def test_search_for_scales():
    """Never below the best of the fixed scales, at a stationary point or a limit, and near known scales."""
    rng = np.random.default_rng(5)
    for n, fields in ((4, 6), (9, 5), (40, 3)):
        xy = rng.uniform(0, [2.0, 5.0], (n, 2))
        values = rng.normal(size=(n, fields)) + np.sin(xy[:, :1])
        extent = np.ptp(xy, axis=0)
        for j, (_trend, sx, sy, _w) in enumerate(K.solve(xy, values)):
            found = np.array([sx, sy])
            best = log_likelihood(xy, values[:, j], found)
            assert best >= max(log_likelihood(xy, values[:, j], np.array(f) * extent) for f in [(a, b) for a in K.SCALES for b in K.SCALES]) - 1e-6
            for axis in (0, 1):
                for step in (0.97, 1.03):
                    near = found.copy()
                    near[axis] *= step
                    inside = K.LIMITS[0] * extent[axis] <= near[axis] <= K.LIMITS[1] * extent[axis]
                    assert not inside or log_likelihood(xy, values[:, j], near) <= best + 1e-4
    xy = rng.uniform(0, 10, (150, 2))
    known = np.array([1.3, 3.1])
    k = np.exp(-0.5 * (((xy[:, None] - xy[None]) / known) ** 2).sum(axis=2)) + 1e-8 * np.eye(150)
    draws = np.linalg.cholesky(k) @ rng.normal(size=(150, 4)) * 7 + 20
    for _trend, sx, sy, _w in K.solve(xy, draws):
        assert sx == pytest.approx(known[0], rel=0.15) and sy == pytest.approx(known[1], rel=0.15)


def test_slopes_of_the_likelihood():
    rng = np.random.default_rng(8)
    xy, fields = rng.random((7, 2)), rng.random((3, 7))
    places, at = K.Places(xy), np.log(rng.uniform(0.2, 0.6, (3, 2)))
    value, slopes = places.likelihood(at, fields)
    assert value == pytest.approx([log_likelihood(xy, f, np.exp(a)) for f, a in zip(fields, at)])
    for axis in (0, 1):
        step = np.zeros(2)
        step[axis] = 1e-5
        numeric = (places.likelihood(at + step, fields)[0] - places.likelihood(at - step, fields)[0]) / 2e-5
        assert slopes[:, axis] == pytest.approx(numeric, rel=1e-4, abs=1e-4)


def test_sets_of_places_are_shared(spark, monkeypatch):
    """Fields over the same places are fitted together or dealt to tasks, equal ones once, with equal results."""
    rng = np.random.default_rng(3)
    xy = rng.uniform(0, 5, (25, 2))
    rows = [(k, m, float(x), float(y), float(np.cos(x) + m), 0.0) for k in "ab" for m in range(4) for x, y in xy[: 20 + 5 * (m == 2)]]
    frame = spark.createDataFrame(rows, "k string, month int, lon double, lat double, v double, z double")
    args = (["k", "month"], ("lon", "lat"), ["v", "z"])
    gathered = K.gathered(frame, *args).collect()
    assert len({r.place_set for r in gathered}) == 2 and len({r.content for r in gathered}) == 4
    together = {(r.k, r.month, r.variable): r for r in K.fit_kriging(frame, *args).collect()}
    monkeypatch.setattr(K, "FIELDS", 1)
    apart = {(r.k, r.month, r.variable): r for r in K.fit_kriging(frame, *args).collect()}
    assert set(together) == set(apart) and len(apart) == 16
    for (k, m, name), r in together.items():
        other = apart[k, m, name]
        assert [r.trend, r.scale_lon, r.scale_lat] == pytest.approx([other.trend, other.scale_lon, other.scale_lat], rel=1e-3)
        if name == "z":
            assert (r.trend, r.weights) == (0.0, [])
        else:
            at = np.array([[r.trend + sum(w.w * math.exp(-0.5 * (((x - w.lon) / r.scale_lon) ** 2 + ((y - w.lat) / r.scale_lat) ** 2)) for w in r.weights)] for x, y in xy[:20]])
            assert np.abs(at[:, 0] - (np.cos(xy[:20, 0]) + m)).max() < 1e-3


def test_many_samples_are_solved():
    rng = np.random.default_rng(3)
    xy = rng.uniform(0, 5, (500, 2))
    field = np.sin(xy[:, :1]) * np.cos(xy[:, 1:]) + np.array([[1.0, 2.0]])
    for j, (trend, sx, sy, w) in enumerate(K.solve(xy, field)):
        again = trend + np.exp(-0.5 * (((xy[:, None] - xy[None]) / (sx, sy)) ** 2).sum(axis=2)) @ w
        assert np.abs(again - field[:, j]).max() < 1e-3


def test_mean_over_lattices_is_the_mean_over_points(spark):
    boxes = spark.createDataFrame([("a", -50.0, -49.5, -20.0, -19.2, 10), ("b", -50.0, -49.99, -20.0, -19.99, 200), ("c", -50.0, -49.99, -20.0, -19.99, 3)], "k string, min_lon double, max_lon double, min_lat double, max_lat double, n_points long")
    boxes = boxes.selectExpr("*", "(min_lon + max_lon) / 2 as c_lon", "(min_lat + max_lat) / 2 as c_lat", "(max_lon - min_lon) * 100 as width_km", "(max_lat - min_lat) * 110 as height_km")
    rng = np.random.default_rng(4)
    rows = [(k, float(x), float(y), float(v)) for k in "abc" for x, y, v in rng.random((6, 3)) + (-50, -20, 3)]
    fitted = K.fit_kriging(spark.createDataFrame(rows, "k string, lon double, lat double, v double"), ["k"], ("lon", "lat"), ["v"])
    made = {r.k: r.v for r in K.predict_kriging(fitted, boxes.select("k", S.grid_lattices().alias("lattices")), ["k"], ["v"], ["k"]).collect()}
    points = {r.k: r.points for r in boxes.select("k", S.grid_points().alias("points")).collect()}
    assert {k: len(p) for k, p in points.items()} == {"a": 6 * 9 + 1, "b": 5, "c": 1}
    for r in fitted.collect():
        each = [r.trend + sum(w.w * math.exp(-0.5 * (((p.lon - w.lon) / r.scale_lon) ** 2 + ((p.lat - w.lat) / r.scale_lat) ** 2)) for w in r.weights) for p in points[r.k]]
        assert made[r.k] == pytest.approx(np.mean(each), rel=1e-9, abs=1e-9 * max(abs(w.w) for w in r.weights))


def test_station_month_needs_all_variables(spark):
    rows = [("s", 2020, 1, *[1.0] * 7), ("s", 2020, 1, *[2.0] * 7), ("s", 2020, 2, None, *[1.0] * 6)]
    history = spark.createDataFrame(rows, "station_code string, year int, month int, " + ", ".join(f"{v} double" for v in WEATHER))
    got = station_months(history).collect()
    assert [(r.month, r.temp_max) for r in got] == [(dt.date(2020, 1, 1), 1.0)]
    assert station_months(history.where(F.lit(False))).count() == 0
