import math
import random

import pytest
from pyspark.sql import functions as F

from plan_text import plan
from pingloom.functions import geo
from pingloom.operators import near


def metres(a, b):
    (lat1, lon1), (lat2, lon2) = a, b
    h = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    h += math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


def scattered(place, count, seed):
    rng = random.Random(seed)
    if place == "city":
        return [(rng.uniform(4.45, 4.85), rng.uniform(-74.3, -73.9)) for _ in range(count)]
    if place == "crowded cell":
        return [(4.6 + rng.gauss(0, 0.002), -74.1 + rng.gauss(0, 0.002)) for _ in range(count)]
    if place == "date line":
        return [(rng.uniform(-2, 2), rng.choice([rng.uniform(178, 180), rng.uniform(-180, -178)])) for _ in range(count)]
    if place == "pole":
        return [(rng.uniform(88.5, 90), rng.uniform(-180, 180)) for _ in range(count)]
    return [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(count)]


PLACES = [("city", 2000.0), ("city", 200.0), ("crowded cell", 300.0), ("date line", 60000.0), ("pole", 90000.0),
          ("globe", 3000000.0), ("globe", 12000000.0)]


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(spark, request):
    """Stations small enough to be broadcast, and too large for it."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    if request.param == "shuffle":
        spark.conf.set(key, "-1")
    yield request.param
    spark.conf.unset(key)


@pytest.mark.parametrize("place, radius", PLACES)
def test_join_equals_brute_force(spark, place, radius, join_kind):
    points, stops = scattered(place, 300, 1), scattered(place, 60, 2)
    positions = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(-1, None, None)], "pid int, lat double, lon double")
    stations = spark.createDataFrame([(i, *s) for i, s in enumerate(stops)] + [(-1, None, 1.0)], "id int, lat double, lon double")
    expected = {(i, j) for i, p in enumerate(points) for j, s in enumerate(stops) if metres(p, s) <= radius}
    joined = near.near_join(positions, stations, radius)
    got = [(r["pid"], r["estacion_id"]) for r in joined.collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected
    text = plan(joined)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_near_point_is_inclusive_sorted_and_skips_unknown_places(spark):
    points = scattered("city", 200, 3)
    df = spark.createDataFrame([(f"b{i}", *p) for i, p in enumerate(points)] + [("x", None, None)], "bus_id string, lat double, lon double")
    centre = (4.65, -74.1)
    found = near.near_point(df, *centre, 5000.0).collect()
    expected = sorted((metres(p, centre), f"b{i}") for i, p in enumerate(points) if metres(p, centre) <= 5000)
    assert [r["bus_id"] for r in found] == [b for _, b in expected]
    assert found[-1]["distancia_m"] == pytest.approx(expected[-1][0])
    assert near.near_point(df, *points[0], 0.0).count() == 1


@pytest.mark.parametrize("lat, lon, radius", [(89.9, 0, 50000.0), (0, 179.9, 50000.0), (-89.99, 10, 5000.0), (10, -180, 1000.0)])
def test_near_point_at_the_edges(spark, lat, lon, radius):
    place = "pole" if abs(lat) > 80 else "date line"
    points = [(math.copysign(p[0], lat), p[1]) if place == "pole" else p for p in scattered(place, 400, 4)]
    df = spark.createDataFrame([(str(i), *p) for i, p in enumerate(points)], "bus_id string, lat double, lon double")
    expected = {str(i) for i, p in enumerate(points) if metres(p, (lat, lon)) <= radius}
    assert {r["bus_id"] for r in near.near_point(df, lat, lon, radius).collect()} == expected


def test_range_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("a", 4.6, -74.0)], "bus_id string, lat double, lon double").write.parquet(path)
    text = plan(near.near_point(spark.read.parquet(path), 4.65, -74.1, 1000.0))
    assert "GreaterThanOrEqual(lat" in text.split("PushedFilters")[1]
    assert "lon#" in text.split("DataFilters")[1]


def test_distance_of_unknown_place_is_null(spark):
    row = spark.range(1).select(geo.haversine_m(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0)).alias("d"))
    assert row.first()["d"] is None


def test_opposite_points(spark):
    row = spark.range(1).select(geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("d"))
    assert row.first()["d"] == pytest.approx(math.pi * geo.EARTH_RADIUS_M)


def test_interpolation_ends(spark):
    row = spark.range(1).select(
        geo.interpolate(F.lit(4.0), F.lit(5.0), F.lit(0.0)).alias("a"), geo.interpolate(F.lit(4.0), F.lit(5.0), F.lit(1.0)).alias("b")
    ).first()
    assert (row["a"], row["b"]) == (4.0, 5.0)
