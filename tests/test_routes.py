import random

import pytest

from pingloom.operators import ordered
from pingloom.plans import routes

DDL = "ruta_id int, orden int, estacion_id int, nombre string, lat double, lon double"


def stops_of(spec, seed=0):
    """spec: {route: number of stops}"""
    rows = [
        (route, i * 3 % 1000 if count > 5 else i, i, f"s{i}", 4.0 + i / 1e4, -74.0)
        for route, count in spec.items()
        for i in range(count)
    ]
    random.Random(seed).shuffle(rows)
    return rows


def expected_segments(rows):
    pairs = []
    for route in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == route), key=lambda r: (r[1], r[2]))
        pairs += [(route, a[2], b[2]) for a, b in zip(mine, mine[1:])]
    return sorted(pairs, key=str)


def test_segments(spark):
    rows = stops_of({1: 3, 2: 1, 3: 2000, 4: 700, None: 400})
    df = spark.createDataFrame(rows, DDL)
    got = routes.segments(df)
    found = sorted(((r["ruta_id"], r["inicio_id"], r["fin_id"]) for r in got.collect()), key=str)
    assert found == expected_segments(rows)


def test_segment_columns(spark):
    df = spark.createDataFrame(stops_of({1: 3}), DDL)
    first = routes.segments(df).orderBy("orden").first()
    assert (first["tramo"], first["lat_a"], first["lat_b"]) == ("s0 → s1", 4.0, 4.0001)


def test_copies_are_neighbours_of_each_other(spark):
    rows = [(1, 1, 1, "a", 4.0, -74.0)] * 500 + [(1, 2, 2, "b", 4.1, -74.0)]
    df = spark.createDataFrame(rows, DDL)
    got = routes.segments(df).groupBy("inicio_id", "fin_id").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 499), (1, 2, 1)]


def test_positions_in_group(spark):
    rows = stops_of({1: 3, 3: 1500, None: 300})
    placed = ordered.with_position(spark.createDataFrame(rows, DDL), ["ruta_id"], ["orden", "estacion_id"])
    got = {(r["ruta_id"], r["estacion_id"]): r["_pos"] for r in placed.collect()}
    for route in (1, 3, None):
        mine = sorted((r for r in rows if r[0] == route), key=lambda r: (r[1], r[2]))
        assert [got[(route, r[2])] for r in mine] == list(range(len(mine)))


def test_lines_come_in_pieces_that_share_their_ends(spark):
    rows = stops_of({1: 7, 2: 250, 3: 101, 4: 1, 5: 2})
    lines = routes.route_lines(spark.createDataFrame(rows, DDL), piece_edges=100)
    got = {(r["ruta_id"], r["pieza"]): [p["lat"] for p in r["linea"]] for r in lines.collect()}
    sizes = {1: [7], 2: [101, 101, 50], 3: [101], 4: [1], 5: [2]}
    for route, wanted in sizes.items():
        mine = [r[4] for r in sorted((r for r in rows if r[0] == route), key=lambda r: (r[1], r[2]))]
        pieces = [got[k] for k in sorted(k for k in got if k[0] == route)]
        assert [len(p) for p in pieces] == wanted
        edges = [e for p in pieces for e in zip(p, p[1:])]
        assert edges == list(zip(mine, mine[1:]))


def test_a_stop_without_a_place_in_the_route_comes_last(spark):
    rows = [(1, None, 9, "last", 4.9, -74.0), (1, 2, 2, "b", 4.2, -74.0), (1, 1, 1, "a", 4.1, -74.0)]
    df = spark.createDataFrame(rows, DDL)
    assert [(r["inicio_id"], r["fin_id"]) for r in routes.segments(df).orderBy("inicio_id").collect()] == [(1, 2), (2, 9)]
    assert [p["lat"] for p in routes.route_lines(df).first()["linea"]] == [4.1, 4.2, 4.9]


def test_only_official_stops_make_a_line(spark):
    rows = [(r, i, i, f"s{i}", 4.0 + i, -74.0, official) for r in (1, 2) for i, official in enumerate([True, False, True, r == 1])]
    df = spark.createDataFrame(rows, DDL + ", parada boolean")
    found = {}
    for r in routes.segments(df).collect():
        found.setdefault(r["ruta_id"], []).append((r["inicio_id"], r["fin_id"]))
    assert {k: sorted(v) for k, v in found.items()} == {1: [(0, 2), (2, 3)], 2: [(0, 2)]}
    usable = {r["ruta_id"]: r["tramos"] for r in routes.usable_routes(df.filter("parada")).collect()}
    assert usable == {k: len(v) for k, v in found.items()}


def test_usable_routes(spark):
    df = spark.createDataFrame(stops_of({1: 3, 2: 1}), DDL)
    assert [tuple(r) for r in routes.usable_routes(df).collect()] == [(1, 3, 2)]
