from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plan_text import plan
from pingloom.functions import labels, motion
from pingloom.operators import legacy, quality, serialize
from pingloom.operators.latest import latest
from pingloom.plans.lookup import MODES, Positions, StationNotFound, with_eta

T0 = datetime(2024, 1, 1)
DDL = (
    "bus_id string, ruta string, estado string, escenario string, timestamp timestamp, ingested_at timestamp, "
    "arrival_seq bigint, lat double, lon double, velocidad_kmh double"
)


@pytest.fixture(scope="module")
def positions(spark):
    rows = [
        ("a", "R1", "EN_RUTA", "HORA_PICO", T0, T0, 1, 4.60, -74.10, 20.0),
        ("a", "R2", "EN_PARADA", "HORA_PICO", T0 + timedelta(hours=1), T0 + timedelta(hours=1), 2, 4.61, -74.10, 0.0),
        ("b", "R1", "EN_RUTA", "HORA_VALLE", T0 + timedelta(hours=2), T0, 3, 4.70, -74.10, 30.0),
        ("c", "R1", "EN_PARADA", "HORA_VALLE", None, T0, 4, 4.60, -74.00, None),
    ]
    rows += [("d", "R9", "EN_RUTA", "BUS_VARADO", T0 + timedelta(minutes=i), T0, 10 + i, 4.5, -74.0, 5.0) for i in range(25)]
    history = spark.createDataFrame(rows, DDL)
    stations = spark.createDataFrame(
        [(1, "Norte", Decimal("4.60"), Decimal("-74.10"), "P"), (2, "Lejos", Decimal(10), Decimal(-60), "E")],
        "id int, nombre string, latitud decimal(9,6), longitud decimal(9,6), tipo string",
    )
    return Positions(latest(history), history, stations)


def buses(df):
    return [r["bus_id"] for r in df.collect()]


def test_modes(positions):
    assert sorted(MODES) == ["all", "escenario", "estaciones", "history", "near_buses", "near_station", "route", "status"]
    with pytest.raises(ValueError, match="unknown mode"):
        positions.lookup("nearby")


def test_filters_apply_to_the_latest_position_only(positions):
    # the first ping of "a" was on R1, its latest is not
    assert buses(positions.lookup("route", ruta="R1")) == ["b", "c"]
    assert buses(positions.lookup("status", estado="EN_PARADA")) == ["a", "c"]
    assert buses(positions.lookup("escenario", escenario="HORA_VALLE")) == ["b", "c"]


def test_newest_first_and_unknown_time_last(positions):
    assert buses(positions.every()) == ["b", "a", "d", "c"]


def test_filter_precedence(positions):
    assert buses(positions.by_filters(ruta="R9", estado="EN_PARADA", escenario="HORA_VALLE")) == ["b", "c"]
    assert buses(positions.by_filters(ruta="R9", estado="EN_PARADA")) == ["a", "c"]
    assert buses(positions.by_filters(ruta="R9")) == ["d"]
    assert len(buses(positions.by_filters())) == 4


def test_history_limits(positions):
    assert positions.lookup("history", bus_id="d").count() == 20
    assert positions.lookup("history", bus_id="d", limit="3").count() == 3
    assert positions.lookup("history", bus_id="d", limit="0").count() == 25
    assert [r["arrival_seq"] for r in positions.lookup("history", bus_id="d", limit=2).collect()] == [34, 33]
    assert "TakeOrderedAndProject" in plan(positions.lookup("history", bus_id="d"))


def test_near_defaults(positions):
    assert buses(positions.lookup("near_buses", lat="4.61", lon="-74.1")) == ["a"]
    assert buses(positions.lookup("near_station", id="1")) == ["a", "c", "b", "d"]
    assert buses(positions.lookup("near_station", id=2)) == []
    with pytest.raises(StationNotFound):
        positions.lookup("near_station", id=3)


def test_combined(positions):
    kinds = positions.lookup("all").groupBy("clase").count().collect()
    assert dict(tuple(r) for r in kinds) == {"bus": 4, "estacion": 2}
    assert positions.lookup("estaciones").count() == 2


def test_eta(spark):
    df = spark.createDataFrame([(1000.04, 30.0), (1000.0, 0.0), (1000.0, None), (1000.0, -5.0)], "distancia_m double, velocidad_kmh double")
    got = [(r["eta_min"], r["eta"]) for r in with_eta(df).collect()]
    assert got == [(2.0, "2.0 min"), (None, "N/A"), (None, "N/A"), (None, "N/A")]


@pytest.mark.parametrize(
    "scenario, fraction, expected",
    [
        ("BUS_VARADO", 0.5, "DETENIDO"), ("BUS_VARADO", 0.0, "DETENIDO"), ("HORA_PICO", 0.05, "EN_PARADA"),
        ("HORA_PICO", 0.95, "EN_PARADA"), ("HORA_VALLE", 7.0, "EN_PARADA"), ("HORA_VALLE", -6.0, "EN_PARADA"),
        ("HORA_VALLE", 0.5, "EN_RUTA"),
    ],
)
def test_status(spark, scenario, fraction, expected):
    assert spark.range(1).select(motion.status(F.lit(scenario), F.lit(fraction)).alias("s")).first()["s"] == expected


def test_progress(spark):
    df = spark.createDataFrame(
        [(3, 10, "IDA"), (3, 10, "VUELTA"), (7, 1, "IDA"), (7, 1, "VUELTA"), (1, 0, "IDA"), (None, 10, "IDA")],
        "step int, steps int, way string",
    )
    got = df.select(
        F.round(motion.progress(F.col("step"), F.col("steps"), F.col("way")), 3).alias("f"),
        motion.steps_remaining(F.col("steps"), F.col("step")).alias("left"),
    ).collect()
    assert [r["f"] for r in got] == [0.3, 0.7, 7.0, -6.0, None, None]
    assert [r["left"] for r in got] == [7, 7, 0, 0, 0, None]


def test_out_of_range_progress(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (7.0,), (-6.0,), (None,)], "fraccion double")
    assert sorted(r["fraccion"] for r in quality.invalid_progress(df).collect()) == [-6.0, 7.0]


def test_labels(spark):
    row = spark.range(1).select(
        labels.station_kind(F.lit("P")).alias("p"), labels.station_kind(F.lit(None).cast("string")).alias("e"),
        labels.segment_label(F.lit("A"), F.lit("B")).alias("t"), motion.scenario(F.lit("hora_pico")).alias("u"),
    ).first()
    assert tuple(row) == ("Portal", "Estación", "A → B", "HORA_PICO")


def test_json_forms(spark):
    df = spark.sql("SELECT 1 AS id, cast(4.5 AS decimal(9,6)) AS latitud, timestamp'2024-01-01 10:00:00' AS t, cast(NULL AS string) AS n")
    assert serialize.as_json(df).first()["json"] == '{"id":1,"latitud":4.5,"t":"2024-01-01T10:00:00.000000","n":null}'
    assert tuple(serialize.as_text(df).first()) == (1, "4.500000", "2024-01-01 10:00:00", None)


def test_old_documents(spark):
    old = spark.createDataFrame(
        [("x", ("Point", [-74.0, 4.6]), None, None)],
        "_id string, last_position struct<type: string, coordinates: array<double>>, speed double, status string",
    )
    current = spark.createDataFrame([("y", -74.1, 4.7, "EN_RUTA", 3.0, "R1")], "bus_id string, lon double, lat double, estado string, velocidad_kmh double, ruta string")
    rows = sorted(tuple(r) for r in legacy.read_together(current, old).collect())
    assert rows == [("x", -74.0, 4.6, "DESCONOCIDO", 0.0, None), ("y", -74.1, 4.7, "EN_RUTA", 3.0, "R1")]
