from dataclasses import replace

import pytest

from plan_text import plan
from pingloom import schemas
from pingloom.plans import network
from pingloom.sources import network_tables
from pingloom.sources.network_tables import Network

ROWS = {
    "estacion": [(1, "Norte", None, None, "P", "ok", "c1"), (2, "Sur", None, None, "E", "ok", "c2")],
    "ruta": [(1, "B74", "uno", "ok", 1, 2, None), (2, "C1", "dos", "ok", 1, 99, None), (3, None, "tres", "ok", None, 2, None),
             (4, "B74", "uno", "ok", 1, 1, None)],
    "estacion_por_ruta": [(1, 2, 2, True, None), (1, 1, 1, None, None), (2, 1, 1, False, None), (1, 1, 3, True, None)],
    "bus": [(10, 1, 1, "ZZ", "m", "ok", None), (11, 1, 2, "AA", "m", "ok", None), (12, 4, 1, "MM", "m", "ok", None),
            (13, None, 1, "XX", "m", "ok", None), (14, 2, 99, "YY", "m", "ok", None)],
    "tipo_bus": [(1, "articulado"), (2, "biarticulado")],
    "persona": [(1, "n1", "a1", "d1", 1, 1, "ACTIVO", None), (2, "n2", "a2", "d2", 1, 1, None, None),
                (3, "n3", "a3", "d3", 7, 1, "ACTIVO", None)],
    "tipo_persona": [(1, "usuario"), (2, "conductor")],
    "tipo_documento": [(1, "CC"), (2, "CE")],
}


@pytest.fixture(scope="module")
def net(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("network")
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, schemas.NETWORK[name]).write.parquet(f"{folder}/{name}")
    return Network.from_parquet(spark, str(folder))


def rows(df, *names):
    return [tuple(r) for r in (df.select(*names) if names else df).collect()]


def test_buses(net):
    assert rows(network.buses_by_route(net), "ruta_codigo", "placa", "tipo_bus") == [
        ("B74", "AA", "biarticulado"), ("B74", "MM", "articulado"), ("B74", "ZZ", "articulado"),
    ]
    assert rows(network.buses_of_route(net, "B74"), "placa") == [("AA",), ("MM",), ("ZZ",)]
    assert rows(network.buses_of_route(net, "' OR 1=1 --")) == []


def test_stops(net):
    assert rows(network.stations_by_route(net), "ruta_codigo", "orden", "estacion_nombre") == [
        ("B74", 1, "Norte"), ("B74", 2, "Sur"), ("B74", 3, "Norte"), ("C1", 1, "Norte"),
    ]
    assert rows(network.official_stops(net), "orden", "parada") == [(2, True), (3, True)]
    assert rows(network.official_stops_of_route(net, "B74"), "id") == [(2,), (1,)]


def test_route_ends_keep_unknown_stations_and_sort_nulls_last(net):
    assert set(rows(network.route_ends(net), "ruta_codigo", "origen", "destino")) == {
        ("B74", "Norte", "Sur"), ("B74", "Norte", "Norte"), ("C1", "Norte", None), (None, None, "Sur"),
    }
    assert rows(network.route_ends(net), "ruta_codigo")[-1] == (None,)


def test_counts_keep_zeros_and_group_by_name(net):
    assert rows(network.bus_count_per_route(net)) == [("B74", "uno", 3), ("C1", "dos", 1), (None, "tres", 0)]
    assert rows(network.users_by_person_type(net)) == [("conductor", 0), ("usuario", 3)]
    assert rows(network.users_by_document_type(net)) == [("CC", 2), ("CE", 0)]


def test_users(net):
    assert rows(network.user_total(net)) == [(3,)]
    assert rows(network.users_by_status(net)) == [("ACTIVO", 2), (None, 1)]
    assert rows(network.user_listing(net), "id", "tipo_documento") == [(1, "CC"), (2, "CC")]


def test_station_scan_reads_five_columns(net):
    text = plan(network_tables.stations(net))
    assert text.split("ReadSchema")[1].count(":") == 6 and "direccion" not in text.split("ReadSchema")[1]


def test_hot_route_is_split_when_both_sides_shuffle(spark, net):
    """A route with a third of all vehicles, joined without any broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    count = 120_000
    bus = spark.range(count, numPartitions=8).selectExpr(
        "cast(id as int) AS id", "if(id % 3 = 0, 7, cast(id % 500 as int)) AS ruta_id", "1 AS tipo_bus_id",
        "cast(id as string) AS placa", "uuid() AS modelo", "'ok' AS estado", "cast(null as date) AS fecha_asignacion",
    )
    ruta = spark.range(500).selectExpr(
        "cast(id as int) AS id", "concat('R', id) AS codigo", "'x' AS nombre", "'ok' AS estado",
        "1 AS estacion_origen_id", "1 AS estacion_destino_id", "cast(null as timestamp) AS fecha_creacion",
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        report = network.buses_by_route(replace(net, bus=bus, ruta=ruta))
        assert len(report.collect()) == count
        assert "skew=true" in plan(report)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_tables_of_a_database_have_options_of_their_own():
    tables = {"persona": network_tables.parallel("id", 1, 1000, 8)}
    own = network_tables.jdbc_options("persona", "jdbc:x", "s", tables, user="u")
    assert own["dbtable"] == "s.persona" and own["partitionColumn"] == "id" and own["numPartitions"] == "8" and own["user"] == "u"
    assert "partitionColumn" not in network_tables.jdbc_options("estacion_por_ruta", "jdbc:x", "s", tables)
    with pytest.raises(ValueError):
        network_tables.jdbc_options("persona", "jdbc:x", "s", {"persons": {}})
