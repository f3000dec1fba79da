"""The given tables dressed as telemetry and network tables.

The SQL here has a twin in ``oracle.py``; both derive every value from the same columns by the same
arithmetic, so results can be compared across engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingloom.functions import geo
from pingloom.session import require_utc
from pingloom.sources.network_tables import Network


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    require_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Every event as a position, in and outside of the service area.

    Arrival lags the event by 0 to 99 hours, so arrival order and event order disagree. ``spread`` deals the events over
    all tasks before anything is made of them: a file of one row group is read by a single one.
    """
    events = table(spark, sf_dir, "events")
    if spread:
        events = events.repartition("event_id", "ts", "user_id")
    keyed = events.selectExpr(
        "*", "cast(get_json_object(props, '$.k') as int) AS k", "cast(ts as timestamp) AS event_ts"
    )
    return keyed.selectExpr(
        "concat('B', cast(user_id AS string)) AS bus_id",
        "concat('R', cast(user_id % 12 AS string)) AS ruta",
        "CASE k % 3 WHEN 0 THEN 'HORA_VALLE' WHEN 1 THEN 'HORA_PICO' ELSE 'BUS_VARADO' END AS escenario",
        "CASE event_type WHEN 'error' THEN 'DETENIDO' WHEN 'click' THEN 'EN_PARADA' ELSE 'EN_RUTA' END AS estado",
        "CASE WHEN k % 2 = 0 THEN 'IDA' ELSE 'VUELTA' END AS direccion",
        "event_ts AS timestamp",
        "timestampadd(SECOND, k * 3600, event_ts) AS ingested_at",
        "event_id AS arrival_seq",
        "-74.3e0 + cast((event_id * 104729) % 40001 AS double) / 1e5 AS lon",
        "4.45e0 + cast((event_id * 7919) % 50001 AS double) / 1e5 AS lat",
        "value AS velocidad_kmh",
        """named_struct('inicio', concat('E', cast(user_id % 7 AS string)),
                        'fin', concat('E', cast(user_id % 7 + 1 AS string)),
                        'fraccion', cast(k AS double) / 100e0) AS tramo""",
        """named_struct('steps_per_segment', CASE k % 3 WHEN 0 THEN 10 WHEN 1 THEN 20 ELSE 1 END,
                        'current_step', k % 21,
                        'steps_remaining', greatest(CASE k % 3 WHEN 0 THEN 10 WHEN 1 THEN 20 ELSE 1 END - k % 21, 0)
                       ) AS metrics_runtime""",
        "false AS ts_imputed",
        "cast(NULL AS map<string, string>) AS extra",
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions inside the service area."""
    return positions(spark, sf_dir).filter(geo.in_box(F.col("lat"), F.col("lon")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history in document form, with a GeoJSON location."""
    rows = history(spark, sf_dir)
    return rows.withColumn("location", geo.geojson_point(F.col("lon"), F.col("lat"))).drop("lon", "lat")


def raw_pings(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Every event as a raw JSON ping; the event number decides which defect, if any, it carries."""
    pos = positions(spark, sf_dir, spread)
    stamp = "date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    cleaned = pos.selectExpr("*", "arrival_seq % 20 AS defect", f"{stamp} AS stamp")
    coordinates = """CASE defect
        WHEN 1 THEN concat('[', lon, ',0]')
        WHEN 7 THEN '[null,null]'
        WHEN 8 THEN concat('[', lon, ']')
        ELSE concat('[', lon, ',', lat, ']') END"""
    when = """CASE defect
        WHEN 6 THEN 'x'
        WHEN 10 THEN concat(stamp, 'Z')
        WHEN 11 THEN concat(stamp, '-05:00')
        ELSE stamp END"""
    ping = f"""concat(
        '{{"ruta":"', ruta, '","timestamp":"', {when}, '"',
        CASE WHEN defect = 0 THEN '' ELSE concat(',"bus_id":"', bus_id, '"') END,
        CASE WHEN defect = 7 THEN concat(',"lat":', lat, ',"lon":', lon) ELSE '' END,
        ',"location":{{"type":"Point","coordinates":', {coordinates}, '}}',
        ',"estado":"', estado, '","escenario":"', escenario, '","direccion":"', direccion, '"',
        ',"velocidad_kmh":', CASE WHEN defect = 3 THEN '"n/a"' ELSE cast(velocidad_kmh AS string) END,
        CASE defect
          WHEN 2 THEN ',"tramo":null'
          WHEN 9 THEN ''
          ELSE concat(',"tramo":{{"inicio":"', tramo.inicio, '","fin":"', tramo.fin,
                      '","fraccion":', tramo.fraccion,
                      CASE WHEN defect = 16 THEN ',"meta":{{"zona":{{"x":1}}}}' ELSE '' END, '}}') END,
        CASE WHEN defect = 9 THEN '' ELSE concat(
          ',"metrics_runtime":{{"steps_per_segment":', metrics_runtime.steps_per_segment,
          CASE WHEN defect = 15 THEN '.0' ELSE '' END,
          ',"current_step":', metrics_runtime.current_step,
          ',"steps_remaining":', metrics_runtime.steps_remaining, '}}') END,
        CASE WHEN defect = 12 THEN ',"firmware":"v2"' ELSE '' END,
        CASE WHEN defect = 4 THEN '' ELSE '}}' END)"""
    return cleaned.withColumn("ping", F.expr(ping)).selectExpr(
        "arrival_seq AS seq",
        "ingested_at AS arrived_at",
        """CASE defect
             WHEN 5 THEN to_json(named_struct('body', ping))
             WHEN 13 THEN concat(ping, ping)
             WHEN 14 THEN concat(ping, ' ]')
             ELSE ping END AS value""",
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey AS int) AS id",
        "s_name AS nombre",
        "4.45e0 + cast((s_suppkey * 3571) % 40001 AS double) / 1e5 AS latitud",
        "-74.3e0 + cast((s_suppkey * 6151) % 40001 AS double) / 1e5 AS longitud",
        "CASE WHEN s_nationkey % 5 = 0 THEN 'P' ELSE 'E' END AS tipo",
    )


def fleet_network(spark: SparkSession, sf_dir: str) -> Network:
    """Routes are nations, vehicles and people are customers, stations are suppliers.

    Vehicles run on the routes of every third nation, which leaves routes without any; one
    person type and one document type belong to nobody.
    """
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    segments = customer.select("c_mktsegment").distinct().selectExpr("c_mktsegment AS id", "c_mktsegment AS nombre")
    person_types = segments.unionByName(
        table(spark, sf_dir, "region").filter("r_regionkey = 0").selectExpr("'NINGUNO' AS id", "'NINGUNO' AS nombre")
    )
    document_types = nation.selectExpr("n_nationkey AS id", "n_name AS nombre").unionByName(
        table(spark, sf_dir, "region").filter("r_regionkey = 0").selectExpr("-1 AS id", "'SIN DOCUMENTO' AS nombre")
    )
    return Network(
        estacion=stations(spark, sf_dir).selectExpr(
            "*", "'ACTIVA' AS estado", "concat('Calle ', cast(id AS string)) AS direccion"
        ),
        ruta=nation.selectExpr(
            "n_nationkey AS id",
            "concat('R', cast(n_nationkey AS string)) AS codigo",
            "n_name AS nombre",
            "CASE WHEN n_regionkey = 0 THEN 'INACTIVA' ELSE 'ACTIVA' END AS estado",
            "n_nationkey * 4 AS estacion_origen_id",
            "n_nationkey * 9 AS estacion_destino_id",
            "timestampadd(DAY, n_nationkey, timestamp'2020-01-01 00:00:00') AS fecha_creacion",
        ),
        estacion_por_ruta=bridge_stops(spark, sf_dir),
        bus=customer.selectExpr(
            "cast(c_custkey AS int) AS id",
            "c_nationkey - c_nationkey % 3 AS ruta_id",
            "c_mktsegment AS tipo_bus_id",
            "concat('PL', cast(c_custkey AS string)) AS placa",
            "concat('M', cast(c_custkey % 5 AS string)) AS modelo",
            "CASE WHEN c_acctbal >= 0 THEN 'ACTIVO' ELSE 'TALLER' END AS estado",
            "date_add(date'2020-01-01', cast(c_custkey % 365 AS int)) AS fecha_asignacion",
        ),
        tipo_bus=segments,
        persona=customer.selectExpr(
            "cast(c_custkey AS int) AS id",
            "c_name AS nombres",
            "concat('A', cast(c_custkey AS string)) AS apellidos",
            "cast(c_custkey * 7 AS string) AS documento",
            "c_nationkey AS tipo_documento_id",
            "c_mktsegment AS tipo_persona_id",
            "CASE WHEN c_acctbal >= 0 THEN 'ACTIVO' END AS estado",
            "timestampadd(HOUR, cast(c_custkey AS int), timestamp'2021-01-01 00:00:00') AS fecha_creacion",
        ),
        tipo_persona=person_types,
        tipo_documento=document_types,
    )


def bridge_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stops of a route (the order); the line number is the place in the route."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey AS int) AS ruta_id",
        "cast(l_partkey AS int) AS estacion_id",
        "l_linenumber AS orden",
        "l_returnflag = 'R' AS parada",
        "cast(l_shipdate AS timestamp) AS fecha_creacion",
        "l_suppkey AS variante",
        "l_extendedprice AS tarifa",
        "l_quantity AS cantidad",
    )


def bridge_network(spark: SparkSession, sf_dir: str) -> Network:
    """Routes are orders, stops are order lines, stations are parts: large on every side."""
    fleet = fleet_network(spark, sf_dir)
    return Network(
        estacion=table(spark, sf_dir, "part").selectExpr(
            "cast(p_partkey AS int) AS id",
            "p_name AS nombre",
            "4.45e0 + cast((p_partkey * 3571) % 40001 AS double) / 1e5 AS latitud",
            "-74.3e0 + cast((p_partkey * 6151) % 40001 AS double) / 1e5 AS longitud",
            "CASE WHEN p_size % 5 = 0 THEN 'P' ELSE 'E' END AS tipo",
            "p_type AS estado",
            "p_brand AS direccion",
        ),
        ruta=table(spark, sf_dir, "orders").selectExpr(
            "cast(o_orderkey AS int) AS id",
            "concat('R', cast(o_orderkey AS string)) AS codigo",
            "o_orderpriority AS nombre",
            "o_orderstatus AS estado",
            "cast(o_custkey AS int) AS estacion_origen_id",
            "cast(o_custkey * 2 AS int) AS estacion_destino_id",
            "cast(o_orderdate AS timestamp) AS fecha_creacion",
        ),
        estacion_por_ruta=bridge_stops(spark, sf_dir),
        bus=fleet.bus,
        tipo_bus=fleet.tipo_bus,
        persona=fleet.persona,
        tipo_persona=fleet.tipo_persona,
        tipo_documento=fleet.tipo_documento,
    )


def located_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge stops with the name and place of their station."""
    net = bridge_network(spark, sf_dir)
    station = net.estacion.selectExpr("id AS estacion_id", "nombre", "latitud AS lat", "longitud AS lon")
    return net.estacion_por_ruta.join(station, "estacion_id")


def old_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as documents of the previous version; some lack a status or a speed."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('T', cast(c_custkey AS string)) AS _id",
        """named_struct('type', 'Point', 'coordinates',
             array(-74.3e0 + cast((c_custkey * 6151) % 40001 AS double) / 1e5,
                   4.45e0 + cast((c_custkey * 3571) % 40001 AS double) / 1e5)) AS last_position""",
        "CASE WHEN c_acctbal >= 0 THEN cast(c_nationkey AS double) + 0.5e0 END AS speed",
        "CASE WHEN c_nationkey % 4 <> 0 THEN 'EN_RUTA' END AS status",
    )
