"""SQL twins of the queries, for another engine on the same tables."""

from __future__ import annotations

from testbed import queries as q

_POS = """
e AS (SELECT *, cast(json_extract_string(props, '$.k') AS int) AS k FROM events),
pos AS (
  SELECT concat('B', cast(user_id AS varchar)) AS bus_id,
         concat('R', cast(user_id % 12 AS varchar)) AS ruta,
         CASE k % 3 WHEN 0 THEN 'HORA_VALLE' WHEN 1 THEN 'HORA_PICO' ELSE 'BUS_VARADO' END AS escenario,
         CASE event_type WHEN 'error' THEN 'DETENIDO' WHEN 'click' THEN 'EN_PARADA' ELSE 'EN_RUTA' END AS estado,
         CASE WHEN k % 2 = 0 THEN 'IDA' ELSE 'VUELTA' END AS direccion,
         ts AS "timestamp",
         ts + to_seconds(k * 3600) AS ingested_at,
         event_id AS arrival_seq,
         -74.3e0 + cast((event_id * 104729) % 40001 AS double) / 1e5 AS lon,
         4.45e0 + cast((event_id * 7919) % 50001 AS double) / 1e5 AS lat,
         value AS velocidad_kmh,
         concat('E', cast(user_id % 7 AS varchar)) AS tramo_inicio,
         concat('E', cast(user_id % 7 + 1 AS varchar)) AS tramo_fin,
         cast(k AS double) / 100e0 AS fraccion,
         cast(CASE k % 3 WHEN 0 THEN 10 WHEN 1 THEN 20 ELSE 1 END AS int) AS steps_per_segment,
         cast(k % 21 AS int) AS current_step
  FROM e),
hist AS (SELECT * FROM pos WHERE lat BETWEEN 4.45e0 AND 4.85e0 AND lon BETWEEN -74.3e0 AND -73.9e0)"""

_LATEST = _POS + """,
latest AS (
  SELECT * FROM hist
  QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY ingested_at DESC, arrival_seq DESC) = 1)"""

_STATIONS = """
estacion AS (
  SELECT cast(s_suppkey AS int) AS id, s_name AS nombre,
         4.45e0 + cast((s_suppkey * 3571) % 40001 AS double) / 1e5 AS latitud,
         -74.3e0 + cast((s_suppkey * 6151) % 40001 AS double) / 1e5 AS longitud,
         CASE WHEN s_nationkey % 5 = 0 THEN 'P' ELSE 'E' END AS tipo
  FROM supplier)"""

_FLAT = (
    'bus_id, ruta, escenario, estado, direccion, "timestamp", ingested_at, arrival_seq, lon, lat, velocidad_kmh'
)


def _metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"""2e0 * 6378100e0 * asin(sqrt(least(1e0,
      power(sin(radians({lat2} - {lat1}) / 2e0), 2e0)
      + cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2e0), 2e0))))"""


_FACT_COLUMNS = """bus_id, ruta, escenario, estado, "timestamp" AS ts_evento, ingested_at AS ts_ingesta,
       cast(floor(epoch(ingested_at)) AS bigint) - cast(floor(epoch("timestamp")) AS bigint) AS latencia_seg,
       cast("timestamp" AS date) AS fecha,
       cast(hour("timestamp") AS int) AS hora,
       cast(dayofweek("timestamp") + 1 AS int) AS dia_semana,
       round(lon, 6) AS lon, round(lat, 6) AS lat,
       round(velocidad_kmh, 2) + 0e0 AS velocidad_kmh_num,
       round(fraccion, 3) AS fraccion_num,
       tramo_inicio, tramo_fin,
       steps_per_segment AS steps_per_segment_num,
       current_step AS current_step_num,
       CASE WHEN steps_per_segment IS NOT NULL THEN cast(greatest(steps_per_segment - current_step, 0) AS int) END
           AS steps_remaining_num"""
_FACT = f"WITH {_POS} SELECT {_FACT_COLUMNS} FROM hist"


def _listing(where: str = "true", table: str = "latest", source: str = _LATEST) -> str:
    return f'WITH {source} SELECT {_FLAT} FROM {table} WHERE {where} ORDER BY "timestamp" DESC, bus_id'


def _place(order: str) -> str:
    return f"cast(row_number() OVER (ORDER BY {order}) AS int) AS puesto"


def _near(source: str, lat: str, lon: str, radius: float) -> str:
    return f"""
d AS (SELECT l.*, {_metres(lat, lon, 'l.lat', 'l.lon')} AS d FROM {source}),
w AS (SELECT *, CASE WHEN velocidad_kmh > 0
                     THEN round(round(d, 1) / (velocidad_kmh * 1000e0 / 60e0), 1) END AS eta_min
      FROM d WHERE d <= {radius!r})
SELECT {_place("d, bus_id")}, bus_id, ruta, estado, "timestamp", lat, lon, velocidad_kmh, round(d, 3) AS distancia_m,
       printf('%.1f', d) AS distancia, eta_min,
       CASE WHEN eta_min IS NULL THEN 'N/A' ELSE printf('%.1f min', eta_min) END AS eta
FROM w ORDER BY d, bus_id"""


_ALIVE = f"""WITH {_POS} SELECT {_FLAT} FROM hist
WHERE "timestamp" > TIMESTAMP '{q.AS_OF}' - INTERVAL 24 HOUR"""

# A ping's defect decides its fate; without one, only its place matters.
_JUDGED = _POS + """,
judged AS (
  SELECT *, arrival_seq % 20 AS defect,
         CASE WHEN arrival_seq % 20 IN (2, 4, 8, 13, 14) THEN 'malformed'
              WHEN arrival_seq % 20 IN (0, 1) THEN 'missing_required'
              WHEN NOT (lat BETWEEN 4.45e0 AND 4.85e0 AND lon BETWEEN -74.3e0 AND -73.9e0) THEN 'out_of_bounds'
              WHEN arrival_seq % 20 = 3 THEN 'malformed' END AS reject_reason
  FROM pos),
good AS (
  SELECT * REPLACE (
           CASE defect WHEN 6 THEN ingested_at WHEN 11 THEN "timestamp" + INTERVAL 5 HOUR ELSE "timestamp" END AS "timestamp",
           CASE WHEN defect <> 9 THEN tramo_inicio END AS tramo_inicio,
           CASE WHEN defect <> 9 THEN tramo_fin END AS tramo_fin,
           CASE WHEN defect <> 9 THEN fraccion END AS fraccion,
           CASE WHEN defect <> 9 THEN steps_per_segment END AS steps_per_segment,
           CASE WHEN defect <> 9 THEN current_step END AS current_step),
         defect = 6 AS ts_imputed,
         CASE WHEN defect <> 9 THEN cast(greatest(steps_per_segment - current_step, 0) AS int) END AS steps_remaining,
         CASE WHEN defect = 16 THEN 'tramo.meta' END AS extra_keys
  FROM judged WHERE reject_reason IS NULL)"""

_ACCEPTED_COLUMNS = (
    f"{_FLAT}, ts_imputed, tramo_inicio, tramo_fin, fraccion, steps_per_segment, current_step, steps_remaining, extra_keys"
)
_ACCEPTED = f"WITH {_JUDGED} SELECT {_ACCEPTED_COLUMNS} FROM good"
_REJECTED = f"WITH {_JUDGED} SELECT arrival_seq, ingested_at, reject_reason FROM judged WHERE reject_reason IS NOT NULL"
_STORED = _JUDGED + """,
newest AS (
  SELECT * FROM good
  QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY ingested_at DESC, arrival_seq DESC) = 1)"""
_INGESTED_LATEST = f"""WITH {_JUDGED}
SELECT {_FLAT} FROM good
QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY ingested_at DESC, arrival_seq DESC) = 1"""

# The relational tables of the two networks.
_FLEET = f"""{_STATIONS},
ruta AS (
  SELECT n_nationkey AS id, concat('R', cast(n_nationkey AS varchar)) AS codigo, n_name AS nombre,
         CASE WHEN n_regionkey = 0 THEN 'INACTIVA' ELSE 'ACTIVA' END AS estado,
         n_nationkey * 4 AS estacion_origen_id, n_nationkey * 9 AS estacion_destino_id,
         TIMESTAMP '2020-01-01 00:00:00' + to_days(n_nationkey) AS fecha_creacion
  FROM nation),
bus AS (
  SELECT cast(c_custkey AS int) AS id, c_nationkey - c_nationkey % 3 AS ruta_id, c_mktsegment AS tipo_bus,
         concat('PL', cast(c_custkey AS varchar)) AS placa, concat('M', cast(c_custkey % 5 AS varchar)) AS modelo,
         CASE WHEN c_acctbal >= 0 THEN 'ACTIVO' ELSE 'TALLER' END AS estado,
         DATE '2020-01-01' + cast(c_custkey % 365 AS int) AS fecha_asignacion
  FROM customer),
persona AS (
  SELECT cast(c_custkey AS int) AS id, c_name AS nombres, concat('A', cast(c_custkey AS varchar)) AS apellidos,
         cast(c_custkey * 7 AS varchar) AS documento, c_nationkey AS tipo_documento_id,
         c_mktsegment AS tipo_persona_id, CASE WHEN c_acctbal >= 0 THEN 'ACTIVO' END AS estado,
         TIMESTAMP '2021-01-01 00:00:00' + to_hours(cast(c_custkey AS int)) AS fecha_creacion
  FROM customer),
tipo_persona AS (SELECT DISTINCT c_mktsegment AS id, c_mktsegment AS nombre FROM customer UNION ALL SELECT 'NINGUNO', 'NINGUNO'),
tipo_documento AS (SELECT n_nationkey AS id, n_name AS nombre FROM nation UNION ALL SELECT -1, 'SIN DOCUMENTO')"""

_BUSES = f"""WITH {_FLEET}
SELECT {_place("r.codigo, b.placa, b.id")}, r.codigo AS ruta_codigo, r.nombre AS ruta_nombre, b.id AS bus_id, b.placa, b.modelo, b.tipo_bus,
       b.estado AS estado_bus, b.fecha_asignacion
FROM bus b JOIN ruta r ON r.id = b.ruta_id"""

_BRIDGE = """
stops AS (
  SELECT cast(l_orderkey AS int) AS ruta_id, cast(l_partkey AS int) AS estacion_id, l_linenumber AS orden,
         l_returnflag = 'R' AS parada, l_shipdate AS fecha_creacion, l_suppkey AS variante, l_quantity AS cantidad,
         p_name AS nombre, p_type, p_brand, CASE WHEN p_size % 5 = 0 THEN 'P' ELSE 'E' END AS tipo,
         4.45e0 + cast((p_partkey * 3571) % 40001 AS double) / 1e5 AS lat,
         -74.3e0 + cast((p_partkey * 6151) % 40001 AS double) / 1e5 AS lon,
         concat('R', cast(o_orderkey AS varchar)) AS ruta_codigo, o_orderpriority AS ruta_nombre
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey)"""

# Without the route table: geometry needs official stops and stations only.
_LINE = """
stops AS (
  SELECT cast(l_orderkey AS int) AS ruta_id, cast(l_partkey AS int) AS estacion_id, l_linenumber AS orden,
         l_suppkey AS variante, l_quantity AS cantidad, p_name AS nombre,
         4.45e0 + cast((p_partkey * 3571) % 40001 AS double) / 1e5 AS lat,
         -74.3e0 + cast((p_partkey * 6151) % 40001 AS double) / 1e5 AS lon
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R')"""

_SEGMENTS = _LINE + """,
seg AS (
  SELECT ruta_id, orden, variante, cantidad, estacion_id AS inicio_id, nombre AS inicio, lat AS lat_a, lon AS lon_a,
         lead(estacion_id) OVER w AS fin_id, lead(nombre) OVER w AS fin, lead(lat) OVER w AS lat_b, lead(lon) OVER w AS lon_b
  FROM stops WINDOW w AS (PARTITION BY ruta_id ORDER BY orden, estacion_id, variante))"""

_RULES = _POS + """,
r AS (
  SELECT *, CASE WHEN direccion = 'VUELTA' THEN 1e0 - cast(current_step AS double) / steps_per_segment
                 ELSE cast(current_step AS double) / steps_per_segment END AS f FROM pos)"""


def _profile() -> str:
    columns = [c.strip() for c in _ACCEPTED_COLUMNS.split(",")]
    parts = [
        f"""SELECT '{c.strip('"')}' AS columna, count(*) AS filas, count(*) - count({c}) AS nulos, count({c}) AS no_nulos FROM good"""
        for c in columns
    ]
    return f"WITH {_JUDGED} " + " UNION ALL ".join(parts)


def _drift() -> str:
    """Fields of the raw pings with the condition under which a document holds them."""
    whole = "defect NOT IN (4, 13, 14)"
    rows = [(f, "STRING", "STRING", whole, "igual") for f in ("ruta", "timestamp", "estado", "escenario", "direccion")]
    rows += [
        ("bus_id", "STRING", "STRING", f"{whole} AND defect <> 0", "igual"),
        ("location", "OBJECT", "OBJECT", whole, "igual"),
        ("location.type", "STRING", "STRING", whole, "igual"),
        ("location.coordinates", "ARRAY", "ARRAY", whole, "igual"),
        ("lat", "NUMBER", "NUMBER", "defect = 7", "igual"),
        ("lon", "NUMBER", "NUMBER", "defect = 7", "igual"),
        ("velocidad_kmh", "NUMBER", "NUMBER", f"{whole} AND defect <> 3", "igual"),
        ("velocidad_kmh", "NUMBER", "STRING", "defect = 3", "tipo"),
        ("tramo", "OBJECT", "OBJECT", f"{whole} AND defect NOT IN (2, 9)", "igual"),
        ("tramo", "OBJECT", "NULL", "defect = 2", "igual"),
        ("metrics_runtime", "OBJECT", "OBJECT", f"{whole} AND defect <> 9", "igual"),
        ("firmware", None, "STRING", "defect = 12", "agregado"),
        ("tramo.meta", None, "OBJECT", "defect = 16", "agregado"),
        ("tramo.meta.zona", None, "OBJECT", "defect = 16", "agregado"),
        ("tramo.meta.zona.x", None, "NUMBER", "defect = 16", "agregado"),
        ("$", None, "INVALID", "defect IN (4, 13, 14)", "ilegible"),
    ]
    for name, kind in (("inicio", "STRING"), ("fin", "STRING"), ("fraccion", "NUMBER")):
        rows.append((f"tramo.{name}", kind, kind, f"{whole} AND defect NOT IN (2, 9)", "igual"))
    for name in ("steps_per_segment", "current_step", "steps_remaining"):
        rows.append((f"metrics_runtime.{name}", "NUMBER", "NUMBER", f"{whole} AND defect <> 9", "igual"))

    def quoted(text: str | None) -> str:
        return "cast(NULL AS varchar)" if text is None else f"'{text}'"

    parts = [
        f"SELECT {quoted(f)} AS campo, {quoted(reg)} AS tipo_registrado, {quoted(obs)} AS tipo_observado, "
        f"count(*) FILTER (WHERE {cond}) AS documentos, {quoted(change)} AS cambio FROM d"
        for f, reg, obs, cond, change in rows
    ]
    elements = f"{quoted('location.coordinates[]')} AS campo, 'NUMBER' AS tipo_registrado"
    parts += [
        f"SELECT {elements}, 'NUMBER' AS tipo_observado, 2 * count(*) FILTER (WHERE {whole} AND defect NOT IN (7, 8)) "
        "+ count(*) FILTER (WHERE defect = 8) AS documentos, 'igual' AS cambio FROM d",
        f"SELECT {elements}, 'NULL' AS tipo_observado, 2 * count(*) FILTER (WHERE defect = 7) AS documentos, 'igual' AS cambio FROM d",
    ]
    return "WITH d AS (SELECT event_id % 20 AS defect FROM events) " + " UNION ALL ".join(parts)


def _versions() -> str:
    """Fields by version and changes by extract; the first extract holds the defects below 14."""
    strings = ("bus_id", "ruta", "timestamp", "estado", "escenario", "direccion", "location.type", "tramo.inicio", "tramo.fin")
    numbers = (
        "location.coordinates[]", "lat", "lon", "velocidad_kmh", "tramo.fraccion", "metrics_runtime.steps_per_segment",
        "metrics_runtime.current_step", "metrics_runtime.steps_remaining",
    )
    listed = [(f, "STRING", 1) for f in strings] + [(f, "NUMBER", 1) for f in numbers]
    listed += [("location", "OBJECT", 1), ("location.coordinates", "ARRAY", 1), ("tramo", "OBJECT", 1), ("metrics_runtime", "OBJECT", 1)]
    listed += [("firmware", "STRING", 2), ("tramo.meta", "OBJECT", 3), ("tramo.meta.zona", "OBJECT", 3), ("tramo.meta.zona.x", "NUMBER", 3)]
    changes = [
        (1, "firmware", None, "STRING", "defect = 12", "agregado", "aplicado"),
        (1, "velocidad_kmh", "NUMBER", "STRING", "defect = 3", "tipo", "rechazado"),
        (1, "$", None, "INVALID", "defect IN (4, 13)", "ilegible", "anotado"),
        (2, "$", None, "INVALID", "defect = 14", "ilegible", "anotado"),
        *[(2, f, kind, None, "false", "eliminado", "anotado") for f, kind in (("firmware", "STRING"), ("lat", "NUMBER"), ("lon", "NUMBER"))],
        (2, "tramo.meta", None, "OBJECT", "defect = 16", "agregado", "aplicado"),
        (2, "tramo.meta.zona", None, "OBJECT", "defect = 16", "agregado", "aplicado"),
        (2, "tramo.meta.zona.x", None, "NUMBER", "defect = 16", "agregado", "aplicado"),
    ]

    def quoted(text: str | None) -> str:
        return "cast(NULL AS varchar)" if text is None else f"'{text}'"

    parts = [
        f"SELECT 'cambio' AS fila, cast({e} AS integer) AS numero, {quoted(f)} AS campo, {quoted(reg)} AS tipo_registrado, "
        f"{quoted(obs)} AS tipo_observado, count(*) FILTER (WHERE {cond}) AS documentos, '{change}' AS cambio, '{action}' AS accion FROM d"
        for e, f, reg, obs, cond, change, action in changes
    ]
    parts += [
        f"SELECT 'campo', cast({v} AS integer), '{f}', '{kind}', cast(NULL AS varchar), cast(NULL AS bigint), "
        "cast(NULL AS varchar), cast(NULL AS varchar)"
        for f, kind, v in listed
    ]
    return "WITH d AS (SELECT event_id % 20 AS defect FROM events) " + " UNION ALL ".join(parts)


ALL: dict[str, str] = {
    "fact_bus_position": _FACT,
    "fact_preview": _FACT + ' ORDER BY "timestamp", arrival_seq LIMIT 20',
    "fact_from_documents": _FACT,
    "fact_roundtrip_by_date": _FACT,
    "fact_of_dates": f"SELECT * FROM ({_FACT}) WHERE fecha BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
    "fact_accumulated": _FACT,
    "fact_incremental": _FACT,
    "latest_arrival": f"WITH {_LATEST} SELECT {_FLAT} FROM latest",
    "latest_event": f"""WITH {_POS} SELECT {_FLAT} FROM hist
        QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY "timestamp" DESC, ingested_at DESC, arrival_seq DESC) = 1""",
    "latest_window": f"WITH {_LATEST} SELECT {_FLAT} FROM latest",
    "positions_all": f"""WITH {_LATEST}
        SELECT {_FLAT}, {_place('"timestamp" DESC, bus_id')} FROM latest""",
    "positions_by_route": _listing(f"ruta = '{q.ROUTE}'"),
    "positions_by_status": _listing(f"estado = '{q.STATUS}'"),
    "positions_by_scenario": _listing(f"escenario = '{q.SCENARIO}'"),
    "positions_by_filters": _listing(f"estado = '{q.STATUS}'"),
    "station_list": f"WITH {_STATIONS} SELECT * FROM estacion",
    "combined_latest_and_stations": f"""WITH {_LATEST}, {_STATIONS}
        SELECT 'bus' AS clase, {_FLAT}, cast(NULL AS int) AS estacion_id, cast(NULL AS varchar) AS nombre,
               cast(NULL AS varchar) AS tipo FROM latest
        UNION ALL
        SELECT 'estacion', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, longitud, latitud, NULL, id, nombre, tipo
        FROM estacion""",
    "bus_history": f"""WITH {_POS} SELECT {_FLAT} FROM hist WHERE bus_id = '{q.BUS}'
        ORDER BY "timestamp" DESC, arrival_seq DESC LIMIT 20""",
    "bus_history_unlimited": f"""WITH {_POS} SELECT {_FLAT} FROM hist WHERE bus_id = '{q.BUS}'
        ORDER BY "timestamp" DESC, arrival_seq DESC""",
    "last_n_per_bus": f"""WITH {_POS} SELECT {_FLAT} FROM hist
        QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY "timestamp" DESC, arrival_seq DESC) <= 20""",
    "near_point": f"WITH {_LATEST}, "
    + _near("latest l", f"{q.POINT[0]!r}e0", f"({q.POINT[1]!r}e0)", q.POINT_RADIUS_M),
    "near_station_eta": f"WITH {_LATEST}, {_STATIONS}, "
    + _near(f"latest l JOIN estacion s ON s.id = {q.STATION}", "s.latitud", "s.longitud", 20000.0),
    "near_join_grid": f"""WITH {_LATEST}, {_STATIONS},
        d AS (SELECT arrival_seq, bus_id, lat, lon, id AS estacion_id,
                     {_metres('lat', 'lon', 'latitud', 'longitud')} AS d FROM latest CROSS JOIN estacion)
        SELECT arrival_seq, bus_id, lat, lon, estacion_id, round(d, 3) AS distancia_m FROM d
        WHERE d <= {q.JOIN_RADIUS_M!r}""",
    "retention_24h": _ALIVE,
    "history_expired": _ALIVE,
    "accepted_positions": _ACCEPTED,
    "rejected_positions": _REJECTED,
    "stream_ingest_accepted": _ACCEPTED,
    "stream_ingest_rejected": _REJECTED,
    "stream_ingest_latest": _INGESTED_LATEST,
    "stream_latest": _INGESTED_LATEST,
    "stream_bodies": f"""WITH {_JUDGED}
        SELECT bus_id, ruta, escenario, estado, direccion, CASE WHEN defect <> 6 THEN "timestamp" END AS "timestamp", lon, lat,
               velocidad_kmh FROM good""",
    "stored_by_route": _listing(f"ruta = '{q.ROUTE}'", "newest", _STORED),
    "stored_near_station": f"WITH {_STORED}, {_STATIONS}, "
    + _near(f"newest l JOIN estacion s ON s.id = {q.STATION}", "s.latitud", "s.longitud", 20000.0),
    "stored_history": f"""WITH {_STORED} SELECT {_FLAT} FROM good WHERE bus_id = '{q.BUS}'
        ORDER BY "timestamp" DESC, arrival_seq DESC LIMIT 20""",
    "stored_unexpired": f"""WITH {_JUDGED} SELECT {_FLAT} FROM good
        WHERE "timestamp" > TIMESTAMP '{q.AS_OF}' - INTERVAL 24 HOUR""",
    "stream_ingest_distinct": f"""WITH {_JUDGED} SELECT {_ACCEPTED_COLUMNS} FROM good
        QUALIFY row_number() OVER (PARTITION BY bus_id, "timestamp", ingested_at ORDER BY arrival_seq) = 1""",
    "fact_from_store": f"""WITH {_JUDGED}
        SELECT {_FACT_COLUMNS} FROM (
            SELECT * FROM good
            UNION ALL SELECT * REPLACE (replace(bus_id, 'B', 'C') AS bus_id) FROM good)""",
    "fact_published": _FACT,
    "documents_additive": f"""WITH {_POS}
        SELECT bus_id, arrival_seq, CASE WHEN arrival_seq % 20 = 12 THEN 'v2' END AS firmware FROM hist""",
    "buses_by_route": _BUSES + " ORDER BY 1, 4",
    "buses_of_route": _BUSES + f" WHERE r.codigo = '{q.FLEET_ROUTE}' ORDER BY 4",
    "stations_by_route": f"""WITH {_BRIDGE}
        SELECT ruta_codigo, ruta_nombre, estacion_id, nombre AS estacion_nombre, tipo AS tipo_estacion,
               p_type AS estado_estacion, lat AS latitud, lon AS longitud, p_brand AS direccion, orden, parada,
               fecha_creacion FROM stops""",
    "official_stops": f"""WITH {_BRIDGE}
        SELECT ruta_codigo, ruta_nombre, estacion_id, nombre AS estacion_nombre, orden, parada FROM stops WHERE parada""",
    "official_stops_of_route": f"""WITH {_BRIDGE}
        SELECT estacion_id AS id, nombre, lat AS latitud, lon AS longitud, tipo, p_type AS estado, p_brand AS direccion
        FROM stops WHERE parada AND ruta_codigo = '{q.BRIDGE_ROUTE}'""",
    "route_origin_destination": f"""WITH {_FLEET}
        SELECT r.codigo AS ruta_codigo, r.nombre AS ruta_nombre, o.nombre AS origen, d.nombre AS destino, r.estado,
               r.fecha_creacion
        FROM ruta r LEFT JOIN estacion o ON o.id = r.estacion_origen_id LEFT JOIN estacion d ON d.id = r.estacion_destino_id""",
    "bus_count_per_route": f"""WITH {_FLEET}
        SELECT r.codigo AS ruta_codigo, r.nombre AS ruta_nombre, count(b.id) AS cantidad_buses
        FROM ruta r LEFT JOIN bus b ON b.ruta_id = r.id GROUP BY ALL""",
    "user_total": "SELECT count(*) AS total_usuarios FROM customer",
    "users_by_status": f"WITH {_FLEET} SELECT estado, count(*) AS cantidad FROM persona GROUP BY ALL",
    "users_by_person_type": f"""WITH {_FLEET}
        SELECT t.nombre AS tipo_persona, count(p.id) AS cantidad_usuarios
        FROM tipo_persona t LEFT JOIN persona p ON p.tipo_persona_id = t.id GROUP BY ALL""",
    "users_by_document_type": f"""WITH {_FLEET}
        SELECT t.nombre AS tipo_documento, count(p.id) AS cantidad_usuarios
        FROM tipo_documento t LEFT JOIN persona p ON p.tipo_documento_id = t.id GROUP BY ALL""",
    "user_listing": f"""WITH {_FLEET}
        SELECT p.id, p.nombres, p.apellidos, d.nombre AS tipo_documento, p.documento, t.nombre AS tipo_persona, p.estado,
               p.fecha_creacion
        FROM persona p JOIN tipo_documento d ON d.id = p.tipo_documento_id JOIN tipo_persona t ON t.id = p.tipo_persona_id""",
    "route_segments": f"""WITH {_SEGMENTS}
        SELECT ruta_id, orden, variante, inicio_id, fin_id, concat(inicio, ' → ', fin) AS tramo, lat_a, lon_a, lat_b, lon_b
        FROM seg WHERE fin_id IS NOT NULL""",
    "interpolated_positions": f"""WITH {_SEGMENTS}
        SELECT ruta_id, orden, variante, inicio_id, fin_id, round(cantidad / 50, 4) AS fraccion,
               round(cantidad / 50, 2) AS posicion_relativa,
               lat_a + (lat_b - lat_a) * (cantidad / 50) AS lat, lon_a + (lon_b - lon_a) * (cantidad / 50) AS lon
        FROM seg WHERE fin_id IS NOT NULL""",
    "usable_routes": """SELECT cast(l_orderkey AS int) AS ruta_id, count(*) AS paradas, count(*) - 1 AS tramos
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) >= 2""",
    "route_line": f"""WITH {_LINE},
        n AS (SELECT *, row_number() OVER w - 1 AS p, lead(lat) OVER w AS lat_b, lead(lon) OVER w AS lon_b
              FROM stops WINDOW w AS (PARTITION BY ruta_id ORDER BY orden, estacion_id, variante))
        SELECT ruta_id, cast(p // 4 AS int) AS pieza, cast(p % 4 AS int) AS n, lat AS lat_a, lon AS lon_a, lat_b, lon_b
        FROM n WHERE lat_b IS NOT NULL""",
    "status_rules": f"""WITH {_RULES}
        SELECT arrival_seq, escenario, steps_per_segment, current_step,
               cast(greatest(steps_per_segment - current_step, 0) AS int) AS steps_remaining,
               round(f, 4) AS fraccion, f BETWEEN 0 AND 1 AS fraccion_valida,
               CASE WHEN escenario = 'BUS_VARADO' THEN 'DETENIDO' WHEN f <= 0.05e0 OR f >= 0.95e0 THEN 'EN_PARADA'
                    ELSE 'EN_RUTA' END AS estado_regla
        FROM r""",
    "invalid_progress": f"""WITH {_RULES}
        SELECT arrival_seq, bus_id, round(f, 4) AS fraccion FROM r WHERE NOT (f BETWEEN 0 AND 1)""",
    "speed_conformance": f"""WITH {_POS},
        b AS (SELECT *, CASE WHEN estado = 'DETENIDO' THEN 0e0 WHEN estado = 'EN_PARADA' THEN 0e0
                             WHEN escenario = 'HORA_PICO' THEN 5e0 ELSE 25e0 END AS vel_min,
                        CASE WHEN estado = 'DETENIDO' THEN 0e0 WHEN estado = 'EN_PARADA' THEN 5e0
                             WHEN escenario = 'HORA_PICO' THEN 25e0 ELSE 50e0 END AS vel_max FROM pos)
        SELECT arrival_seq, estado, escenario, velocidad_kmh, vel_min, vel_max,
               velocidad_kmh BETWEEN vel_min AND vel_max AS vel_conforme FROM b""",
    "speed_class": """SELECT event_id AS arrival_seq, value AS velocidad_kmh,
        cast(CASE WHEN value > 25 THEN 3 WHEN value > 10 THEN 2 ELSE 1 END AS int) AS clase_velocidad,
        cast(round(cast(value AS decimal(18, 2)), 1) AS double) AS velocidad_1d FROM events""",
    "station_labels": f"""WITH {_STATIONS}
        SELECT id, nombre, tipo, CASE WHEN tipo = 'P' THEN 'Portal' ELSE 'Estación' END AS etiqueta FROM estacion""",
    "trajectory_points": f'WITH {_POS} SELECT bus_id, "timestamp", arrival_seq, lat, lon FROM hist',
    "trajectory_lines": f"""WITH {_POS},
        l AS (SELECT * FROM hist
              QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY "timestamp" DESC, arrival_seq DESC) <= 30)
        SELECT bus_id, cast(count(*) OVER (PARTITION BY bus_id) AS int) AS puntos,
               cast(row_number() OVER (PARTITION BY bus_id ORDER BY "timestamp", arrival_seq) - 1 AS int) AS n, lat, lon
        FROM l""",
    "geojson_points": f"""WITH {_POS}
        SELECT arrival_seq, 'Point' AS tipo, lon, lat, lat AS primero, lon AS segundo FROM hist""",
    "legacy_event_union": f"""WITH {_LATEST}
        SELECT bus_id, lon, lat, estado, velocidad_kmh, ruta FROM latest
        UNION ALL
        SELECT concat('T', cast(c_custkey AS varchar)),
               -74.3e0 + cast((c_custkey * 6151) % 40001 AS double) / 1e5,
               4.45e0 + cast((c_custkey * 3571) % 40001 AS double) / 1e5,
               CASE WHEN c_nationkey % 4 <> 0 THEN 'EN_RUTA' ELSE 'DESCONOCIDO' END,
               CASE WHEN c_acctbal >= 0 THEN cast(c_nationkey AS double) + 0.5e0 ELSE 0e0 END, NULL
        FROM customer""",
    "positions_json": f"""WITH {_LATEST}
        SELECT bus_id, concat('{{"bus_id":"', bus_id, '","ruta":"', ruta, '","estado":"', estado,
               '","timestamp":"', strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f'),
               '","lat":', cast(lat AS varchar), ',"lon":', cast(lon AS varchar),
               ',"velocidad_kmh":', cast(velocidad_kmh AS varchar), '}}') AS json FROM latest""",
    "stations_as_text": f"""WITH {_STATIONS}
        SELECT id, nombre, cast(cast(latitud AS decimal(9, 6)) AS varchar) AS latitud,
               cast(cast(longitud AS decimal(9, 6)) AS varchar) AS longitud, tipo FROM estacion""",
    "profile": _profile(),
    "schema_drift": _drift(),
    "schema_versions": _versions(),
}
