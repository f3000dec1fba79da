"""Every operator of the library as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingloom import schemas
from pingloom.functions import geo, labels, motion
from pingloom.operators import ingest, legacy, near, quality, retention, serialize, trajectory
from pingloom.operators.latest import last_n, latest, latest_by_rank
from pingloom.plans import fact, network, routes
from pingloom.plans.lookup import Positions, with_eta
from pingloom.session import scratch_path, spool
from pingloom.sources import fact_table, pings, schema_registry
from pingloom.streaming import incremental, keyed, landing
from testbed import tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the sample lookups.
ROUTE, STATUS, SCENARIO, BUS = "R3", "EN_PARADA", "HORA_PICO", "B7"
POINT = (4.65, -74.1)
POINT_RADIUS_M = 5000.0
STATION = 7
JOIN_RADIUS_M = 2000.0
AS_OF = "2024-01-29 12:00:00"
FLEET_ROUTE, BRIDGE_ROUTE = "R3", "R7"

FLAT = [
    "bus_id", "ruta", "escenario", "estado", "direccion", "timestamp", "ingested_at", "arrival_seq",
    "lon", "lat", "velocidad_kmh",
]


def shown(df: DataFrame) -> DataFrame:
    """UTC times without a zone, so that no client shifts them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema
        ]
    )


def _flat(df: DataFrame) -> DataFrame:
    return shown(df.select(*FLAT))


def ranked(rows: DataFrame) -> DataFrame:
    """Rows numbered in the order in which they come, so that a comparison sees their order."""
    spark = rows.sparkSession
    # written out, so that the borders of the sorted partitions are the same for both uses
    placed = spool(rows.withColumn("_at", F.monotonically_increasing_id()), "listing").withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    # one number per partition of the listing
    before, offsets = 0, []
    for part, n in sorted(sizes.collect()):
        offsets.append((part, before))
        before += n
    first = spark.createDataFrame(offsets, "_part bigint, _before bigint")
    at = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(first), "_part").withColumn("puesto", at.cast("int")).drop("_at", "_part", "_before")


def _positions(spark: SparkSession, sf: str) -> Positions:
    history = tables.history(spark, sf)
    return Positions(latest=lambda: latest(history), history=history, stations=tables.stations(spark, sf))


# -- fact ----------------------------------------------------------------------


def fact_bus_position(spark, sf):
    return shown(fact.build_fact(tables.documents(spark, sf)))


def fact_preview(spark, sf):
    return shown(fact.preview(tables.history(spark, sf)))


def _stored_fact(spark, sf):
    path = scratch_path(spark, "fact")
    fact_table.write_fact(fact.build_fact(tables.documents(spark, sf)), path)
    return fact_table.read_fact(spark, path)


def fact_roundtrip_by_date(spark, sf):
    return shown(_stored_fact(spark, sf))


def fact_from_documents(spark, sf):
    """The fact from a collection of JSON documents, scanned with a given schema."""
    path = scratch_path(spark, "documents")
    rows = tables.documents(spark, sf)
    whole = rows.withColumn("timestamp", F.date_format("timestamp", serialize.ISO)).withColumn(
        "ingested_at", F.date_format("ingested_at", serialize.ISO)
    )
    whole.write.json(path)
    return shown(fact.build_fact(pings.read_documents(spark, path, "json", schemas.DOCUMENT)))


def fact_of_dates(spark, sf):
    """A read of three dates, which opens only their folders."""
    return shown(_stored_fact(spark, sf).filter("fecha BETWEEN date'2024-01-10' AND date'2024-01-12'"))


def fact_accumulated(spark, sf):
    """Two overlapping extracts merged into one table: every event once, the shared day whole."""
    path = scratch_path(spark, "fact-merge")
    rows = fact.build_fact(tables.documents(spark, sf))
    fact_table.write_fact(rows.filter("ts_evento < timestamp'2024-01-16 12:00:00'"), path, "accumulate")
    fact_table.write_fact(rows.filter("ts_evento >= timestamp'2024-01-15 18:00:00'"), path, "accumulate")
    return shown(fact_table.read_fact(spark, path))


def fact_incremental(spark, sf):
    """History files loaded into the fact by a stream, in two runs."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("history", "fact-stream", "checkpoint"))
    history = tables.history(spark, sf).select(*schemas.columns(schemas.POSITION))
    for part in ("ingested_at < timestamp'2024-01-16'", "ingested_at >= timestamp'2024-01-16'"):
        history.filter(part).write.mode("append").parquet(source)
        incremental.start_fact_load(incremental.history_stream(spark, source), target, checkpoint).awaitTermination()
    return shown(fact_table.read_fact(spark, target))


# -- latest and lookups --------------------------------------------------------


def latest_arrival(spark, sf):
    return _flat(latest(tables.history(spark, sf), order="arrival"))


def latest_event(spark, sf):
    return _flat(latest(tables.history(spark, sf), order="event"))


def latest_window(spark, sf):
    return _flat(latest_by_rank(tables.history(spark, sf)))


def positions_all(spark, sf):
    return shown(ranked(_positions(spark, sf).every()).select(*FLAT, "puesto"))


def positions_by_route(spark, sf):
    return _flat(_positions(spark, sf).lookup("route", ruta=ROUTE))


def positions_by_status(spark, sf):
    return _flat(_positions(spark, sf).lookup("status", estado=STATUS))


def positions_by_scenario(spark, sf):
    return _flat(_positions(spark, sf).lookup("escenario", escenario=SCENARIO))


def positions_by_filters(spark, sf):
    return _flat(_positions(spark, sf).by_filters(ruta=ROUTE, estado=STATUS))


def station_list(spark, sf):
    return _positions(spark, sf).lookup("estaciones")


def combined_latest_and_stations(spark, sf):
    both = _positions(spark, sf).lookup("all")
    return shown(both.select("clase", *FLAT, "estacion_id", "nombre", "tipo"))


def bus_history(spark, sf):
    return _flat(_positions(spark, sf).lookup("history", bus_id=BUS))


def bus_history_unlimited(spark, sf):
    return _flat(_positions(spark, sf).lookup("history", bus_id=BUS, limit="0"))


def last_n_per_bus(spark, sf):
    return _flat(last_n(tables.history(spark, sf), 20))


def _near_columns(rows: DataFrame) -> DataFrame:
    return shown(
        ranked(rows).select(
            "puesto", "bus_id", "ruta", "estado", "timestamp", "lat", "lon", "velocidad_kmh",
            F.round("distancia_m", 3).alias("distancia_m"),
            labels.one_decimal(F.col("distancia_m")).alias("distancia"),
            "eta_min", "eta",
        )
    )


def near_point(spark, sf):
    lat, lon = POINT
    found = _positions(spark, sf).lookup("near_buses", lat=str(lat), lon=str(lon), max_m=POINT_RADIUS_M)
    return _near_columns(with_eta(found))


def near_station_eta(spark, sf):
    return _near_columns(with_eta(_positions(spark, sf).lookup("near_station", id=str(STATION))))


def near_join_grid(spark, sf):
    stations = tables.stations(spark, sf).selectExpr("id", "latitud AS lat", "longitud AS lon")
    vehicles = latest(tables.history(spark, sf)).select("arrival_seq", "bus_id", "lat", "lon")
    pairs = near.near_join(vehicles, stations, JOIN_RADIUS_M)
    return pairs.withColumn("distancia_m", F.round("distancia_m", 3))


def retention_24h(spark, sf):
    return _flat(retention.unexpired(tables.history(spark, sf), AS_OF))


# -- ingest --------------------------------------------------------------------


def history_expired(spark, sf):
    """History rewritten without what has expired, then read from its date folders."""
    path = scratch_path(spark, "alive")
    retention.rewrite(tables.history(spark, sf), path, AS_OF)
    return _flat(spark.read.parquet(path))


def _accepted_columns(rows: DataFrame) -> DataFrame:
    return shown(
        rows.select(
            *FLAT, "ts_imputed",
            F.col("tramo.inicio").alias("tramo_inicio"),
            F.col("tramo.fin").alias("tramo_fin"),
            F.col("tramo.fraccion").alias("fraccion"),
            F.col("metrics_runtime.steps_per_segment").alias("steps_per_segment"),
            F.col("metrics_runtime.current_step").alias("current_step"),
            F.col("metrics_runtime.steps_remaining").alias("steps_remaining"),
            F.when(F.col("extra").isNotNull(), F.array_join(F.sort_array(F.map_keys("extra")), ",")).alias("extra_keys"),
        )
    )


def _decoded(spark, sf):
    return ingest.decode(tables.raw_pings(spark, sf), seq="seq")


def accepted_positions(spark, sf):
    return _accepted_columns(ingest.accepted(_decoded(spark, sf)))


def rejected_positions(spark, sf):
    return shown(ingest.rejected(_decoded(spark, sf)).drop("raw"))


def _landed(spark, sf) -> tuple[str, int]:
    """Raw pings as JSON files of an earlier and a later part, and how many files make half of them."""
    folder, raw = scratch_path(spark, "landing"), tables.raw_pings(spark, sf)
    for part in ("arrived_at < timestamp'2024-01-17'", "arrived_at >= timestamp'2024-01-17'"):
        writer = raw.filter(part).write.mode("append")
        writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(folder)
    files = len(spark.read.text(folder).inputFiles())
    return folder, (files + 1) // 2


def _streamed(spark, sf) -> tuple[landing.Store, int]:
    folder, half = _landed(spark, sf)
    store = landing.Store(scratch_path(spark, "store"))
    query = landing.start_ingest(landing.raw_stream(spark, folder, half), store)
    query.awaitTermination()
    return store, landing.last_batch(query)


def stream_ingest_accepted(spark, sf):
    store, _ = _streamed(spark, sf)
    return _accepted_columns(store.history(spark))


def stream_ingest_rejected(spark, sf):
    store, _ = _streamed(spark, sf)
    return shown(store.rejects(spark).drop("raw"))


def stream_ingest_latest(spark, sf):
    store, batch = _streamed(spark, sf)
    return _flat(store.latest(spark, batch))


def stream_latest(spark, sf):
    """Latest positions kept as streaming state."""
    folder, half = _landed(spark, sf)
    target, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "checkpoint")
    raw = landing.raw_stream(spark, folder, half)
    positions = ingest.accepted(ingest.decode(raw, seq="seq"))
    query = keyed.start_latest(positions, target, checkpoint)
    query.awaitTermination()
    return _flat(spark.read.parquet(f"{target}/batch_id={landing.last_batch(query)}"))


def stream_bodies(spark, sf):
    """Bare bodies, one per line, streamed without an envelope; they arrive when their file lands."""
    folder, store = scratch_path(spark, "bodies"), landing.Store(scratch_path(spark, "store"))
    tables.raw_pings(spark, sf).select("value").write.text(folder)
    landing.start_ingest(landing.body_stream(spark, folder), store).awaitTermination()
    rows = store.history(spark).withColumn("timestamp", F.when(~F.col("ts_imputed"), F.col("timestamp")))
    return shown(rows.select("bus_id", "ruta", "escenario", "estado", "direccion", "timestamp", "lon", "lat", "velocidad_kmh"))


def _served(spark, sf) -> Positions:
    """Lookups from a store after an ingest, a stop and a run that found nothing new."""
    folder, half = _landed(spark, sf)
    store = landing.Store(scratch_path(spark, "store"))
    for _ in range(2):
        landing.start_ingest(landing.raw_stream(spark, folder, half), store).awaitTermination()
    return landing.Store(store.root).positions(spark, tables.stations(spark, sf))


def stored_by_route(spark, sf):
    return _flat(_served(spark, sf).lookup("route", ruta=ROUTE))


def stored_near_station(spark, sf):
    return _near_columns(with_eta(_served(spark, sf).lookup("near_station", id=str(STATION))))


def stored_history(spark, sf):
    return _flat(_served(spark, sf).lookup("history", bus_id=BUS))


def stored_unexpired(spark, sf):
    """What the store keeps after it was compacted, with all that had expired dropped."""
    store, _ = _streamed(spark, sf)
    store.compact(spark, AS_OF)
    return _flat(store.history(spark))


def stream_ingest_distinct(spark, sf):
    """Every file is delivered twice, the second time under another name; a repeat is not stored again."""
    folder, _ = _landed(spark, sf)
    store, again = landing.Store(scratch_path(spark, "store")), scratch_path(spark, "again")
    spark.read.text(folder).write.text(again)
    for landed in (folder, again):
        found = landing.raw_stream(spark, landed)
        store.checkpoint = scratch_path(spark, "checkpoint")
        if landed == again:
            # a new reader starts to count at 0; the store goes on
            decoded = ingest.decode(spark.read.schema(found.schema).json(landed), "value", "arrived_at", "seq")
            store.write_batch(decoded, store.last_batch(spark) + 1, repeats=timedelta(days=365))
        else:
            landing.start_ingest(found, store, repeats=timedelta(days=365)).awaitTermination()
    return _accepted_columns(store.history(spark))


def fact_from_store(spark, sf):
    """Facts loaded batch by batch from the store, which is compacted between two loads."""
    folder, half = _landed(spark, sf)
    store, facts = landing.Store(scratch_path(spark, "store")), scratch_path(spark, "facts")
    landing.start_ingest(landing.raw_stream(spark, folder, half), store).awaitTermination()
    incremental.load_store(spark, store, facts)
    store.compact(spark, "2000-01-01 00:00:00")
    # the same pings of other vehicles; in a wrapped body the quotes are escaped
    later = tables.raw_pings(spark, sf).withColumn("value", F.regexp_replace("value", r'(bus_id\\*":\\*")B', "$1C"))
    store.write_batch(ingest.decode(later.selectExpr("value", "arrived_at", "seq"), seq="seq"), store.last_batch(spark) + 1)
    for _ in range(2):
        incremental.load_store(spark, store, facts)
    return shown(incremental.read_loaded(spark, facts))


def fact_published(spark, sf):
    """The fact as a version beside an older one that readers had before the switch."""
    root, rows = scratch_path(spark, "versions"), fact.build_fact(tables.documents(spark, sf))
    fact_table.publish_fact(rows.filter("ts_evento < timestamp'2024-01-10'"), root)
    fact_table.publish_fact(rows, root)
    return shown(fact_table.read_published(spark, root))


def documents_additive(spark, sf):
    """A collection whose documents have gained fields, read with the registered schema and what was added."""
    path = scratch_path(spark, "documents")
    rows = tables.documents(spark, sf).withColumn("firmware", F.when(F.col("arrival_seq") % 20 == 12, "v2"))
    rows.drop("extra").write.json(path)
    return pings.read_documents(spark, path, "json", schemas.DOCUMENT, additive=True).select("bus_id", "arrival_seq", "firmware")


# -- relational reports ----------------------------------------------------------


def buses_by_route(spark, sf):
    return ranked(network.buses_by_route(tables.fleet_network(spark, sf)))


def buses_of_route(spark, sf):
    return ranked(network.buses_of_route(tables.fleet_network(spark, sf), FLEET_ROUTE))


def stations_by_route(spark, sf):
    return shown(network.stations_by_route(tables.bridge_network(spark, sf)))


def official_stops(spark, sf):
    return network.official_stops(tables.bridge_network(spark, sf))


def official_stops_of_route(spark, sf):
    return network.official_stops_of_route(tables.bridge_network(spark, sf), BRIDGE_ROUTE)


def route_origin_destination(spark, sf):
    return shown(network.route_ends(tables.fleet_network(spark, sf)))


def bus_count_per_route(spark, sf):
    return network.bus_count_per_route(tables.fleet_network(spark, sf))


def user_total(spark, sf):
    return network.user_total(tables.fleet_network(spark, sf))


def users_by_status(spark, sf):
    return network.users_by_status(tables.fleet_network(spark, sf))


def users_by_person_type(spark, sf):
    return network.users_by_person_type(tables.fleet_network(spark, sf))


def users_by_document_type(spark, sf):
    return network.users_by_document_type(tables.fleet_network(spark, sf))


def user_listing(spark, sf):
    return shown(network.user_listing(tables.fleet_network(spark, sf)))


# -- route geometry --------------------------------------------------------------

STOP_ORDER = ("orden", "estacion_id", "variante")


def _segments(spark, sf):
    return routes.segments(tables.located_stops(spark, sf), order=STOP_ORDER)


def route_segments(spark, sf):
    return _segments(spark, sf).select(
        "ruta_id", "orden", "variante", "inicio_id", "fin_id", "tramo", "lat_a", "lon_a", "lat_b", "lon_b"
    )


def interpolated_positions(spark, sf):
    """A point on every segment, placed by the quantity column (0 to 1)."""
    fraction = F.col("cantidad") / 50
    placed = routes.along(_segments(spark, sf), fraction)
    return placed.select(
        "ruta_id", "orden", "variante", "inicio_id", "fin_id",
        F.round(fraction, 4).alias("fraccion"),
        F.round(fraction, 2).alias("posicion_relativa"),
        "lat", "lon",
    )


def usable_routes(spark, sf):
    return routes.usable_routes(tables.bridge_stops(spark, sf).filter("parada"))


def route_line(spark, sf):
    """Route lines in pieces of four edges, listed edge by edge."""
    lines = routes.route_lines(tables.located_stops(spark, sf), order=STOP_ORDER, piece_edges=4)
    edges = F.arrays_zip(
        F.slice("linea", F.lit(1), F.size("linea") - 1).alias("a"), F.slice("linea", F.lit(2), F.size("linea") - 1).alias("b")
    )
    listed = lines.select("ruta_id", "pieza", F.posexplode(edges).alias("n", "e"))
    return listed.select(
        "ruta_id", "pieza", "n",
        *[F.col(f"e.{end}.{c}").alias(f"{c}_{end}") for end in ("a", "b") for c in ("lat", "lon")],
    )


# -- movement rules ----------------------------------------------------------------


def status_rules(spark, sf):
    rows = tables.positions(spark, sf)
    scenario = motion.scenario(F.lower("escenario"))
    steps = motion.steps_per_segment(scenario)
    step = F.col("metrics_runtime.current_step")
    share = motion.progress(step, steps, F.col("direccion"))
    return rows.select(
        "arrival_seq",
        scenario.alias("escenario"),
        steps.alias("steps_per_segment"),
        step.alias("current_step"),
        motion.steps_remaining(steps, step).alias("steps_remaining"),
        F.round(share, 4).alias("fraccion"),
        motion.progress_valid(share).alias("fraccion_valida"),
        motion.status(scenario, share).alias("estado_regla"),
    )


def invalid_progress(spark, sf):
    rows = tables.positions(spark, sf).select(
        "arrival_seq", "bus_id",
        motion.progress(
            F.col("metrics_runtime.current_step"), F.col("metrics_runtime.steps_per_segment"), F.col("direccion")
        ).alias("fraccion"),
    )
    return quality.invalid_progress(rows).withColumn("fraccion", F.round("fraccion", 4))


def speed_conformance(spark, sf):
    checked = quality.speed_check(tables.positions(spark, sf))
    return checked.select("arrival_seq", "estado", "escenario", "velocidad_kmh", "vel_min", "vel_max", "vel_conforme")


def speed_class(spark, sf):
    return tables.positions(spark, sf).select(
        "arrival_seq", "velocidad_kmh",
        motion.speed_class(F.col("velocidad_kmh")).alias("clase_velocidad"),
        F.round("velocidad_kmh", 1).alias("velocidad_1d"),
    )


def station_labels(spark, sf):
    return tables.stations(spark, sf).select("id", "nombre", "tipo", labels.station_kind(F.col("tipo")).alias("etiqueta"))


# -- paths, documents, data checks -----------------------------------------------------


def trajectory_points(spark, sf):
    return shown(trajectory.points(tables.history(spark, sf)))


def trajectory_lines(spark, sf):
    lines = trajectory.lines(tables.history(spark, sf), 30)
    listed = lines.select("bus_id", "puntos", F.posexplode("trayectoria").alias("n", "punto"))
    return listed.select("bus_id", "puntos", "n", "punto.lat", "punto.lon")


def geojson_points(spark, sf):
    """GeoJSON locations rebuilt, read element by element and turned into display order."""
    point = tables.documents(spark, sf).select("arrival_seq", "location")
    swapped = geo.lat_lon(F.col("location.coordinates"))
    return point.select(
        "arrival_seq",
        F.col("location.type").alias("tipo"),
        geo.coordinate(F.col("location.coordinates"), 0).alias("lon"),
        geo.coordinate(F.col("location.coordinates"), 1).alias("lat"),
        geo.coordinate(swapped, 0).alias("primero"),
        geo.coordinate(swapped, 1).alias("segundo"),
    )


def legacy_event_union(spark, sf):
    current = _positions(spark, sf).latest.select("bus_id", "lon", "lat", "estado", "velocidad_kmh", "ruta")
    return legacy.read_together(current, tables.old_pings(spark, sf))


def positions_json(spark, sf):
    rows = _positions(spark, sf).latest.select("bus_id", "ruta", "estado", "timestamp", "lat", "lon", "velocidad_kmh")
    return serialize.as_json(rows, keep=["bus_id"])


def stations_as_text(spark, sf):
    rows = tables.stations(spark, sf).select(
        "id", "nombre", F.col("latitud").cast("decimal(9,6)").alias("latitud"),
        F.col("longitud").cast("decimal(9,6)").alias("longitud"), "tipo",
    )
    return serialize.as_text(rows)


def profile(spark, sf):
    return quality.profile(_accepted_columns(ingest.accepted(_decoded(spark, sf))))


def schema_drift(spark, sf):
    return quality.schema_drift(tables.raw_pings(spark, sf, spread=True), schemas.struct(schemas.PING))


def schema_versions(spark, sf):
    """All pings as two extracts, one after the other: the fields by version, and what each extract changed."""
    raw = tables.raw_pings(spark, sf, spread=True)
    root = scratch_path(spark, "registry")
    schema_registry.register(spark, root, schemas.struct(schemas.PING))
    for part in ("seq % 20 < 14", "seq % 20 >= 14"):
        schema_registry.observe(raw.filter(part), root)
    log = schema_registry.change_log(spark, root).withColumnRenamed("extracto", "numero").withColumn("fila", F.lit("cambio"))
    listed = schema_registry.fields(spark, root).select(
        F.lit("campo").alias("fila"), F.col("version").alias("numero"), "campo", F.col("tipo").alias("tipo_registrado")
    )
    return log.unionByName(listed, allowMissingColumns=True)


ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        fact_bus_position, fact_from_documents, fact_preview, fact_roundtrip_by_date, fact_of_dates, fact_accumulated, fact_incremental,
        latest_arrival, latest_event, latest_window,
        positions_all, positions_by_route, positions_by_status, positions_by_scenario, positions_by_filters,
        station_list, combined_latest_and_stations, bus_history, bus_history_unlimited, last_n_per_bus,
        near_point, near_station_eta, near_join_grid, retention_24h, history_expired,
        accepted_positions, rejected_positions,
        stream_ingest_accepted, stream_ingest_rejected, stream_ingest_latest, stream_latest, stream_bodies,
        stored_by_route, stored_near_station, stored_history, stored_unexpired, documents_additive,
        stream_ingest_distinct, fact_from_store, fact_published,
        buses_by_route, buses_of_route, stations_by_route, official_stops, official_stops_of_route,
        route_origin_destination, bus_count_per_route,
        user_total, users_by_status, users_by_person_type, users_by_document_type, user_listing,
        route_segments, interpolated_positions, usable_routes, route_line,
        status_rules, invalid_progress, speed_conformance, speed_class, station_labels,
        trajectory_points, trajectory_lines, geojson_points, legacy_event_union,
        positions_json, stations_as_text, profile, schema_drift, schema_versions,
    )
}
