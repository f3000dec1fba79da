"""Position lookups: eight modes over the latest positions, the history and the stations."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.functions import motion
from pingloom.operators import near

# Defaults of the lookups.
NEAR_POINT_M = 200.0
NEAR_STATION_M = 20000.0
HISTORY_ROWS = 20


class StationNotFound(LookupError):
    """No station with the requested id."""


class Positions:
    """What lookups read: ``latest`` (one row per vehicle), ``history`` and ``stations``.

    ``stations`` has ``id, nombre, latitud, longitud, tipo``. The latest positions may be given as a function, which is
    called for the first lookup that needs them.
    """

    def __init__(self, latest: DataFrame | Callable[[], DataFrame], history: DataFrame, stations: DataFrame):
        self._latest = latest
        self.history = history
        self.stations = stations

    @cached_property
    def latest(self) -> DataFrame:
        return self._latest if isinstance(self._latest, DataFrame) else self._latest()

    def lookup(self, mode: str, **params) -> DataFrame:
        """Run one mode by name; parameters may be given as text."""
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}; one of {sorted(MODES)}")
        return MODES[mode](self, **params)

    # -- listings, newest first ------------------------------------------------

    def _newest_first(self, rows: DataFrame) -> DataFrame:
        return rows.orderBy(F.desc_nulls_last("timestamp"), "bus_id")

    def every(self) -> DataFrame:
        return self._newest_first(self.latest)

    def by_route(self, ruta: str) -> DataFrame:
        return self._newest_first(self.latest.filter(F.col("ruta") == ruta))

    def by_status(self, estado: str) -> DataFrame:
        return self._newest_first(self.latest.filter(F.col("estado") == estado))

    def by_scenario(self, escenario: str) -> DataFrame:
        return self._newest_first(self.latest.filter(F.col("escenario") == escenario))

    def by_filters(self, ruta: str | None = None, estado: str | None = None, escenario: str | None = None) -> DataFrame:
        """One filter at most takes effect: scenario before status before route."""
        if escenario:
            return self.by_scenario(escenario)
        if estado:
            return self.by_status(estado)
        if ruta:
            return self.by_route(ruta)
        return self.every()

    def with_stations(self) -> DataFrame:
        """All latest positions, newest first, then all stations, told apart by ``clase``."""
        buses = self.latest.select(F.lit("bus").alias("clase"), "*")
        places = self.stations.select(
            F.lit("estacion").alias("clase"),
            F.col("id").alias("estacion_id"),
            "nombre",
            "tipo",
            F.col("latitud").cast("double").alias("lat"),
            F.col("longitud").cast("double").alias("lon"),
        )
        both = buses.unionByName(places, allowMissingColumns=True)
        return both.orderBy("clase", F.desc_nulls_last("timestamp"), "bus_id", "estacion_id")

    # -- by distance -----------------------------------------------------------

    def near_point(self, lat: float | str, lon: float | str, max_m: float | str = NEAR_POINT_M) -> DataFrame:
        return near.near_point(self.latest, float(lat), float(lon), float(max_m))

    def near_station(self, id: int | str, max_m: float = NEAR_STATION_M) -> DataFrame:
        """Around one station. The station is fetched first, as one row, so that its coordinates
        become constants of the scan."""
        found = (
            self.stations.filter(F.col("id") == int(id))
            .select(F.col("latitud").cast("double"), F.col("longitud").cast("double"))
            .take(1)
        )
        if not found:
            raise StationNotFound(f"no station with id {id}")
        lat, lon = found[0]
        return near.near_point(self.latest, lat, lon, max_m)

    # -- history ---------------------------------------------------------------

    def bus_history(self, bus_id: str, limit: int | str = HISTORY_ROWS) -> DataFrame:
        """Newest pings of one vehicle; a limit of 0 means all of them."""
        rows = self.history.filter(F.col("bus_id") == bus_id).orderBy(
            F.desc_nulls_last("timestamp"), F.desc("arrival_seq")
        )
        count = int(limit)
        if count < 0:
            raise ValueError("limit must not be negative")
        return rows if count == 0 else rows.limit(count)

    def station_list(self) -> DataFrame:
        return self.stations


MODES: dict[str, Callable[..., DataFrame]] = {
    "estaciones": Positions.station_list,
    "all": Positions.with_stations,
    "route": Positions.by_route,
    "status": Positions.by_status,
    "escenario": Positions.by_scenario,
    "near_buses": Positions.near_point,
    "near_station": Positions.near_station,
    "history": Positions.bus_history,
}


def with_eta(near_rows: DataFrame) -> DataFrame:
    """Arrival estimate for rows that carry ``distancia_m``."""
    eta = motion.eta_min(F.col("distancia_m"), F.col("velocidad_kmh"))
    return near_rows.select("*", eta.alias("eta_min"), motion.eta_text(eta).alias("eta"))
