"""Rules about movement along a segment: progress, status, speed, arrival time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Enumerations and thresholds of the operating rules.
PEAK, OFF_PEAK, STRANDED = "HORA_PICO", "HORA_VALLE", "BUS_VARADO"
ON_ROUTE, AT_STOP, HALTED = "EN_RUTA", "EN_PARADA", "DETENIDO"
RETURN_TRIP = "VUELTA"
STOP_ZONE = (0.05, 0.95)
STEPS = {OFF_PEAK: 10, PEAK: 20}
STEPS_OTHERWISE = 1
BAND_AT_STOP = (0.0, 5.0)
BAND_PEAK = (5.0, 25.0)
BAND_OFF_PEAK = (25.0, 50.0)
SPEED_CLASSES = (25, 10)


def scenario(text: Column) -> Column:
    return F.upper(text)


def steps_per_segment(escenario: Column) -> Column:
    steps = F.lit(STEPS_OTHERWISE)
    for name, count in STEPS.items():
        steps = F.when(escenario == name, F.lit(count)).otherwise(steps)
    return steps


def steps_remaining(total: Column, done: Column) -> Column:
    """Never negative; null when either side is unknown (``greatest`` alone would skip the null)."""
    left = total - done
    return F.when(left.isNotNull(), F.greatest(left, F.lit(0)))


def progress(step: Column, steps: Column, direccion: Column) -> Column:
    """Share of the segment covered, counted from its far end on the return trip."""
    forward = F.try_divide(step.cast("double"), steps.cast("double"))
    return F.when(direccion == RETURN_TRIP, 1 - forward).otherwise(forward)


def progress_valid(fraction: Column) -> Column:
    return fraction.between(0.0, 1.0)


def status(escenario: Column, fraction: Column) -> Column:
    near_stop = (fraction <= STOP_ZONE[0]) | (fraction >= STOP_ZONE[1])
    return F.when(escenario == STRANDED, HALTED).when(near_stop, AT_STOP).otherwise(ON_ROUTE)


def speed_band(estado: Column, escenario: Column) -> Column:
    """Expected speed range ``{lo, hi}`` in km/h for a status and scenario."""

    def band(low: float, high: float) -> Column:
        return F.struct(F.lit(low).alias("lo"), F.lit(high).alias("hi"))

    return (
        F.when(estado == HALTED, band(0.0, 0.0))
        .when(estado == AT_STOP, band(*BAND_AT_STOP))
        .when(escenario == PEAK, band(*BAND_PEAK))
        .otherwise(band(*BAND_OFF_PEAK))
    )


def speed_conforms(speed: Column, band: Column) -> Column:
    return speed.between(band["lo"], band["hi"])


def speed_class(speed: Column) -> Column:
    """3 above the upper threshold, 2 above the lower one, else 1."""
    upper, lower = SPEED_CLASSES
    return F.when(speed > upper, 3).when(speed > lower, 2).otherwise(1)


def eta_min(distance_m: Column, speed_kmh: Column) -> Column:
    """Minutes to cover the displayed (one-decimal) distance; null without a positive speed."""
    metres_per_minute = speed_kmh * 1000 / 60
    return F.when(speed_kmh > 0, F.round(F.try_divide(F.round(distance_m, 1), metres_per_minute), 1))


def eta_text(eta: Column) -> Column:
    return F.when(eta.isNull(), "N/A").otherwise(F.format_string("%.1f min", eta))
