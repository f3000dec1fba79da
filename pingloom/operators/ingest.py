"""Decode raw pings, judge them, and shape the good ones into positions.

One pass over the data and no shuffle: every step is a projection, so a batch job and a streaming
micro-batch use the same functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingloom import schemas
from pingloom.functions import geo

MALFORMED = "malformed"
MISSING = "missing_required"
OUTSIDE = "out_of_bounds"

# First characters of text that may stand for a JSON zero, false or empty value: such a value counts
# as missing, and only its JSON type tells whether it is one.
_FALSY_STARTS = ("0", "-", "+", ".", "f", "[", "{")


# How numbers that JSON itself lacks come out when a bare token is read as text.
_BARE_TOKENS = ('"NaN"', '"Infinity"', '"-Infinity"')


def _number(text: Column) -> Column:
    bare = F.when(text.isin(*_BARE_TOKENS), F.btrim(text, F.lit('"')))
    return F.coalesce(text.try_cast("double"), bare.try_cast("double"))


def _json(column: Column, ddl: str) -> Column:
    return F.from_json(column, schemas.struct(ddl), {"columnNameOfCorruptRecord": "_broken"})


def once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Replace the columns by these, evaluated once per row.

    A filter on a plain projection is pushed below it, and every expression the filter names would be
    evaluated there a second time. It is not pushed below a generated row.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def is_whole(value: Column) -> Column:
    """True if the text is one JSON value and nothing else.

    The JSON reader stops at the end of the first value and ignores the rest. So the text is read as the first of two
    elements of an array: text behind it breaks the array, ends it early or adds to it, and the second element, which no
    text can foresee, is then not where it must be.
    """
    mark = F.xxhash64(value)
    listed = F.concat(F.lit("["), value, F.lit(',{"_end":'), mark.cast("string"), F.lit("}]"))
    parts = F.from_json(listed, schemas.END_OF_TEXT, {"allowSingleQuotes": "false"})
    found = _bound(parts, lambda p: (F.size(p) == 2) & (F.get(p, F.lit(1))["_end"] == mark))
    return F.coalesce(found, F.lit(False))


def document_text(value: Column) -> Column:
    """The ping document: the text under ``body`` if there is such a key, else the whole value."""

    def unwrapped(body: Column) -> Column:
        return F.when(body.isNull(), value).when(
            F.schema_of_variant(body) == "STRING", F.try_variant_get(body, "$", "string")
        )

    body = _json(value, "body variant")["body"]
    return F.when(value.contains('"body"'), _bound(body, unwrapped)).otherwise(value)


def _falsy(value: Column) -> Column:
    """True for a missing, null, zero, false or empty JSON value."""
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | F.is_variant_null(value), True)
        .when(kind == "STRING", F.try_variant_get(value, "$", "string") == "")
        .when(kind == "BOOLEAN", ~F.try_variant_get(value, "$", "boolean"))
        .when(kind.startswith("ARRAY"), kind == "ARRAY<VOID>")
        .when(kind.startswith("OBJECT"), kind == "OBJECT<>")
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False)))
    )


def _not_object(value: Column) -> Column:
    """Present, but null or of another type. A missing key is fine."""
    return value.isNotNull() & F.try_variant_get(value, "$", "map<string,variant>").isNull()


def _exact(x: Column) -> Column:
    """Verdict on a ping from its JSON types: shape, vehicle, and the text of its coordinates."""
    given = F.try_variant_get(x["location"], "$.coordinates", "variant")
    listed = F.try_variant_get(given, "$", "array<variant>")
    short_list = given.isNotNull() & F.coalesce(F.size(listed) < 2, F.lit(True))
    bad_shape = (
        x.isNull()
        | x["_broken"].isNotNull()
        | _not_object(x["location"])
        | _not_object(x["tramo"])
        | _not_object(x["metrics_runtime"])
        | short_list
    )

    def pick(index: int, fallback: str) -> Column:
        """The coordinate, or the flat field when the array holds nothing usable."""
        element = F.get(listed, F.lit(index))
        return F.when(~_falsy(element), F.try_variant_get(element, "$", "string")).when(
            ~_falsy(x[fallback]), F.try_variant_get(x[fallback], "$", "string")
        )

    return F.struct(
        F.coalesce(bad_shape, F.lit(True)).alias("bad_shape"),
        _falsy(x["bus_id"]).alias("no_bus"),
        pick(0, "lon").alias("lon"),
        pick(1, "lat").alias("lat"),
    )


def _extra(tramo: Column, metrics: Column) -> Column:
    """Keys of the nested documents that have no column of their own, kept as text under ``document.key``."""

    def others(name: str, document: Column, known: tuple[str, ...]) -> Column:
        left = F.filter(F.map_entries(document), lambda e: ~e["key"].isin(*known))
        return F.transform(left, lambda e: F.struct(F.concat(F.lit(f"{name}."), e["key"]).alias("key"), e["value"].alias("value")))

    none = F.array().cast("array<struct<key: string, value: string>>")
    found = F.concat(
        F.coalesce(others("tramo", tramo, schemas.TRAMO_FIELDS), none),
        F.coalesce(others("metrics_runtime", metrics, schemas.METRIC_FIELDS), none),
    )
    # a key that comes twice keeps its last value
    last = F.aggregate(
        found, none, lambda kept, e: F.concat(F.filter(kept, lambda k: k["key"] != e["key"]), F.array(e))
    )

    def has_others(document: Column, known: tuple[str, ...]) -> Column:
        return F.coalesce(F.size(F.array_except(F.map_keys(document), F.array(*map(F.lit, known)))) > 0, F.lit(False))

    # nearly all pings have none, which their keys tell without the entries being gone through
    return F.when(has_others(tramo, schemas.TRAMO_FIELDS) | has_others(metrics, schemas.METRIC_FIELDS), F.map_from_entries(last))


def decode(raw: DataFrame, value: str = "value", arrived_at: str = "arrived_at", seq: str | None = None) -> DataFrame:
    """Parse pings and name what is wrong with each: ``reject_reason`` is null for a good one.

    ``raw`` needs the document text, the arrival time, and ideally an arrival sequence number (such as
    an offset) to order pings that arrived in the same instant; without one a hash of the text is used.

    Well-formed pings, the vast majority, are parsed once into plain strings. Only where text cannot
    tell null from missing, or zero from "0", is the document parsed again with its JSON types.
    """
    base = raw.select(
        F.col(value).alias("raw"),
        F.col(arrived_at).cast("timestamp").alias("ingested_at"),
        (F.col(seq) if seq else F.xxhash64(value)).cast("bigint").alias("arrival_seq"),
        document_text(F.col(value)).alias("doc"),
    )
    whole = is_whole(F.col("raw")) & ((F.col("doc") == F.col("raw")) | is_whole(F.col("doc")))
    parsed = once(base, *base.columns, _json(F.col("doc"), schemas.PING_TEXT).alias("p"), whole.alias("whole"))

    p = F.col("p")
    lon_text, lat_text = (geo.coordinate(p["location"]["coordinates"], i) for i in (0, 1))

    def may_be_falsy(text: Column) -> Column:
        return text.isNull() | (text == "") | F.substring(text, 1, 1).isin(*_FALSY_STARTS)

    def may_be_zero(text: Column) -> Column:
        return text.isNull() | F.coalesce(text.try_cast("double") == 0, F.lit(True))

    doubtful = F.coalesce(
        p["_broken"].isNotNull()
        | p["tramo"].isNull()
        | p["metrics_runtime"].isNull()
        | may_be_falsy(p["bus_id"])
        | may_be_zero(lon_text)
        | may_be_zero(lat_text),
        F.lit(True),
    )
    # as a lambda, the verdict is worked out for doubtful pings only and stays out of generated code,
    # which it would make too large to be compiled
    verdict = _bound(_json(F.col("doc"), schemas.PING_VARIANT), _exact)
    judged = once(parsed, "raw", "ingested_at", "arrival_seq", "p", "whole", F.when(doubtful, verdict).alias("x"))

    x = F.col("x")
    known = x.isNull()
    located = judged.select(
        "*",
        F.when(known, lon_text).otherwise(x["lon"]).alias("lon_text"),
        F.when(known, lat_text).otherwise(x["lat"]).alias("lat_text"),
    )
    numbers = once(
        located,
        *located.columns,
        _number(F.col("lon_text")).alias("lon"),
        _number(F.col("lat_text")).alias("lat"),
        _number(p["velocidad_kmh"]).alias("velocidad_kmh"),
        p["timestamp"].try_cast("timestamp").alias("event_time"),
    )

    lat, lon = F.col("lat"), F.col("lon")
    # checks in the order in which they are made: the first failure names the reason
    reason = (
        F.when(~F.coalesce("whole", F.lit(False)) | x["bad_shape"], MALFORMED)
        .when(x["no_bus"] | F.col("lat_text").isNull() | F.col("lon_text").isNull(), MISSING)
        .when(lat.isNull() | lon.isNull(), MALFORMED)
        .when(~geo.in_box(lat, lon), OUTSIDE)
        .when(p["velocidad_kmh"].isNotNull() & F.col("velocidad_kmh").isNull(), MALFORMED)
    )
    tramo, metrics = p["tramo"], p["metrics_runtime"]
    return numbers.withColumn("reject_reason", reason).select(
        p["bus_id"].alias("bus_id"),
        p["ruta"].alias("ruta"),
        p["escenario"].alias("escenario"),
        p["estado"].alias("estado"),
        p["direccion"].alias("direccion"),
        F.coalesce("event_time", "ingested_at").alias("timestamp"),
        "ingested_at",
        "arrival_seq",
        "lon",
        "lat",
        "velocidad_kmh",
        F.when(
            tramo.isNotNull(),
            F.struct(
                tramo["inicio"].alias("inicio"), tramo["fin"].alias("fin"), tramo["fraccion"].try_cast("double").alias("fraccion")
            ),
        ).alias("tramo"),
        F.when(
            metrics.isNotNull(),
            F.struct(*[_number(metrics[f]).try_cast("int").alias(f) for f in schemas.METRIC_FIELDS]),
        ).alias("metrics_runtime"),
        # a rerun imputes the same time again: the arrival time is data, not the clock
        F.col("event_time").isNull().alias("ts_imputed"),
        _extra(tramo, metrics).alias("extra"),
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), F.col("raw")).alias("raw"),
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNull()).select(*schemas.columns(schemas.POSITION))


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNotNull()).select(
        "arrival_seq", "ingested_at", "reject_reason", "raw"
    )
