"""Looks at the data itself: profile, schema drift, rule checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingloom.functions import motion
from pingloom.operators.ingest import document_text, is_whole, once
from pingloom.session import spool


def profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls and non-nulls, from a single scan."""
    counts = [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    one_row = df.agg(F.count(F.lit(1)).alias("_filas"), *counts)
    return one_row.unpivot("_filas", df.columns, "columna", "no_nulos").select(
        "columna",
        F.col("_filas").alias("filas"),
        (F.col("_filas") - F.col("no_nulos")).alias("nulos"),
        "no_nulos",
    )


def registered_fields(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(path, JSON kind) for every leaf and object of a schema."""
    kinds = []
    for field in schema:
        path = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            kinds.append((path, "OBJECT"))
            kinds += registered_fields(field.dataType, path + ".")
        elif isinstance(field.dataType, T.ArrayType):
            kinds.append((path, "ARRAY"))
            kinds += registered_fields(T.StructType([T.StructField("[]", field.dataType.elementType)]), path)
        elif isinstance(field.dataType, T.BooleanType):
            kinds.append((path, "BOOLEAN"))
        elif isinstance(field.dataType, T.NumericType):
            kinds.append((path, "NUMBER"))
        else:
            kinds.append((path, "STRING"))
    return kinds


_ENTRIES = "array<struct<key: string, value: variant>>"
UNREADABLE = "$"
# Levels of nesting taken apart in one pass.
LEVELS = 2


def _children(value: Column) -> Column:
    """The fields of an object under ``.name``, the elements of an array under ``[]``; none for other values."""
    fields = F.transform(
        F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")),
        lambda e: F.struct(F.concat(F.lit("."), e["key"]).alias("key"), e["value"].alias("value")),
    )
    items = F.transform(
        F.try_variant_get(value, "$", "array<variant>"), lambda x: F.struct(F.lit("[]").alias("key"), x.alias("value"))
    )
    return F.coalesce(fields, items, F.array().cast(_ENTRIES))


def _kind(value: Column) -> Column:
    name = F.substring_index(F.substring_index(F.schema_of_variant(value), "(", 1), "<", 1)
    return F.when(name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").when(name == "VOID", "NULL").otherwise(name)


def _taken_apart(rows: DataFrame) -> DataFrame:
    """Every value on the next ``LEVELS`` levels below ``value``: its path, and whether its own children are still inside.

    ``n`` says for how many equal values a row stands. A row without a value stays, without a path. The outer form of explode keeps Spark from parsing each document twice,
    first to skip the empty ones.
    """
    found = rows.select("path", "n", F.explode_outer(_children(F.col("value"))).alias("f"), F.col("value").isNull().alias("unreadable"))
    found = found.select(F.concat("path", "f.key").alias("path"), F.col("f.value").alias("value"), F.lit(True).alias("open"), "unreadable", "n")
    for _ in range(LEVELS - 1):
        itself = F.array(F.struct(F.lit("").alias("key"), F.col("value").alias("value"), F.lit(False).alias("open")))
        below = F.transform(_children(F.col("value")), lambda c: F.struct(c["key"], c["value"], F.lit(True).alias("open")))
        found = found.select("path", "unreadable", "n", F.explode_outer(F.when(F.col("open"), F.concat(itself, below)).otherwise(itself)).alias("f"))
        found = found.select(F.concat("path", "f.key").alias("path"), F.col("f.value").alias("value"), F.col("f.open").alias("open"), "unreadable", "n")
    return found


# A text is gone through once, value by value, each match beginning where the one before it ends; from the first escape or
# thing that is no part of JSON on, the rest is left as it is. In front of a value stand brackets, commas and names, which
# are kept, and so are numbers right behind a name that ends in no letter or digit, or has a space before its colon.
_NUMBER = r"-?(?:0|[1-9]\d{0,17})(?:\.\d{1,20})?(?:[eE][+-]?\d{1,2})?"
_CHARS = r'[^"\\\x00-\x1f]*+"'
_BEFORE = rf'[\s,\[\]{{}}]*+(?:"{_CHARS}\s*+:(?:(?<!\w":)\s*+[-+.\deE]++)?[\s,\[\]{{}}]*+){{0,64}}+'
_VALUES = rf'\G({_BEFORE})(?:("){_CHARS}(?!\s*+:)|(?:{_NUMBER}|tru(e)|fals(e)|nul(l))(?=[\s,\]}}]))'
# Stands behind what is left of a value; no character of JSON.
_MARK = "\x01"
# Documents of more bytes are left as they are, so that the limits of the parser tell as before.
SHAPED_LENGTH = 1 << 20


def _has_shape(doc: Column) -> Column:
    """False where broken characters, no object or the name that ``is_whole`` reads make a document its own shape."""
    odd = doc.contains('"_end"') | doc.contains(_MARK)
    return doc.startswith("{") & ~odd & (F.octet_length(doc) <= SHAPED_LENGTH) & F.is_valid_utf8(doc)


def _outline(doc: Column) -> Column:
    """The document with a mark for each value: behind a quote for a string, ``e`` for a boolean, ``l`` for null, alone for a number."""
    return F.regexp_replace(doc, _VALUES, "$1$2$3$4$5" + _MARK)


def _filled(outline: Column) -> Column:
    """The outline as a document again, with one value of each kind."""
    for mark, value in (('"', '""'), ("e", "true"), ("l", "null"), ("", "0")):
        outline = F.replace(outline, F.lit(mark + _MARK), F.lit(value))
    return outline


def shape(doc: Column) -> Column:
    """The document with its strings emptied, its numbers made 0 and its booleans true; names, nesting and defects stay.

    Documents of one shape have the same kinds at the same paths, or none of them can be read. A token is replaced by
    one of its kind only, so text that is no JSON does not become JSON.
    """
    return F.when(_has_shape(doc), _filled(_outline(doc))).otherwise(doc)


def field_census(raw: DataFrame, value: str = "value") -> DataFrame:
    """How many values stand at each path, by JSON kind, at any depth; array elements stand at ``path[]``.

    Documents are counted by their shape first and one of each is parsed. Those that cannot be read are one row at ``$``. ``LEVELS`` levels are taken apart at a time and counted before
    the shuffle; objects and arrays below them, if there are any, are written out once for all equal ones and taken apart
    in the next round, where each stands for as many as it was counted.
    """
    texts = once(raw, F.col(value).alias("raw"), document_text(F.col(value)).alias("doc"))
    # what a document is wrapped in has to be judged by itself
    enclosed = (F.col("doc") == F.col("raw")) | is_whole(F.col("raw"))
    judged = once(texts, F.when(enclosed, F.col("doc")).alias("doc"))
    # grouped by outlines, of which only the distinct ones are filled again
    shaped = _has_shape(F.col("doc"))
    outlines = judged.groupBy(F.when(shaped, _outline(F.col("doc"))).otherwise(F.col("doc")).alias("outline"), shaped.alias("shaped"))
    shapes = once(
        outlines.agg(F.count(F.lit(1)).alias("n")),
        F.when(F.col("shaped"), _filled(F.col("outline"))).otherwise(F.col("outline")).alias("doc"), "n",
    )
    rows = once(shapes, F.lit("").alias("path"), F.when(is_whole(F.col("doc")), F.try_parse_json("doc")).alias("value"), "n")
    found: DataFrame | None = None
    while True:
        values = _taken_apart(rows).select(
            F.when(F.col("unreadable"), UNREADABLE).otherwise(F.col("path")).alias("path"),
            F.when(F.col("unreadable"), "INVALID").otherwise(_kind(F.col("value"))).alias("kind"), "value", "open", "n",
        ).filter("kind IS NOT NULL")
        nested = F.when(F.col("open") & F.col("kind").isin("OBJECT", "ARRAY"), F.to_json("value"))
        counts = spool(values.groupBy("path", "kind", nested.alias("nested")).agg(F.sum("n").alias("n")), "census")
        level = counts.groupBy("path", "kind").agg(F.sum("n").alias("n"))
        found = level if found is None else found.unionByName(level)
        deeper = counts.filter(F.col("nested").isNotNull())
        if not deeper.take(1):
            break
        rows = deeper.select("path", F.try_parse_json("nested").alias("value"), "n")
    return found.groupBy(F.regexp_replace("path", r"^\.", "").alias("campo"), F.col("kind").alias("tipo_observado")).agg(
        F.sum("n").alias("documentos")
    )


def schema_drift(raw: DataFrame, registered: T.StructType, value: str = "value") -> DataFrame:
    """Observed fields against the registered schema.

    ``cambio`` is ``agregado`` (new field), ``tipo`` (another kind than registered), ``igual``,
    ``eliminado`` (registered but in no document), or ``ilegible`` for documents that cannot be read.
    """
    # a handful of rows: the registered schema itself
    known = raw.sparkSession.createDataFrame(registered_fields(registered), "campo string, tipo_registrado string")
    return schema_changes(raw, known, value)


def schema_changes(raw: DataFrame, known: DataFrame, value: str = "value") -> DataFrame:
    """The same for registered fields given as rows of ``campo`` and ``tipo_registrado``."""
    change = (
        F.when(F.col("campo") == UNREADABLE, "ilegible")
        .when(F.col("tipo_registrado").isNull(), "agregado")
        .when(F.col("tipo_observado").isNull(), "eliminado")
        .when(F.col("tipo_observado") == F.col("tipo_registrado"), "igual")
        .when(F.col("tipo_observado") == "NULL", "igual")
        .otherwise("tipo")
    )
    return field_census(raw, value).join(known, "campo", "full").select(
        "campo",
        "tipo_registrado",
        "tipo_observado",
        F.coalesce("documentos", F.lit(0).cast("bigint")).alias("documentos"),
        change.alias("cambio"),
    )


def additive_schema(registered: T.StructType, observed: T.StructType) -> T.StructType:
    """The registered schema plus new fields; nothing is ever removed or retyped."""
    have = {f.name: f for f in registered}
    merged = []
    for field in registered:
        seen = next((f for f in observed if f.name == field.name), None)
        if seen is not None and isinstance(field.dataType, T.StructType) and isinstance(seen.dataType, T.StructType):
            merged.append(T.StructField(field.name, additive_schema(field.dataType, seen.dataType), field.nullable))
        else:
            merged.append(field)
    return T.StructType(merged + [f for f in observed if f.name not in have])


def invalid_progress(df: DataFrame, fraction: str = "fraccion") -> DataFrame:
    """Rows whose progress lies outside [0, 1]."""
    return df.filter(~motion.progress_valid(F.col(fraction)))


def speed_check(df: DataFrame) -> DataFrame:
    """Expected speed range for each position and whether the reported speed keeps to it."""
    band = motion.speed_band(F.col("estado"), F.col("escenario"))
    return df.select(
        "*",
        band["lo"].alias("vel_min"),
        band["hi"].alias("vel_max"),
        motion.speed_conforms(F.col("velocidad_kmh"), band).alias("vel_conforme"),
    )
