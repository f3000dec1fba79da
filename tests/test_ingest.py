"""Edge rows of ping validation."""

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pingloom.operators import ingest, quality
from pingloom import schemas
from pingloom.sources import pings

ARRIVED = datetime(2025, 11, 10, 19, 0, 0)


def ping(**changes):
    doc = {
        "bus_id": "B1",
        "ruta": "R1",
        "timestamp": "2025-11-10T18:43:51.123456",
        "location": {"type": "Point", "coordinates": [-74.05, 4.6]},
        "estado": "EN_RUTA",
        "velocidad_kmh": 12.5,
        "escenario": "HORA_PICO",
        "direccion": "IDA",
        "tramo": {"inicio": "a", "fin": "b", "fraccion": 0.25},
        "metrics_runtime": {"steps_per_segment": 20, "current_step": 5, "steps_remaining": 15},
    }
    for key, value in changes.items():
        if value is DROP:
            doc.pop(key, None)
        else:
            doc[key] = value
    return doc


DROP = object()


def at(lon, lat):
    return {"type": "Point", "coordinates": [lon, lat]}


CASES = {
    "valid": (ping(), None),
    "wrapped": ({"body": json.dumps(ping())}, None),
    "wrapped, body null": ({"body": None}, "malformed"),
    "wrapped, body not text": ({"body": ping()}, "malformed"),
    "wrapped, body broken": ({"body": "{oops"}, "malformed"),
    "the word body in a value": (ping(ruta='"body"'), None),
    "no bus": (ping(bus_id=DROP), "missing_required"),
    "empty bus": (ping(bus_id=""), "missing_required"),
    "null bus": (ping(bus_id=None), "missing_required"),
    "zero bus": (ping(bus_id=0), "missing_required"),
    "bus named zero": (ping(bus_id="0"), None),
    "numeric bus": (ping(bus_id=101), None),
    "latitude zero": (ping(location=at(-74.05, 0)), "missing_required"),
    "latitude text zero": (ping(location=at(-74.05, "0")), "out_of_bounds"),
    "latitude as text": (ping(location=at("-74.05", "4.6")), None),
    "latitude false": (ping(location=at(-74.05, False)), "missing_required"),
    "fallback for nulls": (ping(location=at(None, None), lat=4.6, lon=-74.05), None),
    "fallback for zero": (ping(location=at(-74.05, 0), lat=4.6), None),
    "fallback also zero": (ping(location=at(-74.05, 0), lat=0), "missing_required"),
    "no location, fallback": (ping(location=DROP, lat=4.6, lon=-74.05), None),
    "no location, no fallback": (ping(location=DROP), "missing_required"),
    "location null": (ping(location=None, lat=4.6, lon=-74.05), "malformed"),
    "location a number": (ping(location=5), "malformed"),
    "location without coordinates": (ping(location={"type": "Point"}, lat=4.6, lon=-74.05), None),
    "coordinates null": (ping(location={"coordinates": None}, lat=4.6, lon=-74.05), "malformed"),
    "coordinates an object": (ping(location={"coordinates": {"x": 1}}), "malformed"),
    "one coordinate": (ping(location={"coordinates": [-74.05]}), "malformed"),
    "no coordinates": (ping(location={"coordinates": []}), "malformed"),
    "third coordinate": (ping(location={"coordinates": [-74.05, 4.6, 2600]}), None),
    "latitude not a number": (ping(location=at(-74.05, "abc")), "malformed"),
    "low edge": (ping(location=at(-74.3, 4.45)), None),
    "high edge": (ping(location=at(-73.9, 4.85)), None),
    "just below": (ping(location=at(-74.05, 4.4499)), "out_of_bounds"),
    "just east": (ping(location=at(-73.8999, 4.6)), "out_of_bounds"),
    "nan": (ping(location=at(-74.05, float("nan"))), "out_of_bounds"),
    "nan as text": (ping(location=at(-74.05, "NaN")), "out_of_bounds"),
    "speed not a number": (ping(velocidad_kmh="fast"), "malformed"),
    "speed empty": (ping(velocidad_kmh=""), "malformed"),
    "speed null": (ping(velocidad_kmh=None), None),
    "speed missing": (ping(velocidad_kmh=DROP), None),
    "speed as text": (ping(velocidad_kmh="12.5"), None),
    "bad speed outside": (ping(velocidad_kmh="fast", location=at(-74.05, 9.0)), "out_of_bounds"),
    "bad speed, no bus": (ping(velocidad_kmh="fast", bus_id=""), "missing_required"),
    "segment null": (ping(tramo=None), "malformed"),
    "segment null, no bus": (ping(tramo=None, bus_id=""), "malformed"),
    "segment missing": (ping(tramo=DROP), None),
    "segment empty": (ping(tramo={}), None),
    "segment a list": (ping(tramo=[]), "malformed"),
    "segment text": (ping(tramo="x"), "malformed"),
    "metrics null": (ping(metrics_runtime=None), "malformed"),
    "metrics missing": (ping(metrics_runtime=DROP), None),
    "extra key": (ping(firmware="v2"), None),
    "broken": ('{"bus_id": "B1"', "malformed"),
    "not an object": ("[1, 2]", "malformed"),
    "blank": ("", "malformed"),
    "null": ("null", "malformed"),
}


@pytest.fixture(scope="module")
def outcomes(spark):
    rows = [
        (i, doc if isinstance(doc, str) else json.dumps(doc), ARRIVED) for i, (doc, _) in enumerate(CASES.values())
    ]
    raw = spark.createDataFrame(rows, "seq bigint, value string, arrived_at timestamp")
    decoded = ingest.decode(raw, seq="seq")
    return {r["arrival_seq"]: r for r in decoded.collect()}


@pytest.mark.parametrize("name", CASES)
def test_outcome(outcomes, name):
    row = outcomes[list(CASES).index(name)]
    assert row["reject_reason"] == CASES[name][1]
    assert (row["raw"] is None) == (CASES[name][1] is None)


def test_values_survive(outcomes):
    row = outcomes[0]
    assert (row["bus_id"], row["lon"], row["lat"], row["velocidad_kmh"]) == ("B1", -74.05, 4.6, 12.5)
    assert row["tramo"].asDict() == {"inicio": "a", "fin": "b", "fraccion": 0.25}
    assert row["metrics_runtime"]["steps_remaining"] == 15
    assert outcomes[1]["bus_id"] == "B1"
    assert outcomes[list(CASES).index("numeric bus")]["bus_id"] == "101"
    assert outcomes[list(CASES).index("segment missing")]["tramo"] is None


def test_nothing_is_lost(spark):
    docs = [json.dumps(d) if not isinstance(d, str) else d for d, _ in CASES.values()] + [None]
    raw = spark.createDataFrame([(d, ARRIVED) for d in docs], "value string, arrived_at timestamp")
    decoded = ingest.decode(raw)
    assert ingest.accepted(decoded).count() + ingest.rejected(decoded).count() == len(docs)


@pytest.mark.parametrize(
    "text, expected, imputed",
    [
        ("2025-11-10T18:43:51.123456", datetime(2025, 11, 10, 18, 43, 51, 123456), False),
        ("2025-11-10T18:43:51Z", datetime(2025, 11, 10, 18, 43, 51), False),
        ("2025-11-10T18:43:51-05:00", datetime(2025, 11, 10, 23, 43, 51), False),
        ("x", ARRIVED, True),
        (None, ARRIVED, True),
        ("", ARRIVED, True),
    ],
)
def test_event_time(spark, text, expected, imputed):
    raw = spark.createDataFrame([(json.dumps(ping(timestamp=text)), ARRIVED)], "value string, arrived_at timestamp")
    row = ingest.accepted(ingest.decode(raw)).select(F.col("timestamp").cast("timestamp_ntz"), "ts_imputed").first()
    assert tuple(row) == (expected, imputed)


def test_accepted_shape(spark):
    raw = spark.createDataFrame([(json.dumps(ping()), ARRIVED)], "value string, arrived_at timestamp")
    assert ingest.accepted(ingest.decode(raw)).dtypes == spark.createDataFrame([], schemas.POSITION).dtypes


def test_drift_reports_new_missing_and_retyped(spark):
    docs = [ping(firmware="v2", lat=4.6), ping(velocidad_kmh="fast", direccion=DROP)]
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    found = {(r.campo, r.tipo_observado): r.cambio for r in quality.schema_drift(raw, schemas.struct(schemas.PING)).collect()}
    assert found[("firmware", "STRING")] == "agregado"
    assert found[("velocidad_kmh", "STRING")] == "tipo"
    assert found[("lon", None)] == "eliminado"
    assert found[("tramo.fraccion", "NUMBER")] == "igual"


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"a":-1.5,"b":"x: 1,","c":[1, 2e3,[3],"4",null]}', '{"a":0,"b":"","c":[0, 0,[0],"",null]}'),
        ('{"k 12 ,5]":"","a" : 7 }', '{"k 12 ,5]":"","a" : 7 }'),
        # neither names nor defects change
        ('{":5,":1,"a:1,b":true}', '{":5,":1,"a:1,b":true}'),
        ('{"a":01,"b":1.,"c":+1,"d":1x}', '{"a":01,"b":1.,"c":+1,"d":1x}'),
        ('{"a":12}{"a":12}', '{"a":0}{"a":0}'),
        # what cannot be told without parsing is left alone
        ('{"a":"\\"","b":12}', '{"a":"\\"","b":12}'),
        ('{"_end":12}', '{"_end":12}'),
        ("[12]", "[12]"),
        (None, None),
    ],
)
def test_shape_keeps_names_nesting_and_defects(spark, text, expected):
    assert spark.createDataFrame([(text,)], "doc string").select(quality.shape(F.col("doc"))).first()[0] == expected


def test_shape_is_read_as_its_document_is(spark):
    texts = ['{"a":1,"b":["x",2.5,{"c":null}]}', '{"a":"p\nq","b":1}', '{"a":1} ]', '{"ñ":"é","n":[[1,2],[3]]}', '{"a":"b":1}', '{"a":1,"a":2}', '{"a":"']
    texts += [t[:i] + c + t[i:] for t in texts for i in range(0, len(t), 2) for c in ('"', ",", "1", ":", "]")]

    def census(column):
        return sorted(map(tuple, quality.field_census(docs.select(column.alias("value"))).collect()))

    # an escape keeps a document from having a shape
    docs = spark.createDataFrame([(t,) for t in texts], "value string")
    plain = F.when(F.col("value").startswith("{"), F.concat(F.lit('{"z":0,'), F.substring("value", 2, 10**6))).otherwise(F.col("value"))
    escaped = F.when(F.col("value").startswith("{"), F.concat(F.lit('{"\\u007a":0,'), F.substring("value", 2, 10**6))).otherwise(F.col("value"))
    assert census(plain) == census(escaped)


def test_documents_of_one_shape_are_parsed_once(spark, monkeypatch):
    rows = []
    taken_apart = quality._taken_apart
    monkeypatch.setattr(quality, "_taken_apart", lambda df: rows.append(df.count()) or taken_apart(df))
    raw = spark.createDataFrame([(json.dumps(ping(bus_id=f"B{i}", velocidad_kmh=i / 4)),) for i in range(200)], "value string")
    found = {r["campo"]: r["documentos"] for r in quality.field_census(raw).collect()}
    assert found["bus_id"] == found["velocidad_kmh"] == 200
    assert rows[0] == 1


@pytest.mark.parametrize("tail", ["{}", "x", "]", "}", ",", " 1", '{"a":1}', "]}", '],"x":[1', ',{"_end":1}]', "null", '"'])
def test_text_behind_a_document_is_malformed(spark, tail):
    text = json.dumps(ping())
    rows = [(text + tail, ARRIVED), (json.dumps({"body": text + tail}), ARRIVED), (json.dumps({"body": text}) + tail, ARRIVED)]
    raw = spark.createDataFrame(rows, "value string, arrived_at timestamp")
    found = ingest.rejected(ingest.decode(raw)).collect()
    assert [r["reject_reason"] for r in found] == ["malformed"] * 3 and found[0]["raw"] == text + tail


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='{}[]",:01 \n\tae\\', max_size=12), min_size=20, max_size=40))
def test_whole_documents_are_those_python_reads(spark, texts):
    documents = [*texts, *[json.dumps(ping()) + t for t in texts], *[t + '{"a":[1,{}]}' for t in texts]]

    def readable(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    df = spark.createDataFrame(list(enumerate(documents)), "i int, v string")
    found = {r["i"]: r["ok"] for r in df.select("i", ingest.is_whole(F.col("v")).alias("ok")).collect()}
    for i, text in enumerate(documents):
        # values that are no objects are refused later, so they may pass or not
        if found[i] != readable(text):
            try:
                assert not isinstance(json.loads(text), dict)
            except ValueError:
                raise AssertionError(text) from None


falsy_or_not = st.one_of(
    st.none(), st.booleans(), st.integers(-2, 2), st.sampled_from([0.0, -0.0, 4.6, -74.05, 1e-400]),
    st.sampled_from(["", "0", "-0", "0.0", "4.6", "false", "f", ".5", "-.5", "+1", "x", "[", "{}"]), st.just([]), st.just({}), st.just([0]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(falsy_or_not, falsy_or_not, falsy_or_not), min_size=30, max_size=60))
def test_the_quick_path_agrees_with_json_types(spark, triples):
    """A value is missing exactly if Python counts it as false, whichever path decides."""
    docs = [ping(bus_id=b, location=at(lon, lat)) for b, lon, lat in triples]
    raw = spark.createDataFrame([(json.dumps(d), ARRIVED, i) for i, d in enumerate(docs)], "value string, arrived_at timestamp, seq bigint")
    found = {r["arrival_seq"]: r["reject_reason"] for r in ingest.decode(raw, seq="seq").collect()}
    for i, triple in enumerate(triples):
        assert (found[i] == "missing_required") == (not all(triple)), triple


def test_counters_and_other_keys_survive(spark):
    document = ping(tramo={"inicio": "a", "meta": {"zona": [1]}}, metrics_runtime={"steps_per_segment": 10.0, "current_step": "7", "lote": "x"})
    raw = spark.createDataFrame([(json.dumps(document), ARRIVED)], "value string, arrived_at timestamp")
    row = ingest.accepted(ingest.decode(raw)).first()
    assert (row["metrics_runtime"]["steps_per_segment"], row["metrics_runtime"]["current_step"]) == (10, 7)
    assert row["extra"] == {"tramo.meta": '{"zona":[1]}', "metrics_runtime.lote": "x"}


def test_census_goes_to_any_depth(spark):
    deep = '{"a":' * 9 + '[1,"x",null,{"b":true}]' + "}" * 9
    raw = spark.createDataFrame([(deep,), (deep,), ("oops",), (deep + deep,), ("{}",)], "value string")
    found = {(r["campo"], r["tipo_observado"]): r["documentos"] for r in quality.field_census(raw).collect()}
    bottom = ".".join(["a"] * 9)
    assert found[("$", "INVALID")] == 2
    assert found[("a", "OBJECT")] == 2 and found[(bottom, "ARRAY")] == 2
    assert {k[1]: v for k, v in found.items() if k[0] == f"{bottom}[]"} == {"NUMBER": 2, "STRING": 2, "NULL": 2, "OBJECT": 2}
    assert found[(f"{bottom}[].b", "BOOLEAN")] == 2


def test_added_fields_are_read(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"bus_id":"a","tramo":{"inicio":"x","via":2}}\n{"bus_id":"b","firmware":"v2"}\n')
    read = pings.read_documents(spark, str(tmp_path), "json", "bus_id string, ruta string, tramo struct<inicio: string>", additive=True)
    assert read.columns == ["bus_id", "ruta", "tramo", "firmware"]
    assert [(r["bus_id"], r["firmware"], r["tramo"] and r["tramo"]["via"]) for r in read.orderBy("bus_id").collect()] == [("a", None, 2), ("b", "v2", None)]


def test_additive_schema():
    old = schemas.struct("a int, s struct<x: int>")
    new = schemas.struct("a string, s struct<y: int>, b double")
    assert quality.additive_schema(old, new).simpleString() == "struct<a:int,s:struct<x:int,y:int>,b:double>"
