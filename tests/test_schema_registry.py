import json

import pytest

from pingloom import schemas
from pingloom.operators import quality
from pingloom.sources import schema_registry as registry
from plan_text import plan
from testbed import queries, tables

DDL = "a int, s struct<x: string>, gone string"


def extract(spark, *documents):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "value string")


def listed(df):
    return {r["campo"]: (r["tipo"], r["version"]) for r in df.collect()}


def test_versions_and_changes(spark, tmp_path):
    root = str(tmp_path / "r")
    with pytest.raises(ValueError):
        registry.observe(extract(spark, {}), root)
    registry.register(spark, root, schemas.struct(DDL))
    with pytest.raises(ValueError):
        registry.register(spark, root, schemas.struct(DDL))
    assert registry.change_log(spark, root).count() == 0 and registry.current_version(spark, root) == 1

    assert registry.observe(extract(spark, {"a": 1, "s": {"x": "k"}, "gone": "z"}), root) == 1
    assert registry.change_log(spark, root).count() == 0 and registry.current_version(spark, root) == 1

    documents = [{"a": "text", "s": {"x": "k", "y": 1}, "n": 1}, {"a": 2, "n": "one"}, {"n": 2, "nothing": None}, "oops"]
    assert registry.observe(extract(spark, *documents), root) == 2
    found = {(r["campo"], r["tipo_observado"]): (r["documentos"], r["cambio"], r["accion"]) for r in registry.change_log(spark, root).collect()}
    assert found == {
        ("a", "STRING"): (1, "tipo", "rechazado"), ("s.y", "NUMBER"): (1, "agregado", "aplicado"),
        ("n", "NUMBER"): (2, "agregado", "aplicado"), ("n", "STRING"): (1, "agregado", "rechazado"),
        ("nothing", "NULL"): (1, "agregado", "anotado"), ("gone", None): (0, "eliminado", "anotado"),
        ("$", "INVALID"): (1, "ilegible", "anotado"),
    }
    first = {"a": ("NUMBER", 1), "s": ("OBJECT", 1), "s.x": ("STRING", 1), "gone": ("STRING", 1)}
    assert listed(registry.fields(spark, root, 1)) == first
    assert listed(registry.fields(spark, root)) == {**first, "s.y": ("NUMBER", 2), "n": ("NUMBER", 2)}


def test_an_unfinished_extract_is_not_seen_and_is_replaced(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "r")
    registry.register(spark, root, schemas.struct(DDL))
    write = registry._write

    def fails(rows, path):
        if "/fields/" in path:
            raise RuntimeError("lost")
        write(rows, path)

    monkeypatch.setattr(registry, "_write", fails)
    with pytest.raises(RuntimeError):
        registry.observe(extract(spark, {"b": 1}), root)
    assert registry.change_log(spark, root).count() == 0 and registry.current_version(spark, root) == 1
    monkeypatch.setattr(registry, "_write", write)
    assert registry.observe(extract(spark, {"c": 1}), root) == 1
    assert "b" not in listed(registry.fields(spark, root)) and listed(registry.fields(spark, root))["c"] == ("NUMBER", 2)
    assert {r["campo"] for r in registry.change_log(spark, root).collect()} == {"a", "s", "s.x", "gone", "c"}


def test_no_documents_note_all_fields(spark, tmp_path):
    root = str(tmp_path / "r")
    registry.register(spark, root, schemas.struct(DDL))
    registry.observe(extract(spark, "x").limit(0), root)
    assert {r["accion"] for r in registry.change_log(spark, root).collect()} == {"anotado"}
    assert registry.current_version(spark, root) == 1


def test_equal_nested_values_are_parsed_once(spark):
    """Copies below the levels of one pass are carried as a weight."""
    deep = '{"a":{"b":{"c":{"d":{"e":[1,{"f":"x"}]}}}}}'
    raw = spark.range(5000).selectExpr(f"'{deep}' AS value")
    found = {(r["campo"], r["tipo_observado"]): r["documentos"] for r in quality.field_census(raw).collect()}
    assert found[("a.b.c.d.e[].f", "STRING")] == 5000 and found[("a.b.c.d.e[]", "NUMBER")] == 5000
    assert set(found.values()) == {5000}


def test_extracts_are_parsed_by_shape(spark, tmp_path, monkeypatch):
    root, rows, taken_apart = str(tmp_path / "r"), [], quality._taken_apart
    monkeypatch.setattr(quality, "_taken_apart", lambda df: rows.append(df.count()) or taken_apart(df))
    registry.register(spark, root, schemas.struct(DDL))
    registry.observe(extract(spark, *[{"a": i, "s": {"x": f"k{i}"}, "gone": "z", "new": [i, i]} for i in range(100)]), root)
    assert listed(registry.fields(spark, root))["new"] == ("ARRAY", 2)
    assert {r["documentos"] for r in registry.change_log(spark, root).filter("campo = 'new[]'").collect()} == {200}
    assert rows[0] == 1


def test_extracts_that_differ_in_values_have_one_shape(spark, tmp_path, monkeypatch):
    """Booleans, and numbers that follow something else than a number in an array, do not make shapes either."""
    root, rows, taken_apart = str(tmp_path / "r"), [], quality._taken_apart
    monkeypatch.setattr(quality, "_taken_apart", lambda df: rows.append(df.count()) or taken_apart(df))
    registry.register(spark, root, schemas.struct(DDL))
    documents = [{"a": i, "on": i % 2 == 0, "list": ["x", i, None, i % 3 == 0, i / 4, {"b": f"t{i},1"}, {}]} for i in range(100)]
    registry.observe(extract(spark, *documents), root)
    assert rows[0] == 1
    found = {(r["campo"], r["tipo_observado"]): r["documentos"] for r in registry.change_log(spark, root).collect()}
    assert found[("on", "BOOLEAN")] == found[("list[]", "BOOLEAN")] == 100 and found[("list[]", "NUMBER")] == 200
    assert found[("list[]", "OBJECT")] == 200 and found[("list[].b", "STRING")] == 100


def test_marks_of_values_are_no_part_of_documents(spark):
    texts = ['{"a":\x01}', '{"a":e\x01}', '{"a":"\x01}', '\x01', '{"a":t5}', '{"a":"x""y"}', '{"a":true5}', '{"a":5 5}', '{"a":falsee}', '{"a":nul}']
    found = quality.field_census(extract(spark, *texts, '{"a":false}', '{"a":1}')).collect()
    assert {(r["campo"], r["tipo_observado"]): r["documentos"] for r in found} == {
        ("$", "INVALID"): len(texts), ("a", "BOOLEAN"): 1, ("a", "NUMBER"): 1,
    }


def test_more_names_in_a_row_than_are_taken_at_once(spark):
    deep = '{"a":' * 70 + "%d" + "}" * 70 + "%s"
    found = quality.field_census(extract(spark, *[deep % (i, "") for i in range(3)], deep % (1, "x"))).collect()
    counts = {r["campo"]: r["documentos"] for r in found}
    assert counts[".".join("a" * 70)] == 3 and counts["$"] == 1


def test_pings_of_one_row_group_are_spread_before_they_are_made(spark, tmp_path, monkeypatch):
    root, extracts, observe = str(tmp_path), [], registry.observe
    spark.range(200).coalesce(1).selectExpr(
        "CASE WHEN id % 50 = 49 THEN NULL ELSE id % 150 END AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts",
        "id AS user_id", "'view' AS event_type", "id / 4 AS value", "concat('{\"k\": ', id, '}') AS props",
    ).write.parquet(f"{root}/events.parquet")
    monkeypatch.setattr(registry, "observe", lambda raw, root: extracts.append(raw) or observe(raw, root))
    queries.schema_versions(spark, root).collect()
    assert len(extracts) == 2 and all("hashpartitioning(event_id" in plan(raw) for raw in extracts)
    together = extracts[0].unionByName(extracts[1])
    plainly = tables.raw_pings(spark, root).filter("seq IS NOT NULL")
    assert together.count() == plainly.count() and together.exceptAll(plainly).isEmpty()
