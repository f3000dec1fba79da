from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plan_text import plan
from pingloom import schemas
from pingloom.plans.fact import build_fact
from pingloom.sources import fact_table, warehouse

DOCUMENT = (
    "bus_id string, ruta string, escenario string, estado string, timestamp string, ingested_at string, "
    "location struct<type: string, coordinates: array<string>>, velocidad_kmh string, "
    "tramo struct<inicio: string, fin: string, fraccion: string>, "
    "metrics_runtime struct<steps_per_segment: string, current_step: string, steps_remaining: string>"
)


def document(spark, **changes):
    values = {
        "bus_id": "B1", "ruta": "R1", "escenario": "HORA_PICO", "estado": "EN_RUTA",
        "timestamp": "2024-01-07 10:00:10.9", "ingested_at": "2024-01-07 10:00:12.1",
        "location": ("Point", ["-74.1234567", "4.6"]), "velocidad_kmh": "1.005",
        "tramo": ("a", "b", "0.12345"), "metrics_runtime": ("10", "3", "7"),
        **changes,
    }
    return spark.createDataFrame([tuple(values.values())], DOCUMENT)


def facts(spark, rows):
    """rows: (bus, event time, arrival time)"""
    base = spark.createDataFrame(rows, "bus_id string, timestamp string, ingested_at string")
    for name in schemas.columns(schemas.POSITION):
        if name not in base.columns:
            kind = schemas.struct(schemas.POSITION)[name].dataType
            base = base.withColumn(name, F.lit(None).cast(kind))
    return build_fact(base)


def test_columns_and_types(spark):
    fact = build_fact(document(spark))
    assert fact.dtypes == spark.createDataFrame([], schemas.FACT).dtypes
    assert len(fact.columns) == 19


def test_values(spark):
    row = build_fact(document(spark)).first()
    assert row["latencia_seg"] == 2  # 12 - 10: both sides are cut to the second first
    assert (row["fecha"], row["hora"], row["dia_semana"]) == (date(2024, 1, 7), 10, 1)  # a Sunday
    assert (row["lon"], row["lat"], row["velocidad_kmh_num"], row["fraccion_num"]) == (-74.123457, 4.6, 1.01, 0.123)
    assert (row["steps_per_segment_num"], row["current_step_num"], row["steps_remaining_num"]) == (10, 3, 7)


def test_bad_values_become_null_under_ansi(spark):
    row = build_fact(
        document(spark, timestamp="x", velocidad_kmh="fast", location=("Point", ["-74.1"]), metrics_runtime=("a", None, "2"))
    ).first()
    assert row["ts_evento"] is None and row["latencia_seg"] is None and row["fecha"] is None
    assert row["velocidad_kmh_num"] is None and row["lat"] is None and row["lon"] == -74.1
    assert (row["steps_per_segment_num"], row["current_step_num"], row["steps_remaining_num"]) == (None, None, 2)


def test_one_projection_without_shuffle(spark):
    text = plan(build_fact(document(spark)))
    assert "Exchange" not in text and text.count("Project") <= 1


EARLY = [("a", "2024-01-01 08:00:00", "2024-01-01 08:00:01"), ("a", "2024-01-02 08:00:00", "2024-01-02 08:00:01")]


def stored(spark, path):
    return sorted(
        (r["bus_id"], str(r["ts_evento"]), str(r["fecha"])) for r in fact_table.read_fact(spark, path).collect()
    )


def test_roundtrip_keeps_order_null_date_and_prunes(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact_table.write_fact(facts(spark, [*EARLY, ("c", None, "2024-01-02 09:00:00")]), path)
    back = fact_table.read_fact(spark, path)
    assert back.columns == schemas.columns(schemas.FACT)
    assert back.filter("fecha IS NULL").first()["bus_id"] == "c"
    pruned = back.filter("fecha = date'2024-01-02'")
    assert [r["bus_id"] for r in pruned.collect()] == ["a"]
    assert "PartitionFilters: [isnotnull(fecha" in plan(pruned)


def test_snapshot_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact_table.write_fact(facts(spark, EARLY), path)
    fact_table.write_fact(facts(spark, EARLY[:1]), path)
    assert len(stored(spark, path)) == 1


def test_accumulate_keeps_the_older_half_of_a_day(spark, tmp_path):
    path = str(tmp_path / "fact")
    morning = ("a", "2024-01-02 08:00:00", "2024-01-02 08:00:01")
    evening = ("a", "2024-01-02 20:00:00", "2024-01-02 20:00:01")
    fact_table.write_fact(facts(spark, [EARLY[0], morning, ("n", None, "2024-01-02 09:00:00")]), path, "accumulate")
    # the second extract holds the shared ping once more, and one that was sent twice
    fact_table.write_fact(facts(spark, [morning, evening, evening, ("m", None, "2024-01-03 09:00:00")]), path, "accumulate")
    assert [r[:2] for r in stored(spark, path)] == [
        ("a", "2024-01-01 08:00:00"), ("a", "2024-01-02 08:00:00"), ("a", "2024-01-02 20:00:00"),
        ("a", "2024-01-02 20:00:00"), ("m", "None"), ("n", "None"),
    ]


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        fact_table.write_fact(facts(spark, EARLY), str(tmp_path / "f"), "merge")


def test_crowded_date_is_split_over_files(spark, tmp_path):
    """One date with nearly all rows must not end in one task."""
    path = str(tmp_path / "fact")
    many = spark.range(200_000).selectExpr(
        "concat('b', id % 97) AS bus_id",
        "cast(if(id % 50 = 0, timestamp'2024-01-01', timestampadd(MILLISECOND, cast(id as int), timestamp'2024-01-02')) as string) AS timestamp",
        "cast(timestampadd(MILLISECOND, cast(id as int), timestamp'2024-01-03') as string) AS ingested_at",
    )
    for name in schemas.columns(schemas.POSITION):
        if name not in many.columns:
            many = many.withColumn(name, F.lit(None).cast(schemas.struct(schemas.POSITION)[name].dataType))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        fact_table.write_fact(build_fact(many.repartition(8)), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "fact" / "fecha=2024-01-02").glob("*.parquet"))
    assert len(files) > 3
    assert fact_table.read_fact(spark, path).count() == 200_000


def test_warehouse_refresh_truncates():
    options = warehouse.refresh_options("jdbc:x://host/db", "fact", 200, user="u")
    assert options["truncate"] == "true" and options["dbtable"] == "fact" and options["user"] == "u"
    assert options["numPartitions"] == "200"


def test_staged_refresh_writes_files_and_names_the_load(spark, tmp_path):
    folder = str(tmp_path / "it's")
    df = spark.createDataFrame([(1, "x")], 'a int, "b" string'.replace('"', "`"))
    statements = warehouse.staged_refresh(df, "public.fact", folder, "IAM_ROLE default")
    assert statements[0] == "TRUNCATE TABLE public.fact"
    doubled = folder.replace("'", "''")
    assert statements[1] == f"COPY public.fact (\"a\", \"b\") FROM '{doubled}' IAM_ROLE default FORMAT AS PARQUET"
    assert spark.read.parquet(folder).collect() == df.collect()


def test_accumulating_many_dates_collects_nothing(spark, tmp_path, monkeypatch):
    days = spark.range(60).selectExpr(
        "concat('B', id % 3) AS bus_id", "timestampadd(DAY, cast(id AS int), timestamp'2024-01-01') AS ts_evento",
        "timestamp'2024-06-01' AS ts_ingesta",
    )
    full = days.select(
        *[F.col(f.name) if f.name in days.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.struct(schemas.FACT)]
    ).withColumn("fecha", F.to_date("ts_evento"))
    path = str(tmp_path / "fact")
    fact_table.write_fact(full.filter("fecha < date'2024-02-10'"), path, "accumulate")

    def refuse(self, *args, **kwargs):
        raise AssertionError("rows came to the driver")

    with monkeypatch.context() as patched:
        patched.setattr(type(full), "collect", refuse)
        fact_table.write_fact(full.filter("fecha > date'2024-01-20'").withColumn("hora", F.lit(7)), path, "accumulate")
    stored = fact_table.read_fact(spark, path)
    assert stored.count() == 60 and stored.filter("hora = 7").count() == stored.filter("fecha > date'2024-01-20'").count() == 40


def test_a_new_version_is_switched_to_when_it_is_complete(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "fact")
    assert fact_table.read_published(spark, root).count() == 0
    old, new = ([("B1", f"2024-01-0{d} 10:00:00", f"2024-01-0{d} 10:00:01") for d in days] for days in ((1, 2), (1, 2, 3)))
    assert fact_table.publish_fact(facts(spark, old), root) == 1
    before = fact_table.read_published(spark, root)

    class Stopped(Exception):
        pass

    def fail(*_):
        raise Stopped

    # the job dies between writing the data and switching to it
    with monkeypatch.context() as broken, pytest.raises(Stopped):
        broken.setattr(type(spark), "range", fail)
        fact_table.publish_fact(facts(spark, new), root)
    assert fact_table.published_version(spark, root) == 1 and fact_table.read_published(spark, root).count() == 2
    assert fact_table.publish_fact(facts(spark, new), root) == 3
    assert fact_table.read_published(spark, root).count() == 3
    # a reader of the version before is undisturbed, and what a failed job left is gone
    assert before.count() == 2 and sorted(p.name for p in (tmp_path / "fact" / "data").iterdir()) == ["v=1", "v=3"]
    fact_table.publish_fact(facts(spark, old), root)
    assert sorted(p.name for p in (tmp_path / "fact" / "current").iterdir()) == ["v=3", "v=4"]
