from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plan_text import plan
from pingloom.operators import retention, trajectory
from pingloom.operators.latest import last_n, latest, latest_by_rank

T0 = datetime(2024, 1, 1)
DDL = "bus_id string, timestamp timestamp, ingested_at timestamp, arrival_seq bigint, lat double, lon double"


def rows_of(items):
    return [
        (bus, T0 + timedelta(minutes=event), T0 + timedelta(minutes=arrival), seq, 4.6, -74.0)
        for seq, (bus, event, arrival) in enumerate(items)
    ]


def test_late_event_replaces_newer_position(spark):
    df = spark.createDataFrame(rows_of([("a", 10, 11), ("a", 5, 20)]), DDL)
    assert latest(df).first()["arrival_seq"] == 1
    assert latest(df, order="event").first()["arrival_seq"] == 0


@pytest.mark.parametrize("order", ["arrival", "event"])
def test_latest_does_not_sort_the_history(spark, order):
    df = spark.range(1000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) AS bus_id", "timestamp_seconds(id) AS timestamp", "id AS arrival_seq",
        "timestamp_seconds(id) AS ingested_at", "cast(id as string) AS payload",
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(latest(df, order=order)).splitlines()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    first_exchange = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert not any("Sort" in line for line in lines[first_exchange:])


def test_latest_of_a_hot_vehicle_with_odd_keys(spark):
    rows = [("hot", T0 + timedelta(seconds=i), T0 + timedelta(seconds=i % 50), i, 4.6, -74.0) for i in range(3000)]
    rows += [(None, None, None, None, 1.0, 1.0), (None, None, T0, None, 2.0, 1.0), ("a", None, None, -5, 1.0, 1.0), ("a", None, None, -7, 2.0, 1.0)]
    rows += [("twin", T0, T0, 9, 3.0, 1.0)] * 2
    df = spark.createDataFrame(rows, DDL)
    found = {r["bus_id"]: (r["arrival_seq"], r["lat"]) for r in latest(df).collect()}
    assert found == {"hot": (2999, 4.6), None: (None, 2.0), "a": (-5, 1.0), "twin": (9, 3.0)}
    assert {r["bus_id"]: r["arrival_seq"] for r in latest(df, order="event").collect()}["hot"] == 2999
    assert latest(df).count() == 4


def test_unknown_order(spark):
    with pytest.raises(ValueError):
        latest(spark.createDataFrame([], DDL), order="random")


pings = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.integers(0, 5)), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pings)
def test_latest_equals_ranking_and_plain_python(spark, items):
    rows = rows_of(items)
    df = spark.createDataFrame(rows, DDL)
    best = {}
    for row in rows:
        if row[0] not in best or (row[2], row[3]) > (best[row[0]][2], best[row[0]][3]):
            best[row[0]] = row
    expected = sorted(r[3] for r in best.values())
    assert sorted(r["arrival_seq"] for r in latest(df).collect()) == expected
    assert sorted(r["arrival_seq"] for r in latest_by_rank(df).collect()) == expected


@pytest.mark.parametrize("n", [1, 3, 50, 1500])
def test_last_n(spark, n):
    items = [("hot", i % 977, 0) for i in range(2000)] + [("b", 1, 0), ("b", 2, 0), (None, 3, 0)]
    rows = rows_of(items)
    expected = set()
    for bus in ("hot", "b", None):
        mine = sorted((r for r in rows if r[0] == bus), key=lambda r: (r[1], r[3]), reverse=True)
        expected |= {r[3] for r in mine[:n]}
    got = [r["arrival_seq"] for r in last_n(spark.createDataFrame(rows, DDL), n).collect()]
    assert sorted(got) == sorted(expected)


def test_last_zero_is_everything(spark):
    df = spark.createDataFrame(rows_of([("a", i, i) for i in range(5)]), DDL)
    assert last_n(df, 0).count() == 5
    with pytest.raises(ValueError):
        last_n(df, -1)


def test_ranks_are_limited_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr(
        "cast(id % 3 as string) AS bus_id", "timestamp_seconds(id) AS timestamp", "id AS arrival_seq",
        "timestamp_seconds(id) AS ingested_at",
    )
    assert plan(last_n(df, 20)).count("WindowGroupLimit") >= 3
    assert plan(last_n(df, 5000)).count("WindowGroupLimit") >= 3
    assert "WindowGroupLimit" in plan(latest_by_rank(df))


def test_retention_boundary(spark):
    df = spark.createDataFrame(rows_of([("a", 0, 0), ("a", 1, 0), ("a", 2880, 0), ("a", 5, 0)]), DDL)
    df = df.withColumn("timestamp", F.when(F.col("arrival_seq") != 3, F.col("timestamp")))
    kept = retention.unexpired(df, T0 + timedelta(days=1))
    # exactly 24 hours old has expired; without a time there is nothing to expire by
    assert sorted(r["arrival_seq"] for r in kept.collect()) == [1, 2, 3]


def test_lines_are_ordered_and_bounded(spark):
    rows = [("a", T0 + timedelta(minutes=m), T0, m, 4.0 + m, -74.0) for m in (3, 1, 2, 0)]
    line = trajectory.lines(spark.createDataFrame(rows, DDL), 3).first()
    assert [p["lat"] for p in line["trayectoria"]] == [5.0, 6.0, 7.0]
    with pytest.raises(ValueError):
        trajectory.lines(spark.createDataFrame(rows, DDL), 0)


def test_expired_date_folders_stay_closed(spark, tmp_path):
    path = str(tmp_path / "alive")
    df = spark.createDataFrame(rows_of([("a", 0, 0), ("a", 2000, 0), ("a", 2880, 0)]), DDL)
    retention.rewrite(df, path, T0 + timedelta(days=2), hours=24)
    alive = retention.unexpired(spark.read.parquet(path), T0 + timedelta(days=2))
    assert sorted(r["arrival_seq"] for r in alive.collect()) == [1, 2]
    assert "fecha" in plan(alive).split("PartitionFilters: [")[1].split("]")[0]
