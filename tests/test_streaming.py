import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from plan_text import plan
from pyarrow import parquet
from pyspark.sql import functions as F

from pingloom import schemas
from pingloom.functions import geo
from pingloom.operators import ingest
from pingloom.operators.latest import latest
from pingloom.plans.fact import build_fact
from pingloom.sources import fact_table, pings
from pingloom.streaming import incremental, keyed, landing, snapshot

T0 = datetime(2024, 1, 1)


def line(seq, bus, event, arrival, lat=4.6):
    doc = {
        "bus_id": bus, "timestamp": (T0 + timedelta(minutes=event)).isoformat(),
        "location": {"coordinates": [-74.0, lat]}, "tramo": {}, "metrics_runtime": {},
    }
    return {"value": json.dumps(doc), "arrived_at": (T0 + timedelta(minutes=arrival)).isoformat(), "seq": seq}


# the third file holds a late ping of "a" and a ping outside of the service area
FILES = [
    [line(1, "a", 10, 10), line(2, "b", 1, 11)],
    [line(3, "a", 20, 21), line(3, "a", 20, 21)],
    [line(4, "a", 5, 30), line(5, "c", 1, 31, lat=9.0), line(6, "b", 0, 2)],
]


def drop(folder, number, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"part-{number}.json").write_text("\n".join(json.dumps(x) for x in lines))


@pytest.mark.parametrize("split", [[[0, 1, 2]], [[0], [1], [2]], [[0, 1], [2]]])
def test_any_split_gives_the_batch_result(spark, tmp_path, split):
    folder, store = tmp_path / "in", landing.Store(str(tmp_path / "store"))
    batch = None
    for run in split:
        for number in run:
            drop(folder, number, FILES[number])
        query = landing.start_ingest(landing.raw_stream(spark, str(folder), 1), store)
        query.awaitTermination()
        batch = landing.last_batch(query)
    history = store.history(spark)
    # repeats are stored as they come
    assert sorted(r["arrival_seq"] for r in history.collect()) == [1, 2, 3, 3, 4, 6]
    assert [(r["arrival_seq"], r["reject_reason"]) for r in store.rejects(spark).collect()] == [(5, "out_of_bounds")]
    streamed = sorted((r["bus_id"], r["arrival_seq"]) for r in store.latest(spark, batch).collect())
    assert streamed == [("a", 4), ("b", 2)]
    assert streamed == sorted((r["bus_id"], r["arrival_seq"]) for r in latest(history).collect())


def test_a_batch_run_twice_is_stored_once(spark, tmp_path):
    store = landing.Store(str(tmp_path / "store"))
    raw = spark.createDataFrame(
        [(x["value"], datetime.fromisoformat(x["arrived_at"]), x["seq"]) for f in FILES for x in f], landing.RAW
    )
    decoded = ingest.decode(raw, seq="seq")
    for _ in range(2):
        store.write_batch(decoded, 0)
    assert store.history(spark).count() == 6
    store.write_batch(decoded.limit(0), 1)
    assert store.latest(spark, 1).count() == 2


def test_nothing_new_changes_nothing(spark, tmp_path):
    folder, store = tmp_path / "in", landing.Store(str(tmp_path / "store"))
    drop(folder, 0, FILES[0])
    batches = []
    for _ in range(2):
        query = landing.start_ingest(landing.raw_stream(spark, str(folder)), store)
        query.awaitTermination()
        batches.append(landing.last_batch(query))
    assert batches == [0, None]
    assert store.history(spark).count() == 2
    assert sorted(r["bus_id"] for r in store.current(spark).collect()) == ["a", "b"]


def test_a_new_store_is_empty(spark, tmp_path):
    store = landing.Store(str(tmp_path / "store"))
    assert (store.current(spark).count(), store.history(spark).count(), store.rejects(spark).count()) == (0, 0, 0)


def test_lookups_are_served_from_the_store(spark, tmp_path):
    folder, store = tmp_path / "in", landing.Store(str(tmp_path / "store"))
    for number, lines in enumerate(FILES):
        drop(folder, number, lines)
    landing.start_ingest(landing.raw_stream(spark, str(folder), 1), store).awaitTermination()
    stations = spark.createDataFrame([(1, "s", 4.6, -74.0, "P")], "id int, nombre string, latitud double, longitud double, tipo string")
    served = landing.Store(store.root).positions(spark, stations)
    assert [r["bus_id"] for r in served.lookup("near_station", id="1").collect()] == ["a", "b"]
    assert [r["arrival_seq"] for r in served.lookup("history", bus_id="a").collect()] == [3, 3, 1, 4]


def test_compaction_drops_the_expired_and_what_it_replaces(spark, tmp_path):
    folder, store = tmp_path / "in", landing.Store(str(tmp_path / "store"))
    for number, lines in enumerate(FILES):
        drop(folder, number, lines)
    landing.start_ingest(landing.raw_stream(spark, str(folder), 1), store).awaitTermination()
    before = sorted(r["bus_id"] for r in store.current(spark).collect())
    for _ in range(2):
        store.compact(spark, T0 + timedelta(hours=24, minutes=5), keep_snapshots=1)
    # events of minutes 5, 1 and 0 are 24 hours old or more; rejects stay
    assert sorted(r["arrival_seq"] for r in store.history(spark).collect()) == [1, 3, 3]
    assert store.rejects(spark).count() == 1
    assert sorted(r["bus_id"] for r in store.current(spark).collect()) == before
    # of the three batches, those whose buckets are still the newest
    assert sorted(p.name for p in (tmp_path / "store" / "latest").iterdir()) in (["batch_id=2"], ["batch_id=0", "batch_id=2"])
    assert list((tmp_path / "store" / "pings").iterdir()) == []
    # an ingest goes on where it was
    drop(folder, 3, [line(7, "d", 1500, 1500)])
    landing.start_ingest(landing.raw_stream(spark, str(folder), 1), store).awaitTermination()
    assert sorted(r["bus_id"] for r in store.current(spark).collect()) == ["a", "b", "d"]
    assert sorted(r["arrival_seq"] for r in store.history(spark).collect()) == [1, 3, 3, 7]


def test_files_of_a_batch_are_sorted_by_vehicle(spark, tmp_path):
    store = landing.Store(str(tmp_path / "store"))
    rows = [(x["value"], datetime.fromisoformat(x["arrived_at"]), x["seq"]) for x in (line(i, f"b{i * 7 % 10}", 1, 1) for i in range(30))]
    store.write_batch(ingest.decode(spark.createDataFrame(rows, landing.RAW).coalesce(1), seq="seq"), 0)
    stored = [r["bus_id"] for r in spark.read.parquet(store.batch_folder(0)).collect()]
    assert stored == sorted(stored)


@pytest.mark.parametrize("whole", [False, True])
def test_bare_bodies_stream(spark, tmp_path, whole):
    folder, store = tmp_path / "in", landing.Store(str(tmp_path / "store"))
    folder.mkdir()
    docs = [json.loads(x["value"]) for f in FILES for x in f]
    if whole:
        for i, doc in enumerate(docs):
            (folder / f"{i}.json").write_text(json.dumps(doc, indent=2))
    else:
        (folder / "all.json").write_text("\n".join(json.dumps(d) for d in docs) + "\n\n")
    landing.start_ingest(landing.body_stream(spark, str(folder), whole=whole), store).awaitTermination()
    assert sorted(r["bus_id"] for r in store.history(spark).collect()) == ["a", "a", "a", "a", "b", "b"]
    assert store.rejects(spark).count() == 1


def test_the_order_in_a_landed_file_decides(spark, tmp_path):
    (tmp_path / "x.json").write_text("\n".join(line(i, "a", 5, 0, lat=4.5 + i / 10_000)["value"] for i in range(3000)))
    found = latest(ingest.accepted(ingest.decode(pings.read_landing(spark, str(tmp_path)), seq="seq")))
    assert [r["lat"] for r in found.collect()] == [4.7999]


def test_a_large_landed_file_is_read_in_parts(spark, tmp_path):
    """Lines are not gathered in one value; their order holds over the parts of a file, blank lines and line breaks included."""
    docs = [line(i, "a", 5, 0, lat=4.5 + i / 10_000)["value"] for i in range(3000)]
    (tmp_path / "x.json").write_bytes("\r\n\n\n".join(docs).encode() + b"\n" * 2000)
    (tmp_path / "y.json").write_bytes(b"\n" * 6000 + line(0, "b", 5, 0)["value"].encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = pings.read_landing(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 20
        found = [(r["seq"], r["value"]) for r in rows.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({seq for seq, _ in found}) == len(found) == 3001
    assert [v for _, v in sorted(found) if '"a"' in v] == docs


def fleet(spark, n, start=0):
    """Positions of ``n`` vehicles spread over the service area."""
    rows = spark.range(start, start + n).selectExpr(
        "concat('v', id) AS bus_id", "timestamp'2024-01-01 00:00:00' AS timestamp", "timestamp'2024-01-01 00:00:01' AS ingested_at",
        "id AS arrival_seq", "-74.3e0 + (id * 104729 % 40001) / 1e5 AS lon", "4.45e0 + (id * 7919 % 40001) / 1e5 AS lat",
    )
    missing = [f for f in schemas.struct(schemas.POSITION) if f.name not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]).select(*schemas.columns(schemas.POSITION))


def size(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_a_batch_writes_the_buckets_it_touches(spark, tmp_path):
    table = snapshot.Snapshot(str(tmp_path / "latest"), buckets=16)
    table.merge(fleet(spark, 8000), 0)
    changed = fleet(spark, 1, 5).withColumn("arrival_seq", F.lit(90_000).cast("long"))
    table.merge(changed, 1)
    assert len(list(Path(table.folder(1)).glob("bucket=*"))) == 1
    assert size(table.folder(1)) * 8 < size(table.folder(0))
    now = {r["bus_id"]: r["arrival_seq"] for r in table.read(spark).collect()}
    assert now == {f"v{i}": 90_000 if i == 5 else i for i in range(8000)}
    # the state before is still there, and an older ping changes nothing
    assert table.read(spark, 0).filter("bus_id = 'v5'").first()["arrival_seq"] == 5
    table.merge(fleet(spark, 1, 5), 2)
    assert table.read(spark).filter("bus_id = 'v5'").first()["arrival_seq"] == 90_000
    table.forget(spark, 1)
    assert {r["bus_id"]: r["arrival_seq"] for r in table.read(spark).collect()} == now
    assert len(list(Path(table.folder(0)).glob("bucket=*"))) == 15 and not Path(table.folder(1)).exists()


def test_an_unfinished_batch_is_not_seen(spark, tmp_path):
    table = snapshot.Snapshot(str(tmp_path / "latest"), buckets=4)
    table.merge(fleet(spark, 100), 0)
    table.merge(fleet(spark, 100, 100), 1)
    (Path(table.folder(1)) / "_SUCCESS").unlink()
    assert table.read(spark).count() == 100
    table.merge(fleet(spark, 100, 100), 1)
    assert table.read(spark).count() == 200


def test_a_near_lookup_opens_few_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshot, "ROW_GROUP_BYTES", 48 << 10)
    table = snapshot.Snapshot(str(tmp_path / "latest"), buckets=2)
    table.merge(fleet(spark, 60_000), 0)
    lat, lon, side = 4.6, -74.1, 0.01
    hit = total = 0
    for file in Path(table.folder(0)).rglob("*.parquet"):
        meta = parquet.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            total += 1
            hit += all(stats[n].min <= at + side and stats[n].max >= at - side for n, at in (("lat", lat), ("lon", lon)))
    assert total >= 40 and hit <= total / 4


def test_curve_keys_interleave_the_bits(spark):
    points = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (12.34, -56.78), (None, 1.0)]
    rows = spark.createDataFrame(points, "lat double, lon double").select("lat", "lon", geo.curve_key(F.col("lat"), F.col("lon")).alias("key"))

    def cell(value, half):
        return min(int((value + half) / (2 * half) * 2**geo.CURVE_BITS), 2**geo.CURVE_BITS - 1)

    for lat, lon, key in rows.collect():
        if lat is None:
            assert key is None
        else:
            bits = [(cell(lat, 90) >> k & 1) << 1 | cell(lon, 180) >> k & 1 for k in range(geo.CURVE_BITS)]
            assert key == sum(b << 2 * k for k, b in enumerate(bits))


def rows_read(df):
    """Rows that the scans of a plan have handed on."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            found += node.metrics().get("numOutputRows").get().value()
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_a_lookup_of_an_absent_vehicle_reads_no_row_group(spark, tmp_path):
    store = landing.Store(str(tmp_path / "store"))
    rows = [(x["value"], datetime.fromisoformat(x["arrived_at"]), x["seq"]) for x in (line(i, f"b{2 * i:05d}", 1, 1) for i in range(3000))]
    store.write_batch(ingest.decode(spark.createDataFrame(rows, landing.RAW), seq="seq"), 0)
    store.compact(spark, T0)
    assert rows_read(store.history(spark).filter("bus_id = 'b00100'")) > 0
    # between the least and the greatest of the stored ones, so that statistics alone would not tell
    assert rows_read(store.history(spark).filter("bus_id = 'b00101'")) == 0


def raw_frame(spark, lines):
    return ingest.decode(spark.createDataFrame([(x["value"], datetime.fromisoformat(x["arrived_at"]), x["seq"]) for x in lines], landing.RAW), seq="seq")


def test_replayed_files_add_no_row(spark, tmp_path):
    folder, store = tmp_path / "in", landing.Store(str(tmp_path / "store"))
    for number, lines in enumerate(FILES):
        drop(folder, number, lines)
        drop(folder, 10 + number, lines)
    landing.start_ingest(landing.raw_stream(spark, str(folder), 1), store, repeats=timedelta(hours=1)).awaitTermination()
    assert sorted(r["arrival_seq"] for r in store.history(spark).collect()) == [1, 2, 3, 4, 6]
    assert store.rejects(spark).count() == 2
    assert sorted((r["bus_id"], r["arrival_seq"]) for r in store.current(spark).collect()) == [("a", 4), ("b", 2)]
    store.compact(spark, T0)
    store.write_batch(raw_frame(spark, FILES[0]), 9, repeats=timedelta(hours=1))
    assert store.history(spark).count() == 5


def test_pings_behind_the_horizon_stay_and_memory_is_bounded(spark, tmp_path):
    store, hour = landing.Store(str(tmp_path / "store")), timedelta(hours=1)
    for day in range(6):
        store.write_batch(raw_frame(spark, [line(100 * day + i, f"b{i}", 1440 * day + i, 1440 * day + i) for i in range(10)]), day, repeats=hour)
    # the memory holds the last hour, however long the ingest goes on, and opens its dates only
    seen = store.remembered(spark, 6, hour)
    assert seen.count() == 10 and "fecha" in plan(seen).split("PartitionFilters: [")[1].split("]")[0]
    late = [line(900, "b1", 1, 1), line(901, "b2", 1440 * 5 + 2, 1440 * 5 + 2), line(902, "new", 3, 1440 * 5)]
    store.write_batch(raw_frame(spark, late), 6, repeats=hour)
    assert sorted(r["arrival_seq"] for r in store.history(spark).filter("arrival_seq >= 900").collect()) == [900, 902]
    # a clock that is ahead does not move the horizon
    store.write_batch(raw_frame(spark, [line(950, "z", 10**7, 1440 * 5 + 9)]), 7, repeats=hour)
    assert store.remembered(spark, 8, hour).filter("bus_id = 'b9'").count() == 1


def test_facts_follow_the_store_over_a_compaction(spark, tmp_path):
    store, facts = landing.Store(str(tmp_path / "store")), str(tmp_path / "facts")
    assert incremental.load_store(spark, store, facts) is None and incremental.read_loaded(spark, facts).count() == 0
    store.write_batch(raw_frame(spark, FILES[0]), 0)
    assert incremental.load_store(spark, store, facts) == 0
    store.write_batch(raw_frame(spark, FILES[1]), 1)
    store.compact(spark, T0)
    store.write_batch(raw_frame(spark, FILES[2]), 2)
    # a load that did not end is done again
    (tmp_path / "facts" / "upto=1").mkdir()
    assert incremental.load_store(spark, store, facts) == 2
    assert incremental.load_store(spark, store, facts) is None
    loaded = incremental.read_loaded(spark, facts)
    assert sorted((r["bus_id"], r["ts_evento"].minute) for r in loaded.collect()) == [("a", 5), ("a", 10), ("a", 20), ("a", 20), ("b", 0), ("b", 1)]
    assert loaded.dtypes == build_fact(store.history(spark)).dtypes


def test_history_is_pruned_by_date_and_outcome(spark, tmp_path):
    folder, store = tmp_path / "in", landing.Store(str(tmp_path / "store"))
    drop(folder, 0, FILES[0])
    landing.start_ingest(landing.raw_stream(spark, str(folder)), store).awaitTermination()
    text = plan(store.history(spark).filter("fecha = date'2024-01-01'"))
    partition_filters = text.split("PartitionFilters: [")[1]
    assert "outcome" in partition_filters and "fecha" in partition_filters


def test_keyed_state_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    for number, lines in enumerate(FILES):
        drop(folder, number, lines)
    positions = ingest.accepted(ingest.decode(landing.raw_stream(spark, str(folder), 1), seq="seq"))
    query = keyed.start_latest(positions, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    result = spark.read.parquet(f"{tmp_path}/out/batch_id={landing.last_batch(query)}")
    assert sorted((r["bus_id"], r["arrival_seq"]) for r in result.collect()) == [("a", 4), ("b", 2)]


def test_fact_load_is_incremental(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("h", "fact", "cp"))
    position = spark.createDataFrame(
        [("a", None, None, None, None, T0, T0, 1, -74.0, 4.6, 5.0, None, None, False, None)], schemas.POSITION
    )
    for expected in (1, 2):
        position.write.mode("append").parquet(source)
        incremental.start_fact_load(incremental.history_stream(spark, source), target, checkpoint).awaitTermination()
        assert fact_table.read_fact(spark, target).count() == expected
    assert fact_table.read_fact(spark, target).dtypes == build_fact(position).dtypes


def test_landing_text_is_stamped(spark, tmp_path):
    (tmp_path / "x.json").write_text(FILES[0][0]["value"])
    raw = pings.read_landing(spark, str(tmp_path))
    assert raw.filter("arrived_at IS NOT NULL").count() == 1
    assert ingest.accepted(ingest.decode(raw)).first()["bus_id"] == "a"


def test_unknown_document_format(spark):
    with pytest.raises(ValueError):
        pings.read_documents(spark, "x", "xml")


def test_dropping_repeats_decodes_a_batch_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def seen(text):
        calls.add(1)
        return text

    store = landing.Store(str(tmp_path / "store"))
    lines = [line(1, "a", 10, 10), line(1, "a", 10, 10), line(2, "b", 1, 11), line(5, "c", 1, 31, lat=9.0)]
    decoded = raw_frame(spark, lines).withColumn("bus_id", F.udf(seen, "string").asNondeterministic()("bus_id"))
    store.write_batch(decoded, 0, repeats=timedelta(hours=1))
    assert calls.value == 4
    assert sorted(r["bus_id"] for r in store.history(spark).collect()) == ["a", "b"] and store.rejects(spark).count() == 1
