import datetime
import gzip
import json
import os

from pyspark.sql import functions as F

from barorail.plans.messages import trip_timetables
from barorail import schemas as S
from barorail.plans import accesslog, messages
from barorail.checks import streams
from barorail.sources import readers, snapshots
from barorail.streaming import ingest, state, telemetry


def _message(trip, at, country="FR", stop="A"):
    out = {"trip_id": trip, "route_id": None, "stops": [{"stop_id": stop, "arrival_time": at}], "feed_timestamp": at, "captured_at": at}
    return out if country is None else {**out, "pays": country}


def _drop(folder, name, rows, mtime):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    os.utime(path, (mtime, mtime))


def _run(spark, folder, out, checkpoint, **options):
    stream = readers.read_messages(spark, str(folder), stream=True)
    state.upsert_stream(stream, str(out), str(checkpoint), once=True, **options).awaitTermination()


def _trips(spark, out, **options):
    return {r.trip_id: (r.pays, r.feed_timestamp) for r in state.current_state(spark, str(out), **options).collect()}


def test_last_arrival_wins_whatever_its_event_time(spark, tmp_path):
    feed, out, checkpoint = tmp_path / "in", tmp_path / "state", tmp_path / "cp"
    _drop(feed, "b.json", [_message("t1", 50), _message("t2", 10), _message("t2", 9), _message("old", 1, None)], 1000)
    _drop(feed, "a.json", [_message("t1", 40)], 2000)  # newer file, older event
    _run(spark, feed, out, checkpoint)
    assert _trips(spark, out) == {"t1": ("FR", 40), "t2": ("FR", 9), "old": ("FR", 1)}
    _drop(feed, "c.json", [_message("t2", 3, "IT")], 3000)
    _run(spark, feed, out, checkpoint)
    assert _trips(spark, out) == {"t1": ("FR", 40), "t2": ("IT", 3), "old": ("FR", 1)}
    _run(spark, feed, out, checkpoint)  # nothing new
    assert len(_trips(spark, out)) == 3


def test_writing_a_batch_again_changes_nothing(spark, tmp_path):
    feed, out = tmp_path / "in", tmp_path / "state"
    _drop(feed, "a.json", [_message("t1", 1), _message("t2", 2)], 1000)
    batch = readers.read_messages(spark, str(feed))
    write = state._write_batch(str(out), ["trip_id"], F.current_timestamp)
    for _ in range(2):
        write(batch, 4)
    assert _trips(spark, out) == {"t1": ("FR", 1), "t2": ("FR", 2)}


def test_compaction_keeps_the_state(spark, tmp_path):
    out = tmp_path / "state"
    write = state._write_batch(str(out), ["trip_id"], F.current_timestamp)
    for batch_id, rows in enumerate([[_message("t1", 1), _message("t2", 1)], [_message("t1", 2)], [_message("t3", 3)]]):
        folder = tmp_path / f"in{batch_id}"
        _drop(folder, "a.json", rows, 1000)
        write(readers.read_messages(spark, str(folder)), batch_id)
    before = _trips(spark, out)
    state.compact(spark, str(out), 0)
    state.compact(spark, str(out), 1)
    state.compact(spark, str(out), 1)
    assert _trips(spark, out) == before == {"t1": ("FR", 2), "t2": ("FR", 1), "t3": ("FR", 3)}
    plan = state._versions(spark, str(out), 1)
    assert {r.batch_id for r in plan.select("batch_id").distinct().collect()} == {0, 1, 2}
    # What the snapshot before the newest has folded is gone; the rest stays for its readers.
    assert sorted(p.name for p in (out / "changes").iterdir() if "=" in p.name) == ["batch_id=1", "batch_id=2"]


def test_state_is_empty_before_the_first_message(spark, tmp_path):
    before = state.current_state(spark, str(tmp_path / "nothing"))
    assert before.isEmpty()
    assert before.columns == ["trip_id", "route_id", "pays", "stops", "feed_timestamp", "captured_at", "updated_at"]


def test_old_keys_can_be_left_out(spark, tmp_path):
    out = tmp_path / "state"
    for batch_id, rows in enumerate([[_message("t1", 1), _message("t2", 1)], [_message("t1", 2)]]):
        folder = tmp_path / f"in{batch_id}"
        _drop(folder, "a.json", rows, 1000)
        write = state._write_batch(str(out), ["trip_id"], lambda b=batch_id: F.timestamp_seconds(F.lit(100 * b)))
        write(readers.read_messages(spark, str(folder)), batch_id)
    assert _trips(spark, out, updated_after=F.timestamp_seconds(F.lit(50))) == {"t1": ("FR", 2)}
    assert len(_trips(spark, out)) == 2


def test_countries_may_be_part_of_the_key(spark, tmp_path):
    feed, out = tmp_path / "in", tmp_path / "state"
    _drop(feed, "a.json", [_message("1", 1, "FI"), _message("1", 2, "DE")], 1000)
    write = state._write_batch(str(out), ["trip_id", "pays"], F.current_timestamp)
    write(readers.read_messages(spark, str(feed)), 0)
    keys = ["trip_id", "pays"]
    assert state.current_state(spark, str(out), keys).count() == 2


def _feed(trip, at, seq):
    return {"header": {"timestamp": at}, "entity": [{"id": "1", "trip_update": {
        "trip": {"trip_id": trip, "start_date": "20240110"},
        "stop_time_update": [{"stop_sequence": seq, "arrival": {"time": at}}]}}]}


def test_stream_of_snapshots_equals_the_batch(spark, tmp_path):
    folders = {c: tmp_path / c for c in ("PL", "FR", "DE")}
    for i in range(3):
        _drop(folders["PL"], f"{i}.json", [_feed("p", 1704900000 + i, 1)], 1000 + i)
        _drop(folders["FR"], f"{i}.json", [_feed("f", 1704900000 + i, 1)], 1000 + i)
        _drop(folders["DE"], f"{i}.json", [_feed("rail" if i else "bus", 1704900000 + i, 1)], 1000 + i)
    stop_map = trip_timetables(spark.createDataFrame([("p", 1, "S", 3600, None)], S.STOP_SEQUENCE_MAP))
    rail = spark.createDataFrame([("rail",)], "trip_id string")

    def shape(feeds):
        return ingest.country_messages(feeds, {}, {"DE": rail}, {"PL": stop_map}, F.lit(1).cast("bigint"))

    feeds = ingest.country_feeds(spark, {c: str(p) for c, p in folders.items()})
    out = str(tmp_path / "out")
    ingest.publish_stream(feeds, shape, out, str(tmp_path / "cp"), once=True).awaitTermination()
    got = readers.read_messages(spark, f"{out}/batch=*").drop("arrivee")
    batch = None
    for country, folder in folders.items():
        part = readers.read_feeds(spark, str(folder)).withColumn("pays", F.lit(country))
        batch = part if batch is None else batch.unionByName(part)
    want = shape(batch)
    order = ["pays", "trip_id", "feed_timestamp"]
    assert got.orderBy(*order).collect() == want.orderBy(*order).collect()
    assert got.count() == 8
    assert {s.stop_id for r in got.filter("pays = 'PL'").collect() for s in r.stops} == {"S"}


def test_windows_close_behind_the_watermark(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1, 10, 0, 0)
    folder = tmp_path / "log"
    rows = [(i * 10, "a" if i % 2 else "b") for i in range(120)]
    for part in range(3):
        lines = [
            {"ts": (start + datetime.timedelta(seconds=s)).isoformat() + "Z", "ip": ip, "method": "GET", "path": "/p", "status": 200, "duration_s": 0.2}
            for s, ip in rows[part * 40 : part * 40 + 40]
        ]
        _drop(folder, f"{part}.json", lines, 1000 + part)
    schema = "ts timestamp, ip string, method string, path string, status int, duration_s double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    batch = spark.read.schema(schema).json(str(folder))
    closed = start + datetime.timedelta(seconds=rows[-1][0] - 120)
    for name, live, whole in (
        ("rate", telemetry.request_rate(stream), accesslog.request_rate(batch)),
        ("p95", telemetry.latency_p95(stream), accesslog.latency_quantiles(batch)),
    ):
        out = str(tmp_path / name)
        telemetry.write_windows(live, out, str(tmp_path / f"cp-{name}"), once=True).awaitTermination()
        got = spark.read.schema(live.schema).parquet(out)
        minutes = {"rate": 1, "p95": 5}[name]
        due = whole.filter(F.col("debut") + F.expr(f"INTERVAL {minutes} MINUTES") <= F.lit(closed))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, due.collect())) != []


def test_stop_time_defaults(spark, tmp_path):
    folder = tmp_path / "f"
    _drop(folder, "a.json", [_feed("p", 5, None)], 1000)
    (row,) = messages.trip_messages(readers.read_feeds(spark, str(folder)), "FR").collect()
    assert row.stops[0].stop_id == ""


def test_replays_and_late_messages_change_nothing(spark, tmp_path):
    feed, out, checkpoint = tmp_path / "in", tmp_path / "state", tmp_path / "cp"
    day = 86_400

    def run():
        stream = readers.read_messages(spark, str(feed), stream=True)
        state.upsert_stream(state.once_each(stream, "1 day"), str(out), str(checkpoint), once=True).awaitTermination()
        return _trips(spark, out)

    _drop(feed, "a.json", [_message("t1", 10 * day), _message("t2", 10 * day), _message("old", 9 * day, None)], 1000)
    before = run()
    assert before == {"t1": ("FR", 10 * day), "t2": ("FR", 10 * day), "old": ("FR", 9 * day)}
    _drop(feed, "b.json", [_message("t2", 10 * day + 5)], 2000)
    after = run()
    assert after == before | {"t2": ("FR", 10 * day + 5)}
    # The first message of t2 again, which would win as the last to arrive; and one from before the watermark.
    _drop(feed, "c.json", [_message("t2", 10 * day), _message("t1", 10 * day), _message("t1", 8 * day)], 3000)
    assert run() == after
    _drop(feed, "d.json", [_message("t2", 10 * day + 1)], 4000)  # out of order, but new and in time
    assert run() == after | {"t2": ("FR", 10 * day + 1)}


def test_expired_keys_leave_the_state(spark, tmp_path):
    out = tmp_path / "state"
    for batch_id, rows in enumerate([[_message("t1", 1), _message("t2", 1)], [_message("t1", 2)], [_message("t2", 9)]]):
        folder = tmp_path / f"in{batch_id}"
        _drop(folder, "a.json", rows, 1000)
        write = state._write_batch(str(out), ["trip_id"], lambda b=batch_id: F.timestamp_seconds(F.lit(100 * b)))
        write(readers.read_messages(spark, str(folder)), batch_id)
        if batch_id == 1:
            state.compact(spark, str(out), 1, expired_before=F.timestamp_seconds(F.lit(50)))
            assert _trips(spark, out) == {"t1": ("FR", 2)}
    assert _trips(spark, out) == {"t1": ("FR", 2), "t2": ("FR", 9)}


def test_snapshots_resume_between_countries(spark, tmp_path):
    folders = {c: str(tmp_path / c) for c in ("PL", "FR")}

    def land(country, name, *feeds, complete=True):
        folder = tmp_path / country / name
        folder.mkdir(parents=True)
        for i, feed in enumerate(feeds):
            (folder / f"part-{i}.json").write_text(json.dumps(feed) + "\n\nno feed\n")
        if complete:
            (folder / "_SUCCESS").touch()

    seen = []

    def poll(countries=("PL", "FR")):
        got = []
        stream = snapshots.snapshot_feeds(spark, {c: folders[c] for c in countries})
        collect = lambda batch, _: got.extend((r.pays, r.snapshot, r.header.timestamp) for r in batch.where("header IS NOT NULL").collect())
        stream.writeStream.foreachBatch(collect).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        seen.extend(got)
        return sorted(got)

    land("PL", "001", _feed("p", 1, 1), _feed("p", 2, 1))
    assert poll(("PL",)) == [("PL", "001", 1), ("PL", "001", 2)]
    land("FR", "001", _feed("f", 3, 1))
    land("PL", "002", _feed("p", 4, 1), complete=False)
    assert poll() == [("FR", "001", 3)]  # a country that came later starts from its first snapshot
    assert poll() == []
    (tmp_path / "PL" / "002" / "_SUCCESS").touch()
    land("PL", "003", _feed("p", 5, 1))
    assert poll() == [("PL", "002", 4), ("PL", "003", 5)]
    assert len(seen) == len(set(seen)) == 5


def test_published_lines_are_compressed(spark, tmp_path):
    _drop(tmp_path / "in", "0.json", [_feed("p", 1704900000, 1)], 1000)
    feeds = ingest.country_feeds(spark, {"PL": str(tmp_path / "in")})
    shape = lambda batch: ingest.country_messages(batch, {}, {}, {}, F.lit(1).cast("bigint"))
    ingest.publish_stream(feeds, shape, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    parts = list((tmp_path / "out").glob("batch=*/part-*"))
    assert parts and all(p.name.endswith(".gz") for p in parts)
    assert [r.trip_id for r in readers.read_messages(spark, str(tmp_path / "out" / "batch=*")).collect()] == ["p"]


def test_snapshots_are_read_line_by_line_compressed_or_not(tmp_path):
    lines = [json.dumps(_feed(f"p\u2028{i}", i, 1), ensure_ascii=False) for i in range(2_500)]
    text = "\r\n".join(lines[:1]) + "\n\n" + "\n".join(lines[1:])
    (tmp_path / "a.json").write_text(text, newline="")
    with gzip.open(tmp_path / "b.json.gz", "wt", newline="") as file:
        file.write(text)
    reader = snapshots.SnapshotReader({"folders": json.dumps({"PL": str(tmp_path)})})
    for name in ("a.json", "b.json.gz"):
        batches = list(reader.read(snapshots.SnapshotFile("PL", "001", str(tmp_path / name))))
        assert [b.num_rows for b in batches] == [1000, 1000, 500]
        assert [x for b in batches for x in b.column("value").to_pylist()] == lines


def test_snapshots_of_the_query_land_compressed(spark, tmp_path, monkeypatch):
    folder = lambda _, label: f"{tmp_path}/{label}"
    monkeypatch.setattr(streams, "scratch_dir", folder)
    assert streams._polled(streams.Views(spark, "/root/testdata/sf0.001")).count() > 0
    parts = list(tmp_path.glob("snapshots/*/*/part-*"))
    assert parts and all(p.name.endswith(".json.gz") for p in parts)
