"""Replays of the same alerts in one or many micro-batches."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.operators import correlate, dedup, maintenance, sequence, throttle
from alertweave.operators.maintenance import MaintenanceWindow
from alertweave.plans import fixtures
from alertweave.sources import envelope, tables
from alertweave.streaming import pipeline, windows
from alertweave.streaming.store import Store

FOLDER = "/root/testdata/sf0.001"
WINDOWS = [MaintenanceWindow(*w) for w in fixtures.WINDOWS]
RULES = fixtures.correlation_rules()
PAYLOAD = (
    "alert_id long, ts timestamp, fingerprint string, name string, service string, "
    "provider_type string, provider_id string, status string, severity string, k int, "
    "content_hash string, labels map<string,string>"
)


@pytest.fixture(scope="module")
def messages(spark):
    """Alerts in time order as envelope messages."""
    alerts = tables.alerts(spark, FOLDER)
    names = [f.name for f in T.StructType.fromDDL(PAYLOAD)]
    event = F.to_json(F.struct(*names), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    rows = alerts.select("ts", "alert_id", "tenant_id", event.alias("event"))
    return [
        json.dumps({"tenant_id": r.tenant_id, "event": r.event})
        for r in rows.orderBy("ts", "alert_id").collect()
    ]


def write_files(folder, lines, n, start=0):
    """``n`` files whose modification times follow the order of the lines."""
    os.makedirs(folder, exist_ok=True)
    size = -(-len(lines) // n)
    for i in range(n):
        path = f"{folder}/{start + i:04d}.txt"
        with open(path, "w", encoding="utf-8") as out:
            out.write("\n".join(lines[i * size : (i + 1) * size]))
        at = 1_700_000_000 + (start + i) * 10
        os.utime(path, (at, at))


def run(spark, source, path, config):
    stream = envelope.read_event_stream(
        spark, "text", str(source), "value string", maxFilesPerTrigger="1"
    )
    query = pipeline.run_pipeline(
        stream, config, str(path), decode=lambda df: pipeline.decode_alerts(df, PAYLOAD)
    )
    query.awaitTermination()
    return Store(spark, str(path))


def stored(store):
    rows = store.output("alerts", T.StructType.fromDDL(pipeline.STORED)).drop("labels")
    return sorted(map(tuple, rows.collect()), key=lambda r: r[2])


def linked(store):
    return {(r.alert_id, r.incident_id) for r in pipeline.incident_alerts(store).collect()}


def keys(store):
    state = T.StructType.fromDDL(pipeline.keyed_state.KEY_STATE)
    return {r.fingerprint: r for r in store.snapshot("keys", state).collect()}


CONFIG = pipeline.Config(
    correlation=RULES, windows=WINDOWS, presets={"feed": "", "bad": "no_such_column = 1"}
)


@pytest.fixture(scope="module")
def replays(spark, messages, tmp_path_factory):
    out = {}
    for n in (1, 4):
        folder = tmp_path_factory.mktemp(f"replay{n}")
        write_files(folder / "in", messages, n)
        out[n] = run(spark, folder / "in", folder / "out", CONFIG)
    return out


def test_batches_make_no_difference(replays):
    assert stored(replays[1]) == stored(replays[4])
    assert linked(replays[1]) == linked(replays[4])
    assert keys(replays[1]) == keys(replays[4])


def test_stream_equals_batch(spark, replays):
    alerts = tables.alerts(spark, FOLDER)
    kept, _ = maintenance.apply_maintenance(alerts, WINDOWS)
    fresh = dedup.drop_full_duplicates(dedup.classify_duplicates(kept))
    counted = sequence.with_sequence_features(fresh).withColumn("severity_rank", F.lit(1))
    want = {
        r.alert_id: (r.firing_counter, r.unresolved_counter, r.firing_start, r.started_at)
        for r in counted.collect()
    }
    got = {
        r.alert_id: (r.firing_counter, r.unresolved_counter, r.firing_start, r.started_at)
        for r in replays[4].output("alerts", T.StructType.fromDDL(pipeline.STORED)).collect()
    }
    assert got == want
    keyed = correlate.group_key(correlate.match_rules(counted, RULES), RULES)
    sessions = correlate.sessionize(keyed, RULES)
    assert linked(replays[4]) == {(r.alert_id, r.incident_id) for r in sessions.collect()}


def test_latest_state_and_presets(spark, replays):
    rows = replays[4].output("alerts", T.StructType.fromDDL(pipeline.STORED))
    newest = {r.fingerprint: r.alert_id for r in sequence.latest_alerts(rows).collect()}
    assert {f: r.alert_id for f, r in keys(replays[4]).items()} == newest
    hits = replays[4].output("preset_hits", T.StructType.fromDDL(pipeline.HITS))
    total = hits.groupBy("preset").agg(F.sum("n").alias("n")).collect()
    assert {r.preset: r.n for r in total} == {"feed": rows.count()}


def test_malformed_lines_are_kept_aside(spark, messages, tmp_path):
    bad = ["not valid json", '{"tenant_id": "t0"}', '{"tenant_id": "t0", "event": "{}"}']
    write_files(tmp_path / "in", messages[:50] + bad + messages[50:100], 2)
    store = run(spark, tmp_path / "in", tmp_path / "out", pipeline.Config())
    dead = store.output("dead_letters", T.StructType.fromDDL("raw string, error string"))
    assert sorted(r.error for r in dead.collect()) == [
        "alert_id or ts missing",
        "not valid JSON",
        "tenant_id or event missing",
    ]
    assert all(r is not None for r in stored(store))


def test_late_alert_does_not_replace_newer(spark, messages, tmp_path):
    late = messages[0]
    first = json.loads(json.loads(late)["event"])
    write_files(tmp_path / "in", messages[1:200], 2)
    run(spark, tmp_path / "in", tmp_path / "out", pipeline.Config())
    before = keys(Store(spark, str(tmp_path / "out")))
    write_files(tmp_path / "in", [late], 1, start=2)
    store = run(spark, tmp_path / "in", tmp_path / "out", pipeline.Config())
    after = keys(store)
    key = first["fingerprint"]
    assert before[key].alert_id == after[key].alert_id != first["alert_id"]
    assert after[key].first_ts < before[key].first_ts
    assert first["alert_id"] in {r[2] for r in stored(store)}


def test_restart_goes_on_and_a_repeated_batch_replaces_itself(spark, messages, tmp_path):
    write_files(tmp_path / "in", messages[:300], 2)
    run(spark, tmp_path / "in", tmp_path / "out", CONFIG)
    write_files(tmp_path / "in", messages[300:600], 2, start=2)
    store = run(spark, tmp_path / "in", tmp_path / "out", CONFIG)
    whole = stored(store), linked(store), keys(store)
    # the last batch again, as after a crash before its commit
    lines = spark.createDataFrame([(m,) for m in messages[450:600]], "value string")
    typed, _ = pipeline.decode_alerts(lines, PAYLOAD)
    pipeline.process_batch(typed, store, CONFIG, 3)
    assert (stored(store), linked(store), keys(store)) == whole
    assert len({r[2] for r in whole[0]}) == len(whole[0])


def test_throttle_stream_in_batches(spark, tmp_path):
    events = tables.alerts(spark, FOLDER).select(
        "tenant_id", "ts", F.col("alert_id").alias("id")
    )
    rows = events.orderBy("ts", "id").collect()
    lines = [json.dumps({"tenant_id": r[0], "ts": r[1].isoformat(), "id": r[2]}) for r in rows]
    write_files(tmp_path / "in", lines, 4)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", windows.ROCKSDB)
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 1)
        .json(str(tmp_path / "in"))
    )
    passed = windows.throttle_stream(stream, ["tenant_id"], interval_seconds=3600)
    (
        passed.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    got = {r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = throttle.throttle(
        events, ["tenant_id"], interval_seconds=3600, chunk_seconds=86400
    )
    assert got == {r.id for r in want.collect()}


def test_tumbling_windows_with_late_rows(spark):
    alerts = tables.alerts(spark, FOLDER)
    out = windows.tumbling_counts(alerts, ["tenant_id"])
    assert out.agg(F.sum("n")).first()[0] == alerts.count()
