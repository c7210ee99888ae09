"""Failing micro-batches: retries, the search for failing messages, what is stored without them."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.sources import envelope
from alertweave.streaming import delivery, pipeline
from alertweave.streaming.store import Store

PAYLOAD = "alert_id long, ts timestamp, fingerprint string, name string, status string"
FULL = (
    f"{PAYLOAD}, service string, provider_type string, provider_id string, severity string, "
    "k int, content_hash string, labels map<string,string>"
)
POLICY = delivery.Delivery(attempts=2, backoff_seconds=0.0)


def message(i, name=None, tenant="t"):
    event = {
        "alert_id": i,
        "ts": f"2024-01-01T00:{i // 60 % 60:02d}:{i % 60:02d}.000Z",
        "fingerprint": f"f{i % 7}",
        "name": name or f"n{i}",
        "status": "resolved" if i % 5 == 0 else "firing",
        "severity": "high",
        "content_hash": str(i),
    }
    return json.dumps({"tenant_id": tenant, "event": json.dumps(event)})


def strict_decode(df):
    """Decoding by a function that raises on some messages."""

    @F.pandas_udf("string")
    def refuse(values):
        if values.str.contains("POISON").any():
            raise ValueError("cannot be formatted")
        return values

    return pipeline.decode_alerts(df.withColumn("value", refuse("value")), FULL)


def run(spark, folder, path, policy=None, **config):
    stream = envelope.read_event_stream(
        spark, "text", str(folder), "value string", maxFilesPerTrigger="1"
    )
    query = pipeline.run_pipeline(
        stream, pipeline.Config(**config), str(path), decode=strict_decode, delivery=policy
    )
    query.awaitTermination()
    return Store(spark, str(path))


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines), encoding="utf-8")


def stored(store):
    rows = store.output("alerts", T.StructType.fromDDL(pipeline.STORED))
    names = ["alert_id", "status", "firing_counter", "unresolved_counter", "started_at"]
    return sorted(tuple(r) for r in rows.select(*names).collect())


def undelivered(store):
    schema = T.StructType.fromDDL(delivery.UNDELIVERED_SCHEMA)
    return store.output(delivery.UNDELIVERED, schema).collect()


def test_only_the_failing_messages_are_set_aside(spark, tmp_path):
    good = [message(i) for i in range(1_000)]
    bad = [message(2_000, "POISON"), message(2_001, "POISON é"), message(2_000, "POISON")]
    write(tmp_path / "clean", "0.txt", good)
    write(tmp_path / "mixed", "0.txt", [bad[0], *good[:400], bad[1], *good[400:], bad[2]])
    expected = stored(run(spark, tmp_path / "clean", tmp_path / "a", POLICY))
    store = run(spark, tmp_path / "mixed", tmp_path / "b", POLICY)
    assert len(expected) == 1_000
    assert stored(store) == expected
    rows = undelivered(store)
    # a message that came twice is set aside twice
    assert sorted(json.loads(r.raw)["value"] for r in rows) == sorted(bad)
    assert all("cannot be formatted" in r.error for r in rows)


def test_batches_without_failures_set_nothing_aside(spark, tmp_path):
    write(tmp_path / "in", "0.txt", [message(i) for i in range(20)])
    store = run(spark, tmp_path / "in", tmp_path / "out", POLICY)
    assert len(stored(store)) == 20
    assert undelivered(store) == []


def test_without_a_policy_the_stream_stops(spark, tmp_path):
    write(tmp_path / "in", "0.txt", [message(1), message(2, "POISON")])
    with pytest.raises(Exception, match="cannot be formatted"):
        run(spark, tmp_path / "in", tmp_path / "out")


def raises_on(test):
    def check(part):
        if part.filter(test).count():
            raise ValueError("refused")

    return check


@pytest.fixture
def rows(spark, tmp_path):
    batch = spark.range(500).withColumn("a.b", F.col("id") % 3)
    return delivery.spread(batch, Store(spark, str(tmp_path / "rows")), 0)


def test_search_finds_every_failing_message(rows):
    found = delivery.failing(rows, raises_on("id in (0, 17, 18, 499)"), 10)
    kept = delivery.without(rows, found)
    assert len(found) == 4
    assert {r.id for r in kept.collect()} == set(range(500)) - {0, 17, 18, 499}
    assert delivery.failing(kept, raises_on("id = 17"), 10) == {}


def test_messages_that_fail_only_together_are_no_failing_messages(rows):
    def check(part):
        if part.filter("id in (3, 400)").count() == 2:
            raise ValueError("two at once")

    with pytest.raises(delivery.DeliveryFailed, match="not alone"):
        delivery.failing(rows, check, 10)


def test_too_many_failures_are_an_outage(rows):
    with pytest.raises(delivery.DeliveryFailed, match="over 3"):
        delivery.failing(rows, raises_on("true"), 3)


def test_a_check_that_fails_on_no_rows_is_an_outage(rows):
    def check(part):
        raise ValueError("unreachable")

    with pytest.raises(delivery.DeliveryFailed, match="without messages"):
        delivery.failing(rows.filter("false"), check, 3)


def test_retries_pause_longer_each_time():
    pauses, calls = [], []

    def work():
        calls.append(1)
        if len(calls) < 4:
            raise ValueError("not yet")

    delivery.retried(work, delivery.Delivery(4, 0.5, sleep=pauses.append))
    assert (len(calls), pauses) == (4, [0.5, 1.0, 2.0])


def test_what_the_analyser_refuses_is_not_retried():
    calls = []

    def work():
        calls.append(1)
        raise AnalysisException("no such column")

    with pytest.raises(AnalysisException):
        delivery.retried(work, POLICY)
    assert len(calls) == 1


def test_an_outage_that_ends_during_the_search_loses_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    calls = []

    def work(part, into):
        calls.append(1)
        if len(calls) <= 2:
            raise ValueError("away")
        into.append("out", part, 0)

    delivery.deliver(spark.range(50), 0, store, work, POLICY)
    schema = T.StructType.fromDDL("id long")
    assert sorted(r.id for r in store.output("out", schema).collect()) == list(range(50))
    assert undelivered(store) == []


def test_what_a_check_found_is_left_out_without_a_trial(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    calls = []

    def work(part, into):
        calls.append(type(into))
        raises_on("id = 17")(part)
        into.append("out", part, 0)

    delivery.deliver(spark.range(50), 0, store, work, POLICY, (raises_on("id = 17"),))
    schema = T.StructType.fromDDL("id long")
    assert {r.id for r in store.output("out", schema).collect()} == set(range(50)) - {17}
    assert len(undelivered(store)) == 1
    # twice on the batch, once on what is left
    assert calls == [Store] * 3


def test_what_the_checks_do_not_find_is_searched_by_the_work(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))

    def work(part, into):
        raises_on("id in (17, 30)")(part)
        into.append("out", part, 0)

    delivery.deliver(spark.range(50), 0, store, work, POLICY, (raises_on("id = 17"),))
    schema = T.StructType.fromDDL("id long")
    assert {r.id for r in store.output("out", schema).collect()} == set(range(50)) - {17, 30}
    assert len(undelivered(store)) == 2
