"""What a micro-batch costs: one decoding of each message, one shuffle for duplicates and counters."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_delivery import FULL, message, stored, write

from alertweave.operators import scan
from alertweave.sources import envelope
from alertweave.streaming import pipeline
from alertweave.streaming.store import Store


def run(spark, source, path, decode, **options):
    stream = envelope.read_event_stream(spark, "text", str(source))
    pipeline.run_pipeline(
        stream, pipeline.Config(), str(path), decode=decode, **options
    ).awaitTermination()
    return Store(spark, str(path))


def dead(store):
    schema = T.StructType.fromDDL("raw string, error string")
    return sorted(tuple(r) for r in store.output("dead_letters", schema).collect())


LINES = [
    *[message(i) for i in range(40)],
    "no json",
    json.dumps({"tenant_id": "t"}),
    json.dumps({"tenant_id": "t", "event": "{}"}),
    json.dumps({"tenant_id": "t", "event": '{"alert_id": "x"}'}),
    json.dumps({"tenant_id": "t", "event": "{}", "event_type": "incident"}),
    json.dumps({"tenant_id": "t", "event": "{}", "provider_type": "incident"}),
    json.dumps({"tenant_id": "t", "event": "{}", "event_type": "other"}),
]


def test_every_message_is_decoded_once(spark, tmp_path):
    write(tmp_path / "in", "0.txt", LINES)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        calls.add(1)
        return value

    def decode(df):
        return pipeline.parse_alerts(df.withColumn("value", counted("value")), FULL)

    store = run(spark, tmp_path / "in", tmp_path / "out", decode)
    assert calls.value == len(LINES)
    assert [row[0] for row in stored(store)] == list(range(40))
    assert dead(store) == sorted(
        [
            ("no json", "not valid JSON"),
            (LINES[41], "tenant_id or event missing"),
            ("{}", "alert_id or ts missing"),
            ('{"alert_id": "x"}', "alert_id or ts missing"),
        ]
    )


def test_two_frames_give_what_one_gives(spark, tmp_path):
    write(tmp_path / "in", "0.txt", LINES)
    one = run(
        spark, tmp_path / "in", tmp_path / "a", lambda df: pipeline.parse_alerts(df, FULL)
    )
    two = run(
        spark, tmp_path / "in", tmp_path / "b", lambda df: pipeline.decode_alerts(df, FULL)
    )
    assert stored(one) == stored(two)
    assert dead(one) == dead(two)


def alerts(spark, first, last):
    """Every third alert repeats the one before it in its key."""
    n = F.col("id")
    names = ("name", "service", "provider_type", "provider_id", "severity")
    return spark.range(first, last).select(
        n.alias("alert_id"),
        F.timestamp_seconds(n).alias("ts"),
        F.lit("t").alias("tenant_id"),
        F.concat(F.lit("f"), n % 4).alias("fingerprint"),
        F.when(n % 5 == 0, "resolved").when(n % 7 == 0, "acknowledged").otherwise("firing")
        .alias("status"),
        F.when(F.floor(n / 4) % 3 == 2, n - 4).otherwise(n).cast("string").alias("content_hash"),
        (n % 9).cast("int").alias("k"),
        F.create_map(F.lit("n"), n.cast("string")).alias("labels"),
        *[F.lit("x").alias(c) for c in names],
    )


def process(spark, path, **config):
    store = Store(spark, str(path))
    for batch, first in enumerate((0, 150)):
        part = alerts(spark, first, first + 150)
        pipeline.process_batch(part, store, pipeline.Config(**config), batch)
    schema = T.StructType.fromDDL(pipeline.STORED)
    rows = store.output("alerts", schema).drop("labels")
    audit = store.output("audit", T.StructType.fromDDL(pipeline.AUDIT))
    return [sorted(map(str, frame.collect())) for frame in (rows, audit)]


def test_without_hot_keys_one_scan_gives_what_two_give(spark, tmp_path, monkeypatch):
    two = process(spark, tmp_path / "hot", max_rows=5)
    assert (len(two[0]), len(two[1])) == (200, 300)
    monkeypatch.setattr(scan, "_slot_cuts", None)
    assert process(spark, tmp_path / "one") == two
