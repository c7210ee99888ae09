"""Streams over the given tables, run to the end of the data and checked like batch jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.operators import correlate, lineage, throttle
from alertweave.operators.maintenance import MaintenanceWindow
from alertweave.plans import fixtures
from alertweave.plans.correlating import KEYED, RULES, SESSIONS
from alertweave.plans.mappings import MARKED
from alertweave.plans.registry import query
from alertweave.plans.sequences import KEY_WINDOW
from alertweave.plans.sql import ALERTS
from alertweave.session import checkpoint_folder
from alertweave.sources import envelope, tables
from alertweave.streaming import delivery, pipeline, store, windows
from alertweave.streaming import state as keyed_state
from alertweave.streaming.store import Store


def new_folder(spark) -> str:
    return f"{checkpoint_folder(spark)}/alertweave/{uuid.uuid4().hex}"


def alert_stream(spark, folder):
    """The alerts of ``tables.alerts`` as a stream of the table's files."""
    schema = tables.read_table(spark, folder, "events").schema
    # a pattern, because a stream's plain path must be a folder
    events = spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")
    return tables.adapt_alerts(events)


def run_to_end(frame, path, mode):
    """Run a stream over all data; the newest state of a result is its last version."""
    spark = frame.sparkSession

    def each(batch, batch_id):
        Store(batch.sparkSession, path).append("out", batch, batch_id)

    query_ = (
        frame.writeStream.outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", f"{path}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return Store(spark, path).output("out", frame.schema)


@query(
    "st4_tumbling_windows",
    f"""WITH {ALERTS} SELECT date_trunc('hour', ts) AS hour, provider_type, count(*) AS n
FROM alerts GROUP BY ALL""",
)
def tumbling_windows(spark, folder):
    counts = windows.tumbling_counts(alert_stream(spark, folder), ["provider_type"])
    rows = run_to_end(counts, new_folder(spark), "update")
    # an updated window is written again; its newest count is the largest
    return rows.groupBy("hour", "provider_type").agg(F.max("n").alias("n"))


@query(
    "st3_session_windows",
    f"""WITH {KEYED},
gaps AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w)
    > CAST(timeframe_s AS BIGINT) * 1000000 THEN 1 ELSE 0 END AS brk FROM keyed
  WINDOW w AS (PARTITION BY tenant_id, rule_id, group_key ORDER BY ts, alert_id)),
numbered AS (SELECT *, sum(brk) OVER (PARTITION BY tenant_id, rule_id, group_key
    ORDER BY ts, alert_id) AS s FROM gaps)
SELECT tenant_id, rule_id, group_key, min(ts) AS first_ts,
  min(CASE WHEN status = 'firing' THEN ts END) AS opened_at, max(ts) AS last_ts, count(*) AS n
FROM numbered GROUP BY tenant_id, rule_id, group_key, s""",
)
def session_windows(spark, folder):
    keyed = correlate.group_key(
        correlate.match_rules(alert_stream(spark, folder), RULES), RULES
    )
    found = windows.session_windows(
        keyed.select(*correlate.INCIDENT_KEY, "ts", "status"), RULES
    )
    rows = run_to_end(found, new_folder(spark), "append")
    return rows.unionByName(_open_sessions(spark, folder, rows))


def _open_sessions(spark, folder, closed):
    """Sessions the watermark has not closed at the end of the data, from a batch run."""
    keyed = correlate.group_key(
        correlate.match_rules(tables.alerts(spark, folder), RULES), RULES
    )
    found = windows.session_windows(
        keyed.select(*correlate.INCIDENT_KEY, "ts", "status"), RULES
    )
    return found.join(closed, [*correlate.INCIDENT_KEY, "first_ts"], "left_anti")


@query(
    "st1_pipeline_stored_alerts",
    f"""WITH {MARKED},
kept AS (SELECT * REPLACE (CASE WHEN window_id IN (1, 4) THEN 'suppressed' ELSE status END
    AS status) FROM marked WHERE window_id IS NULL OR window_id IN (1, 4)),
before AS (SELECT *, lag(content_hash) {KEY_WINDOW} AS before_hash FROM kept),
fresh AS (SELECT * FROM before WHERE before_hash IS NULL OR before_hash <> content_hash),
runs AS (SELECT *, count(*) FILTER (status = 'acknowledged') {KEY_WINDOW} AS ga,
    count(*) FILTER (status = 'resolved') {KEY_WINDOW} AS gr,
    count(*) FILTER (status <> 'firing') {KEY_WINDOW} AS gf FROM fresh)
SELECT alert_id, status,
  row_number() OVER (PARTITION BY tenant_id, fingerprint, ga ORDER BY ts, alert_id)
    - CASE WHEN ga > 0 THEN 1 ELSE 0 END AS firing_counter,
  row_number() OVER (PARTITION BY tenant_id, fingerprint, gr ORDER BY ts, alert_id)
    - CASE WHEN gr > 0 THEN 1 ELSE 0 END AS unresolved_counter,
  CASE WHEN status = 'firing' THEN min(ts) FILTER (status = 'firing')
    OVER (PARTITION BY tenant_id, fingerprint, gf) END AS firing_start FROM runs""",
)
def pipeline_stored_alerts(spark, folder):
    config = pipeline.Config(
        correlation=RULES,
        windows=[MaintenanceWindow(*w) for w in fixtures.WINDOWS],
        presets={"feed": ""},
    )
    path = new_folder(spark)
    pipeline.run_pipeline(alert_stream(spark, folder), config, path).awaitTermination()
    stored = Store(spark, path).output("alerts", T.StructType.fromDDL(pipeline.STORED))
    return stored.select(
        "alert_id", "status", "firing_counter", "unresolved_counter", "firing_start"
    )


# the sessions of the alerts that are no full duplicates
FRESH_SESSIONS = SESSIONS.replace(
    "FROM ranked)",
    """FROM (SELECT * EXCLUDE (b) FROM (SELECT *, lag(content_hash) OVER (PARTITION BY
    tenant_id, fingerprint ORDER BY ts, alert_id) AS b FROM ranked)
    WHERE b IS NULL OR b <> content_hash))""",
    1,
)


@query(
    "st1_pipeline_incident_alerts",
    f"""WITH {FRESH_SESSIONS}
SELECT alert_id, incident_id FROM sessions""",
)
def pipeline_incident_alerts(spark, folder):
    path = new_folder(spark)
    config = pipeline.Config(correlation=RULES)
    pipeline.run_pipeline(alert_stream(spark, folder), config, path).awaitTermination()
    return pipeline.incident_alerts(Store(spark, path)).select("alert_id", "incident_id")


# the first event of a key passes, then each time the first one 15 minutes later or more;
# an instant counts once, with its least id
THROTTLED = f"""WITH RECURSIVE {ALERTS},
instants AS (SELECT tenant_id, provider_type, ts, min(alert_id) AS id FROM alerts
  GROUP BY ALL),
steps AS (SELECT *, min(ts) OVER (PARTITION BY tenant_id, provider_type ORDER BY ts
    RANGE BETWEEN INTERVAL 15 MINUTE FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ts FROM instants),
passed AS (
  SELECT tenant_id, provider_type, min(ts) AS ts FROM instants GROUP BY ALL
  UNION ALL
  SELECT s.tenant_id, s.provider_type, s.next_ts FROM passed p
  JOIN steps s USING (tenant_id, provider_type, ts) WHERE s.next_ts IS NOT NULL)
SELECT tenant_id, provider_type, ts, id FROM passed JOIN instants
  USING (tenant_id, provider_type, ts)"""


@query("w13_throttle", THROTTLED)
def throttle_batch(spark, folder):
    """At most one notification per tenant and provider in 15 minutes."""
    events = tables.alerts(spark, folder).select(
        "tenant_id", "provider_type", "ts", F.col("alert_id").alias("id")
    )
    return throttle.throttle(
        events, ["tenant_id", "provider_type"], interval_seconds=900, chunk_seconds=7200
    )


@query("st8_throttle_stream", THROTTLED)
def throttle_stream(spark, folder):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", windows.ROCKSDB)
    events = alert_stream(spark, folder).select(
        "tenant_id", "provider_type", "ts", F.col("alert_id").alias("id")
    )
    passed = windows.throttle_stream(
        events, ["tenant_id", "provider_type"], interval_seconds=900
    )
    return run_to_end(passed, new_folder(spark), "append")


# one window is over at the time of the check, one is not
LATE_WINDOWS = [
    MaintenanceWindow(
        7, "t1", "late", "2024-01-20 00:00:00", "2024-02-05 00:00:00", "k > 50", True
    ),
    MaintenanceWindow(
        8, "t2", "longer", "2024-01-20 00:00:00", "2024-06-01 00:00:00", "", True
    ),
]


@query(
    "st7_recover_expired",
    f"""WITH {ALERTS},
kept AS (SELECT *, ts >= TIMESTAMP '2024-01-20' AND (tenant_id = 't2' OR (tenant_id = 't1'
    AND k > 50)) AS held FROM alerts),
before AS (SELECT *, lag(content_hash) {KEY_WINDOW} AS before_hash FROM kept),
newest AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, fingerprint
    ORDER BY ts DESC, alert_id DESC) AS rn FROM before
  WHERE before_hash IS NULL OR before_hash <> content_hash)
SELECT alert_id, CASE WHEN tenant_id = 't1' THEN status ELSE 'maintenance' END AS status,
  CASE WHEN tenant_id = 't1' THEN 'maintenance' ELSE status END AS previous_status,
  tenant_id = 't1' AS recovered FROM newest WHERE rn = 1 AND held""",
)
def recover_expired(spark, folder):
    config = pipeline.Config(
        windows=LATE_WINDOWS, maintenance_strategy="recover_previous_status"
    )
    path = new_folder(spark)
    pipeline.run_pipeline(alert_stream(spark, folder), config, path).awaitTermination()
    out = pipeline.recover_expired(Store(spark, path), LATE_WINDOWS, "2024-03-01 00:00:00")
    return out.select("alert_id", "status", "previous_status", "recovered")


def write_messages(spark, folder):
    """The alerts as envelope messages, one per line, in files below a new folder."""
    names = [f.name for f in T.StructType.fromDDL(MESSAGE)]
    form = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    event = F.to_json(F.struct(*names), form)
    broken = F.when(F.col("alert_id") % 97 == 0, "not valid json")
    message = F.to_json(F.struct("tenant_id", event.alias("event")))
    path = f"{new_folder(spark)}/messages"
    lines = tables.alerts(spark, folder).select(F.coalesce(broken, message).alias("value"))
    lines.write.text(path)
    return path


MESSAGE = (
    "alert_id long, ts timestamp, fingerprint string, name string, service string, "
    "provider_type string, provider_id string, status string, severity string, k int, "
    "content_hash string, labels map<string,string>"
)


@query(
    "s1_message_stream",
    f"""WITH {ALERTS},
before AS (SELECT *, lag(content_hash) {KEY_WINDOW} AS b FROM alerts WHERE alert_id % 97 <> 0)
SELECT alert_id, status, ts, 'stored' AS kind FROM before WHERE b IS NULL OR b <> content_hash
UNION ALL SELECT NULL, NULL, NULL, 'dead' FROM alerts WHERE alert_id % 97 = 0""",
)
def message_stream(spark, folder):
    """Messages from a source, decoded; the broken ones are kept aside."""
    source = envelope.read_event_stream(spark, "text", write_messages(spark, folder))
    path = new_folder(spark)
    pipeline.run_pipeline(
        source,
        pipeline.Config(),
        path,
        decode=lambda df: pipeline.parse_alerts(df, MESSAGE),
    ).awaitTermination()
    written = Store(spark, path)
    stored = written.output("alerts", T.StructType.fromDDL(pipeline.STORED)).select(
        "alert_id", "status", "ts", F.lit("stored").alias("kind")
    )
    dead = written.output("dead_letters", T.StructType.fromDDL("raw string, error string"))
    none = F.lit(None)
    return stored.unionByName(
        dead.select(
            none.cast("long").alias("alert_id"),
            none.cast("string").alias("status"),
            none.cast("timestamp").alias("ts"),
            F.lit("dead").alias("kind"),
        )
    )


REFUSED = (13, 500)


@query(
    "st6_failing_messages",
    f"""WITH {ALERTS},
before AS (SELECT *, lag(content_hash) {KEY_WINDOW} AS b FROM alerts
  WHERE alert_id % 97 <> 0 AND alert_id NOT IN {REFUSED})
SELECT alert_id, status, 'stored' AS kind FROM before WHERE b IS NULL OR b <> content_hash
UNION ALL SELECT NULL, NULL, 'dead' FROM alerts WHERE alert_id % 97 = 0
UNION ALL SELECT alert_id, NULL, 'undelivered' FROM alerts WHERE alert_id IN {REFUSED}""",
)
def failing_messages(spark, folder):
    """Two messages end the job that decodes them; they are set aside, all others are stored."""

    def id_of(message):
        return F.get_json_object(F.get_json_object(message, "$.event"), "$.alert_id")

    def decode(messages):
        refused = F.coalesce(id_of("value").isin(*map(str, REFUSED)), F.lit(False))
        value = F.when(refused, F.raise_error(F.lit("refused"))).otherwise(F.col("value"))
        return pipeline.parse_alerts(messages.withColumn("value", value), MESSAGE)

    path = new_folder(spark)
    pipeline.run_pipeline(
        envelope.read_event_stream(spark, "text", write_messages(spark, folder)),
        pipeline.Config(),
        path,
        decode=decode,
        delivery=delivery.Delivery(attempts=2, backoff_seconds=0.1),
    ).awaitTermination()
    written = Store(spark, path)
    none = F.lit(None)
    stored = written.output("alerts", T.StructType.fromDDL(pipeline.STORED))
    dead = written.output("dead_letters", T.StructType.fromDDL("raw string, error string"))
    aside = written.output(
        delivery.UNDELIVERED, T.StructType.fromDDL(delivery.UNDELIVERED_SCHEMA)
    )
    message = F.get_json_object("raw", "$.value")
    return (
        stored.select("alert_id", "status", F.lit("stored").alias("kind"))
        .unionByName(
            dead.select(
                none.cast("long").alias("alert_id"),
                none.cast("string").alias("status"),
                F.lit("dead").alias("kind"),
            )
        )
        .unionByName(
            aside.select(
                id_of(message).cast("long").alias("alert_id"),
                none.cast("string").alias("status"),
                F.lit("undelivered").alias("kind"),
            )
        )
    )


@query(
    "s5_archive_raw",
    """SELECT concat('t', user_id % 3) AS tenant_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n,
  min(props) AS first_raw FROM events GROUP BY ALL""",
)
def archive_raw(spark, folder):
    path = f"{new_folder(spark)}/raw"
    raw = tables.alerts(spark, folder).select("tenant_id", "ts", F.col("props").alias("raw"))
    envelope.archive_raw(raw, path)
    return (
        spark.read.parquet(path)
        .groupBy("tenant_id", F.col("day").cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("first_raw"))
    )


@query(
    "s6_upsert_snapshot",
    f"""WITH {ALERTS} SELECT tenant_id, fingerprint, arg_max(alert_id, (ts, alert_id)) AS alert_id,
  max(ts) AS ts, arg_max(CASE severity WHEN 'low' THEN 1 WHEN 'info' THEN 2 WHEN 'warning' THEN 3
    WHEN 'high' THEN 4 ELSE 5 END, (ts, alert_id)) AS severity FROM alerts GROUP BY ALL""",
)
def upsert_snapshot(spark, folder):
    """The newest row per key as an index holds it, kept up by a stream."""
    path = new_folder(spark)
    rows = envelope.index_rows(alert_stream(spark, folder)).select(
        "tenant_id", "fingerprint", "alert_id", "ts", "severity"
    )

    def each(batch, batch_id):
        store.upsert_snapshot(
            Store(batch.sparkSession, path),
            "index",
            batch,
            ["tenant_id", "fingerprint"],
            ["ts", "alert_id"],
            batch_id,
        )

    (
        rows.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{path}/_checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return Store(spark, path).snapshot("index", rows.schema)


@query(
    "st6_repeated_batch_counts_once",
    f"""WITH {ALERTS},
before AS (SELECT *, lag(content_hash) {KEY_WINDOW} AS b FROM alerts)
SELECT tenant_id, count(*) AS n, count(DISTINCT alert_id) AS n_distinct FROM before
WHERE b IS NULL OR b <> content_hash GROUP BY tenant_id""",
)
def repeated_batch(spark, folder):
    """A batch that runs again after a failure replaces what it wrote."""
    target = Store(spark, new_folder(spark))
    alerts = tables.alerts(spark, folder)
    for _ in range(2):
        pipeline.process_batch(alerts, target, pipeline.Config(), 0)
    stored = target.output("alerts", T.StructType.fromDDL(pipeline.STORED))
    return stored.groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("alert_id").alias("n_distinct")
    )


HALF = "2024-01-16 00:00:00"


@query(
    "st2_state_across_batches",
    f"""WITH {ALERTS},
runs AS (SELECT *, lag(content_hash) {KEY_WINDOW} AS b,
    count(*) FILTER (status = 'acknowledged') {KEY_WINDOW} AS ga,
    count(*) FILTER (status = 'resolved') {KEY_WINDOW} AS gr,
    count(*) FILTER (status <> 'firing') {KEY_WINDOW} AS gf FROM alerts),
all_rows AS (SELECT alert_id, ts, CASE WHEN b IS NULL THEN 'none' WHEN b = content_hash
    THEN 'full' ELSE 'partial' END AS dedup_type,
  row_number() OVER (PARTITION BY tenant_id, fingerprint, ga ORDER BY ts, alert_id)
    - CASE WHEN ga > 0 THEN 1 ELSE 0 END AS firing_counter,
  row_number() OVER (PARTITION BY tenant_id, fingerprint, gr ORDER BY ts, alert_id)
    - CASE WHEN gr > 0 THEN 1 ELSE 0 END AS unresolved_counter,
  CASE WHEN status = 'firing' THEN min(ts) FILTER (status = 'firing')
    OVER (PARTITION BY tenant_id, fingerprint, gf) END AS firing_start FROM runs)
SELECT * EXCLUDE (ts) FROM all_rows WHERE ts >= TIMESTAMP '{HALF}'""",
)
def state_across_batches(spark, folder):
    """The second half of the alerts on the key state the first half left."""
    alerts = tables.alerts(spark, folder)
    older = F.col("ts") < F.lit(HALF).cast("timestamp")
    empty = spark.createDataFrame([], keyed_state.KEY_STATE)
    first = keyed_state.features_with_state(alerts.filter(older), empty)
    left = lineage.cut(keyed_state.next_key_state(empty, first))
    second = keyed_state.classify_with_state(alerts.filter(~older), left)
    return keyed_state.features_with_state(second, left).select(
        "alert_id", "dedup_type", "firing_counter", "unresolved_counter", "firing_start"
    )


@query(
    "st5_late_alerts_keep_newest_state",
    f"""WITH {ALERTS} SELECT tenant_id, fingerprint, arg_max(alert_id, (ts, alert_id))
  AS alert_id, max(ts) AS ts, min(ts) AS first_ts FROM alerts GROUP BY ALL""",
)
def late_alerts(spark, folder):
    """The newer half first, the older half after it: the newest alert stays."""
    alerts = tables.alerts(spark, folder)
    older = F.col("ts") < F.lit(HALF).cast("timestamp")
    empty = spark.createDataFrame([], keyed_state.KEY_STATE)
    newer = keyed_state.features_with_state(alerts.filter(~older), empty)
    state = lineage.cut(keyed_state.next_key_state(empty, newer))
    late = keyed_state.features_with_state(alerts.filter(older), state)
    after = keyed_state.next_key_state(state, late)
    return after.select("tenant_id", "fingerprint", "alert_id", "ts", "first_ts")
