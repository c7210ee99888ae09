"""The whole ingestion pipeline on micro-batches, built from the batch operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from alertweave.functions.scalars import severity_rank
from alertweave.operators import correlate, dedup, enrich, maintenance, mapping, reads
from alertweave.operators.scan import ALERT_KEY, MAX_ROWS, has_hot_key
from alertweave.sources import envelope
from alertweave.streaming import state as keyed_state
from alertweave.streaming.delivery import Delivery, deliver
from alertweave.streaming.store import Store

# no field of a stored alert may be left to inference
STORED = (
    "tenant_id string, fingerprint string, alert_id long, ts timestamp, name string, "
    "service string, provider_type string, provider_id string, status string, "
    "severity string, severity_rank int, k int, content_hash string, "
    "previous_status string, dedup_type string, firing_start timestamp, "
    "firing_since_resolved timestamp, firing_counter long, unresolved_counter long, "
    "started_at timestamp, labels map<string,string>"
)
AUDIT = (
    "tenant_id string, fingerprint string, ts timestamp, actor string, action string, "
    "description string"
)
# every matched alert; those of an incident are the opened ones
MATCHED = (
    "tenant_id string, rule_id string, group_key string, session_no long, "
    "fingerprint string, alert_id long, ts timestamp, service string, severity_rank int, "
    "status string, unresolved_counter long, matched array<int>, opened boolean"
)
HITS = "tenant_id string, preset string, n long"

# alerts and dead letters
Decoded = tuple[DataFrame, DataFrame]
# gives both, or what ``parse_alerts`` gives, which holds both
Decode = Callable[[DataFrame], DataFrame | Decoded]


@dataclass(frozen=True)
class Config:
    """Rules of a pipeline; every list may be empty."""

    correlation: list[correlate.CorrelationRule] = field(default_factory=list)
    extraction: list[mapping.ExtractionRule] = field(default_factory=list)
    mappings: list[mapping.MappingRule] = field(default_factory=list)
    lookups: dict[str, DataFrame] = field(default_factory=dict)
    windows: list[maintenance.MaintenanceWindow] = field(default_factory=list)
    maintenance_strategy: str = "default"
    presets: dict[str, str] = field(default_factory=dict)
    max_rows: int = MAX_ROWS


def parse_alerts(
    messages: DataFrame, schema: T.StructType | str, value: str = "value"
) -> DataFrame:
    """Each message as a typed ``alert``, or as ``raw`` with its ``error``; an incident event
    as neither.

    No row is filtered here: Spark would repeat the parsing in every condition on its result.
    """
    marked = envelope.parse_envelope(messages, value)
    kind = F.coalesce("_e.event_type", F.lit(envelope.ALERT_EVENT))
    alert = F.col("error").isNull() & envelope.is_alert(kind, F.col("_e.provider_type"))
    events = marked.select(
        F.when(F.col("error").isNotNull(), F.col(value)).alias("_message"),
        F.col("error").alias("_error"),
        F.col("_e.tenant_id").alias("tenant_id"),
        F.when(alert, F.col("_e.event")).alias("_event"),
    )
    parsed = events.withColumn("_a", F.from_json("_event", schema))
    valid = F.col("_a.alert_id").isNotNull() & F.col("_a.ts").isNotNull()
    failed = F.col("_event").isNotNull() & ~valid
    return parsed.select(
        F.when(valid, F.struct("tenant_id", "_a.*")).alias("alert"),
        F.coalesce("_message", F.when(failed, F.col("_event"))).alias("raw"),
        F.coalesce("_error", F.when(failed, F.lit("alert_id or ts missing"))).alias("error"),
    )


def decode_alerts(
    messages: DataFrame, schema: T.StructType | str, value: str = "value"
) -> Decoded:
    """Messages to typed alerts and dead letters; incident events are left aside."""
    return _split(parse_alerts(messages, schema, value))


def _split(parsed: DataFrame) -> Decoded:
    alerts = parsed.filter(F.col("alert").isNotNull()).select("alert.*")
    return alerts, parsed.filter(F.col("error").isNotNull()).select("raw", "error")


def process_batch(
    alerts: DataFrame, store: Store, config: Config, batch_id: int
) -> None:
    """One micro-batch, in this order: pre-extraction, maintenance, deduplication,
    counters, extraction, mapping, storage, latest state, correlation, presets.

    What several outputs need is written first and read back, so the plan behind it runs
    once, and a lost executor costs no recomputation of it. Unless a key is hot, duplicates and
    counters come from one shuffle: full duplicates are counted apart from the other rows.
    """
    chunk = config.max_rows
    keys = store.snapshot("keys", T.StructType.fromDDL(keyed_state.KEY_STATE), batch_id)
    sessions = store.snapshot(
        "sessions", T.StructType.fromDDL(keyed_state.SESSION_STATE), batch_id
    )

    rows = mapping.extract(alerts, config.extraction, pre=True)
    kept, silenced = maintenance.apply_maintenance(
        rows, config.windows, config.maintenance_strategy
    )
    if not (config.extraction or config.mappings):
        # nothing reads other fields after this
        names = {f.name for f in T.StructType.fromDDL(STORED)}
        kept = kept.select(*[F.col(f"`{c}`") for c in kept.columns if c in names])
    hot = has_hot_key(kept, ALERT_KEY, chunk)
    classified = keyed_state.classify_with_state(kept, keys, chunk if hot else None)
    if not hot:
        apart = classified.withColumn("_full", F.col("dedup_type") == "full")
        classified = keyed_state.features_with_state(apart, keys, None, ("_full",))
    store.append("classified", classified, batch_id)
    classified = _written(store, "classified", classified.schema, batch_id)
    store.append(
        "audit",
        _as(silenced.unionByName(enrich.lifecycle_audit(classified)), AUDIT),
        batch_id,
    )
    counted = dedup.drop_full_duplicates(classified)
    if hot:
        counted = keyed_state.features_with_state(counted, keys, chunk)
    extracted = mapping.extract(counted, config.extraction, pre=False)
    mapped = mapping.map_alerts(extracted, config.mappings, config.lookups)
    ranked = mapped.withColumn("severity_rank", severity_rank(F.col("severity")))
    store.append("alerts", _as(ranked, STORED), batch_id)

    stored = _written(store, "alerts", STORED, batch_id)
    store.replace("keys", keyed_state.next_key_state(keys, stored), batch_id)

    open_rows, _ = maintenance.skip_maintenance(stored)
    hits = reads.preset_hits(open_rows, config.presets) if config.presets else None
    if hits is not None:
        store.append("preset_hits", _as(hits, HITS), batch_id)
    if not config.correlation:
        return
    matches = correlate.match_rules(open_rows, config.correlation)
    keyed = correlate.group_key(matches, config.correlation)
    placed = keyed_state.sessions_with_state(keyed, config.correlation, sessions, chunk)
    store.append("matched", _as(placed, MATCHED), batch_id)
    placed = _written(store, "matched", MATCHED, batch_id)
    store.replace("sessions", keyed_state.next_session_state(sessions, placed), batch_id)


def incident_alerts(store: Store) -> DataFrame:
    """The alerts of incidents over all finished batches."""
    return correlate.opened_rows(store.output("matched", T.StructType.fromDDL(MATCHED)))


def _as(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a schema, with its types."""
    schema = T.StructType.fromDDL(ddl)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _written(
    store: Store, name: str, schema: str | T.StructType, batch_id: int
) -> DataFrame:
    path = f"{store.path}/{name}/batch={batch_id}"
    return store.spark.read.schema(schema).parquet(path)


def run_pipeline(
    stream: DataFrame,
    config: Config,
    path: str,
    decode: Decode | None = None,
    trigger: dict | None = None,
    delivery: Delivery | None = None,
) -> StreamingQuery:
    """Start the pipeline on a stream of alerts, or of messages with ``decode``. What ``decode``
    gives is written once and read back: ``parse_alerts`` reads each message once.

    Delivery is at least once from the source; every output is keyed by the batch id, so a
    repeated batch replaces itself and results come out once. With ``delivery``, a failing batch
    is tried again and its failing messages are set aside; without, it stops the stream.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, path)

        def work(rows: DataFrame, into: Store) -> None:
            alerts = rows
            if decode is not None:
                alerts, dead = _decoded(decode(rows), into, batch_id)
                into.append("dead_letters", dead, batch_id)
            process_batch(alerts, into, config, batch_id)

        if delivery is None:
            work(batch, store)
        else:
            row_work = partial(_rows_alone, config=config, decode=decode)
            deliver(batch, batch_id, store, work, delivery, (row_work,))

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{path}/_checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _decoded(found: DataFrame | Decoded, store: Store, batch_id: int) -> Decoded:
    """The alerts as a table of the store, so that several readers cost one decoding."""
    rows = found if isinstance(found, DataFrame) else found[0]
    store.append("decoded", rows, batch_id)
    written = _written(store, "decoded", rows.schema, batch_id)
    return _split(written) if isinstance(found, DataFrame) else (written, found[1])


def _rows_alone(rows: DataFrame, config: Config, decode: Decode | None) -> None:
    """What is done to each message by itself: decoding, extraction, mapping."""
    alerts = rows if decode is None else decode(rows)
    if decode is not None and (config.extraction or config.mappings):
        alerts = _split(alerts)[0] if isinstance(alerts, DataFrame) else alerts[0]
    elif not isinstance(alerts, DataFrame):
        alerts = alerts[0]
    for pre in (True, False):
        alerts = mapping.extract(alerts, config.extraction, pre=pre)
    mapped = mapping.map_alerts(alerts, config.mappings, config.lookups)
    mapped.write.format("noop").mode("overwrite").save()


def recover_expired(
    store: Store, windows: list[maintenance.MaintenanceWindow], as_of: str
) -> DataFrame:
    """Stored alerts in maintenance, with those whose windows are over recovered; run it
    per trigger or on a schedule, then correlate the recovered ones."""
    stored = store.output("alerts", T.StructType.fromDDL(STORED))
    newest = stored.groupBy(*ALERT_KEY).agg(F.max(F.struct("ts", "alert_id")).alias("_at"))
    current = stored.join(
        newest.select(*ALERT_KEY, F.col("_at.alert_id").alias("alert_id")),
        [*ALERT_KEY, "alert_id"],
        "left_semi",
    )
    return maintenance.recover_maintenance(
        current, windows, F.lit(as_of).cast("timestamp")
    )

