"""Event sources, envelope decoding, dead letters, archive, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.functions.scalars import severity_rank

ENVELOPE = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("provider_type", T.StringType()),
        T.StructField("provider_id", T.StringType()),
        T.StructField("provider_name", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("api_key_name", T.StringType()),
        T.StructField("timestamp_forced", T.StringType()),
        T.StructField("notify_client", T.BooleanType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)
ALERT_EVENT = "alert"
INCIDENT_EVENT = "incident"


def read_event_stream(
    spark: SparkSession,
    source: str = "kafka",
    path: str | None = None,
    schema: T.StructType | str = "value string",
    **options: str,
) -> DataFrame:
    """A stream of messages with a text column ``value``.

    Kafka options pass through (topic, security, ...); the start is the earliest offset
    unless given. Any file source works with ``path``.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.options(**{"startingOffsets": "earliest", **options})
        return reader.load().withColumn("value", F.col("value").cast("string"))
    return reader.options(**options).schema(schema).load(path)


def parse_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """All messages with their envelope ``_e``, and ``error`` where one does not decode."""
    parsed = df.withColumn(
        "_e",
        F.from_json(
            value, ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
        ),
    )
    corrupt = F.col("_e").isNull() | F.col("_e._corrupt").isNotNull()
    missing = F.col("_e.tenant_id").isNull() | F.col("_e.event").isNull()
    error = F.when(corrupt, "not valid JSON").when(missing, "tenant_id or event missing")
    return parsed.withColumn("error", error)


def decode_envelope(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Decoded envelopes, and the messages that do not decode with the reason."""
    marked = parse_envelope(df, value)
    keep = [c for c in df.columns if c != value]
    names = [f.name for f in ENVELOPE if f.name != "_corrupt"]
    good = (
        marked.filter(F.col("error").isNull())
        .select(*keep, *[F.col(f"_e.{n}").alias(n) for n in names])
        .withColumns(
            {
                "notify_client": F.coalesce("notify_client", F.lit(True)),
                "event_type": F.coalesce("event_type", F.lit(ALERT_EVENT)),
            }
        )
    )
    bad = marked.filter(F.col("error").isNotNull()).select(
        *keep, F.col(value).alias("raw"), "error"
    )
    return good, bad


def route_events(
    df: DataFrame, incident_provider: str = INCIDENT_EVENT
) -> tuple[DataFrame, DataFrame]:
    """Alert events and incident events; a provider type may also name the latter. Other
    event types go to neither."""
    kind, provider = F.col("event_type"), F.col("provider_type")
    incident = _is_incident(kind, provider, incident_provider)
    return df.filter(is_alert(kind, provider, incident_provider)), df.filter(incident)


def is_alert(
    event_type: Column, provider_type: Column, incident_provider: str = INCIDENT_EVENT
) -> Column:
    incident = _is_incident(event_type, provider_type, incident_provider)
    return ~incident & (event_type == ALERT_EVENT)


def _is_incident(event_type: Column, provider_type: Column, provider: str) -> Column:
    found = (event_type == INCIDENT_EVENT) | (provider_type == provider)
    return F.coalesce(found, F.lit(False))


def dead_letters(df: DataFrame, valid: Column, error: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the others with the error flag and message."""
    ok = F.coalesce(valid, F.lit(False))
    bad = df.filter(~ok).withColumns({"is_error": F.lit(True), "error_message": error})
    return df.filter(valid), bad


def archive_raw(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Append raw payloads, one folder per tenant and day."""
    day = F.to_date(ts)
    df.withColumn("day", day).write.mode("append").partitionBy("tenant_id", "day").parquet(path)


def index_rows(alerts: DataFrame) -> DataFrame:
    """Snapshot form of alerts: one row per key, severity as its rank."""
    return alerts.withColumn("severity", severity_rank(F.col("severity")))


def latest_wins(
    old: DataFrame | None, new: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Newest row per key of both inputs; an older row never replaces a newer one."""
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    picked = both.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def search_snapshot(
    snapshot: DataFrame, predicate: Column, limit: int | None = None
) -> DataFrame:
    """Rows of the snapshot that match; with ``limit``, a page of the newest ones."""
    found = snapshot.filter(predicate)
    if limit is None:
        return found
    return found.orderBy(F.col("ts").desc(), "fingerprint", "tenant_id").limit(limit)


def flatten_rule_config(df: DataFrame, config: str = "config") -> DataFrame:
    """Nested provider configuration to one row per deduplication rule.

    ``{"provider": {"type": t, "deduplication_rules": {"rule": {...}}}}``
    """
    rule = T.StructType(
        [
            T.StructField("description", T.StringType()),
            T.StructField("fingerprint_fields", T.ArrayType(T.StringType())),
            T.StructField("ignore_fields", T.ArrayType(T.StringType())),
            T.StructField("full_deduplication", T.BooleanType()),
        ]
    )
    provider = T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("deduplication_rules", T.MapType(T.StringType(), rule)),
        ]
    )
    schema = T.MapType(T.StringType(), provider)
    keep = [c for c in df.columns if c != config]
    providers = df.select(
        *keep, F.explode(F.from_json(config, schema)).alias("provider_name", "_p")
    )
    rules = providers.select(
        *keep,
        "provider_name",
        F.col("_p.type").alias("provider_type"),
        F.explode("_p.deduplication_rules").alias("rule_name", "_r"),
    )
    empty = F.array().cast("array<string>")
    return rules.select(
        *keep,
        "provider_name",
        "provider_type",
        "rule_name",
        F.coalesce("_r.description", F.lit("")).alias("description"),
        F.coalesce("_r.fingerprint_fields", empty).alias("fingerprint_fields"),
        F.coalesce("_r.ignore_fields", empty).alias("ignore_fields"),
        F.coalesce("_r.full_deduplication", F.lit(False)).alias("full_deduplication"),
    )
