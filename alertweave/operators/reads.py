"""Filtered, sorted and paged reads of alerts and incidents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertweave.functions import predicates
from alertweave.functions.paths import FieldMap, Json, MapKey, Plain
from alertweave.operators.enrich import with_enrichment
from alertweave.operators.scan import ALERT_KEY, run_scans, since_reset

# user field names of an incident query; later targets are fallbacks
INCIDENT_FIELDS = FieldMap(
    {
        "id": [Plain("incident_id")],
        "name": [Plain("user_generated_name"), Plain("ai_generated_name")],
        "summary": [Plain("user_summary"), Plain("generated_summary")],
        "assignee": [Plain("assignee")],
        "severity": [Plain("severity")],
        "status": [MapKey("incident_enrichments", "status"), Plain("status")],
        "creation_time": [Plain("creation_time")],
        "start_time": [Plain("start_time")],
        "end_time": [Plain("end_time")],
        "last_seen_time": [Plain("last_seen_time")],
        "is_predicted": [Plain("is_predicted")],
        "is_candidate": [Plain("is_candidate")],
        "is_visible": [Plain("is_visible")],
        "alerts_count": [Plain("alerts_count")],
        "merged_at": [Plain("merged_at")],
        "merged_by": [Plain("merged_by")],
        "hasLinkedIncident": [Plain("has_linked_incident")],
        "sources": [Plain("sources")],
        "affectedServices": [Plain("affected_services")],
        "alert.providerType": [Plain("provider_type")],
        "alert.*": [MapKey("enrichments"), Json("event")],
    }
)
SORT_FIELDS = (
    "creation_time",
    "start_time",
    "last_seen_time",
    "severity",
    "status",
    "alerts_count",
)
PAGE = 25


def filter_alerts(df: DataFrame, predicate: Column | str | None) -> DataFrame:
    """Rows a stored predicate selects; an unknown result counts as no."""
    return predicates.select(df, predicate)


def restrict(
    incidents: DataFrame,
    candidate: bool | None = None,
    predicted: bool | None = None,
    ids: DataFrame | None = None,
    visible: bool = True,
) -> DataFrame:
    """Flag filters and an id allow-list (a DataFrame, so it may be long)."""
    out = incidents.filter(F.col("is_visible") == visible)
    if candidate is not None:
        out = out.filter(F.col("is_candidate") == candidate)
    if predicted is not None:
        out = out.filter(F.col("is_predicted") == predicted)
    if ids is not None:
        out = out.join(ids.select("incident_id"), "incident_id", "left_semi")
    return out


def group_pulled_alerts(
    alerts: DataFrame, enrichments: DataFrame, fields: list[str]
) -> DataFrame:
    """Pulled alerts grouped by key: enriched rows with their position inside the key.

    The groups stay rows (a key may hold any number of alerts); write them sorted by key
    and position to get them side by side.
    """
    ranked = run_scans(alerts, [since_reset("position", F.lit(False))])
    return with_enrichment(ranked, enrichments, fields, list(ALERT_KEY))


class Fields:
    """The fields a filter may ask for; remembers which it asked for."""

    def __init__(self, fields: FieldMap):
        self._fields = fields
        self.used: set[str] = set()

    def where(self, path: str, test: Callable[[Column], Column]) -> Column:
        """``test`` on a field; an unknown field selects nothing."""
        self.used.add(path)
        return self._fields.where(path, test)

    @property
    def needs_alerts(self) -> bool:
        return any(path.startswith("alert.") for path in self.used)


Filter = Callable[[Fields], Column]


@dataclass(frozen=True)
class IncidentTables:
    """What an incident query may read; the last four only if its filter needs them."""

    incidents: DataFrame
    incident_enrichments: DataFrame
    links: DataFrame
    latest: DataFrame
    alerts: DataFrame
    enrichments: DataFrame


def incidents_with_enrichment(incidents: DataFrame, enrichments: DataFrame) -> DataFrame:
    """Left join on the incident id as text."""
    right = enrichments.select(
        "tenant_id",
        F.col("key").alias("_key"),
        F.col("enrichments").alias("incident_enrichments"),
    )
    keyed = incidents.withColumn("_key", F.col("incident_id").cast("string"))
    return keyed.join(right, ["tenant_id", "_key"], "left").drop("_key")


def flag_linked_incident(incidents: DataFrame) -> DataFrame:
    return incidents.withColumn(
        "has_linked_incident", F.col("same_incident_in_the_past_id").isNotNull()
    )


def incidents_with_alerts(incidents: DataFrame, t: IncidentTables) -> DataFrame:
    """Incidents with their live alerts' newest rows and enrichments; incidents without
    alerts stay.

    The newest rows of the keys are read first, one for each key, so the links, which are many
    more, are moved by key once and do not meet all alerts.
    """
    live = t.links.filter(F.col("deleted_at").isNull()).select(
        "incident_id", *ALERT_KEY
    ).distinct()
    newest = t.latest.select(*ALERT_KEY, "alert_id")
    alerts = t.alerts.select("alert_id", *ALERT_KEY, "event", "provider_type")
    read = newest.join(alerts, [*ALERT_KEY, "alert_id"], "left")
    chain = live.join(read, list(ALERT_KEY), "left").join(
        t.enrichments, list(ALERT_KEY), "left"
    )
    return incidents.join(chain, ["tenant_id", "incident_id"], "left")


def select_incidents(
    t: IncidentTables,
    where: Filter | None = None,
    fields: FieldMap = INCIDENT_FIELDS,
    **restrictions,
) -> DataFrame:
    """Incidents a filter selects, each once. Alerts are joined only if it asks for them."""
    asked = Fields(fields)
    test = where(asked) if where else F.lit(True)
    base = restrict(flag_linked_incident(t.incidents), **restrictions)
    rows = incidents_with_enrichment(base, t.incident_enrichments)
    columns = rows.columns
    if asked.needs_alerts:
        rows = incidents_with_alerts(rows, t)
    found = rows.filter(test)
    if asked.needs_alerts:
        ids = found.select("incident_id").distinct()
        found = incidents_with_enrichment(base, t.incident_enrichments).join(
            ids, "incident_id", "left_semi"
        )
    return found.select(*columns)


def sort_by(option: str, typed: str | None = None) -> list[Column]:
    """Order for a sort option (a minus in front means descending), nulls last, the id as
    the tie-breaker. ``typed`` casts a text key first."""
    name = option.removeprefix("-")
    col = F.col(name)
    if typed:
        col = col.try_cast(typed)
    first = col.desc_nulls_last() if option.startswith("-") else col.asc_nulls_last()
    return [first, F.col("incident_id").asc()]


def page(df: DataFrame, order: list[Column], limit: int = PAGE, offset: int = 0) -> DataFrame:
    """One page; Spark keeps only the top rows of each partition."""
    return df.orderBy(*order).offset(offset).limit(limit)


def query_incidents(
    t: IncidentTables,
    where: Filter | None = None,
    sort: str = "creation_time",
    limit: int = PAGE,
    offset: int = 0,
    **restrictions,
) -> tuple[DataFrame, DataFrame]:
    """A page of incidents, and the total as a one-row DataFrame."""
    found = select_incidents(t, where, **restrictions)
    return page(found, sort_by(sort), limit, offset), count_incidents(found)


def count_incidents(found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("total"))


def alerts_of_incidents(
    incident_ids: DataFrame, live: DataFrame, latest: DataFrame, alerts: DataFrame
) -> DataFrame:
    """Newest alert of every live link of the given incidents."""
    wanted = live.join(incident_ids, "incident_id", "left_semi")
    return wanted.join(latest.select(*ALERT_KEY, "alert_id"), list(ALERT_KEY)).join(
        alerts, [*ALERT_KEY, "alert_id"]
    )


def incidents_of_alerts(
    keys: DataFrame, live: DataFrame, incidents: DataFrame
) -> DataFrame:
    """Incidents that hold one of the given alert keys."""
    wanted = live.join(keys, list(ALERT_KEY), "left_semi")
    return wanted.join(incidents, ["tenant_id", "incident_id"])


def incident_alert_page(
    links: DataFrame,
    latest: DataFrame,
    incident_id: object,
    limit: int = PAGE,
    offset: int = 0,
    include_unlinked: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Alerts of one incident with link data, newest first, and their number."""
    own = links.filter(F.col("incident_id") == F.lit(incident_id))
    if not include_unlinked:
        own = own.filter(F.col("deleted_at").isNull())
    edges = own.groupBy("incident_id", *ALERT_KEY).agg(
        F.min("linked_at").alias("linked_at"), F.max("deleted_at").alias("deleted_at")
    )
    rows = edges.join(latest, list(ALERT_KEY))
    order = [F.col("ts").desc(), F.col("fingerprint").asc()]
    return page(rows, order, limit, offset), rows.agg(F.count(F.lit(1)).alias("total"))


def latest_logs(logs: DataFrame, per: str, n: int) -> DataFrame:
    """Newest ``n`` rows per group. Spark limits each group before the shuffle, so a hot
    group sends at most ``n`` rows per input partition."""
    w = Window.partitionBy(per).orderBy(F.col("ts").desc(), F.col("log_id").desc())
    return logs.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def enrichment_event_page(
    events: DataFrame, rule_id: int, limit: int = PAGE, offset: int = 0
) -> DataFrame:
    own = events.filter(F.col("rule_id") == rule_id)
    return page(own, [F.col("ts").desc(), F.col("alert_id").asc()], limit, offset)


def alerts_by_fingerprints(alerts: DataFrame, keys: DataFrame) -> DataFrame:
    """All alerts of the given keys, newest first."""
    found = alerts.join(keys, list(ALERT_KEY), "left_semi")
    return found.orderBy(F.col("ts").desc(), F.col("alert_id").desc())


def rules_by_priority(rules: DataFrame) -> DataFrame:
    """Enabled rules, highest priority first."""
    return rules.filter(~F.col("disabled")).orderBy(F.col("priority").desc(), "rule_id")


def linked_providers(alerts: DataFrame, providers: DataFrame) -> DataFrame:
    """Provider pairs that sent alerts but are not installed, with their last alert."""
    seen = (
        alerts.filter(F.col("provider_type") != "group")
        .groupBy("tenant_id", "provider_type", "provider_id")
        .agg(F.max("ts").alias("last_alert_ts"))
    )
    return seen.join(providers, ["tenant_id", "provider_id"], "left_anti")


def resolve_provider(events: DataFrame, providers: DataFrame) -> DataFrame:
    """Provider id and type by (tenant, name) where only the name is given."""
    one = providers.groupBy("tenant_id", "provider_name").agg(
        F.min(F.struct("provider_id", "provider_type")).alias("_p")
    )
    joined = events.join(one, ["tenant_id", "provider_name"], "left")
    return joined.withColumns(
        {
            c: F.coalesce(F.col(c), F.col(f"_p.{c}")) for c in ("provider_id", "provider_type")
        }
    ).drop("_p")


def preset_hits(alerts: DataFrame, presets: dict[str, str]) -> DataFrame:
    """How many alerts each saved filter selects, in one pass; an empty one selects all."""
    rows, tests = predicates.attach_tests(alerts, list(presets.values()))
    hits = F.array_compact(
        F.array(*[F.when(tests[p], F.lit(n)) for n, p in presets.items()])
    )
    return (
        rows.select("tenant_id", F.explode(hits).alias("preset"))
        .groupBy("tenant_id", "preset")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def distinct_values(live: DataFrame, summary: DataFrame, column: str) -> DataFrame:
    """Distinct services or sources of live linked alerts, per tenant."""
    return (
        summary.join(live, list(ALERT_KEY), "left_semi").select("tenant_id", column).distinct()
    )


def diff_ignoring(a: DataFrame, b: DataFrame, ignored: list[str]) -> DataFrame:
    """Rows only in one of two alert tables, ``ignored`` columns left out of the test."""
    cols = [c for c in a.columns if c not in ignored]
    left, right = a.select(*cols), b.select(*cols)
    return (
        left.exceptAll(right)
        .withColumn("side", F.lit("left"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
    )
