"""The join of incidents with their alerts moves the links once by key."""

from __future__ import annotations

from alertweave.operators import reads
from alertweave.operators.reads import IncidentTables


def tables_of(spark):
    key = "tenant_id string, fingerprint string"
    incidents = spark.createDataFrame([("t", 1), ("t", 2), ("t", 3)], "tenant_id string, incident_id long")
    rows = [(1, "t", "a", None), (1, "t", "a", None), (1, "t", "b", None), (2, "t", "c", None), (2, "t", "a", 5)]
    links = spark.createDataFrame(rows, f"incident_id long, {key}, deleted_at int")
    latest = spark.createDataFrame([("t", "a", "a2"), ("t", "b", "gone")], f"{key}, alert_id string")
    alerts = [("a1", "t", "a", "old", "p"), ("a2", "t", "a", "new", "p"), ("a2", "t", "a", "new again", "p")]
    alerts = spark.createDataFrame(alerts, f"alert_id string, {key}, event string, provider_type string")
    # a key without a newest row has enrichments all the same
    enrichments = spark.createDataFrame([("t", "c", {"x": "y"})], f"{key}, enrichments map<string,string>")
    return IncidentTables(incidents, None, links, latest, alerts, enrichments)


def test_rows_and_shuffles(spark):
    t = tables_of(spark)
    out = reads.incidents_with_alerts(t.incidents, t)
    got = sorted(map(repr, ((r.incident_id, r.fingerprint, r.event, r.enrichments) for r in out.collect())))
    want = [(1, "a", "new", None), (1, "a", "new again", None), (1, "b", None, None), (2, "c", None, {"x": "y"}), (3, None, None, None)]
    assert got == sorted(map(repr, want))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = reads.incidents_with_alerts(t.incidents, t)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # links: distinct, by alert key, by incident; newest rows twice; alerts, enrichments, incidents once
    assert plan.count("Exchange hashpartitioning") == 8
