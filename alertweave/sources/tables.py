"""Table readers, and the adapters from the given tables to the alert data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Parquet tables of a folder by name."""
    return {n: read_table(spark, folder, n) for n in names}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a SQL database; pass partitionColumn, lowerBound, upperBound and
    numPartitions to read it in parallel. Needs the database's driver jar."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts derived from ``events``: 3 tenants, one fingerprint per user, 20 services."""
    return adapt_alerts(read_table(spark, folder, "events"))


def adapt_alerts(events: DataFrame) -> DataFrame:
    """The alert form of event rows, of a table or a stream."""
    user, kind, value = F.col("user_id"), F.col("event_type"), F.col("value")
    status = F.when(kind == "purchase", "resolved").when(kind == "signup", "acknowledged")
    severity = (
        F.when(value < 5, "low")
        .when(value < 15, "info")
        .when(value < 40, "warning")
        .when(value < 100, "high")
        .otherwise("critical")
    )
    provider = (
        F.when(user % 4 == 0, "prometheus")
        .when(user % 4 == 1, "grafana")
        .when(user % 4 == 2, "datadog")
        .otherwise("sentry")
    )
    k = F.get_json_object("props", "$.k")
    base = events.select(
        F.col("event_id").alias("alert_id"),
        F.concat(F.lit("t"), user % 3).alias("tenant_id"),
        F.sha2(F.concat(F.lit("user-"), user), 256).alias("fingerprint"),
        F.concat(F.lit("alert-"), user % 20).alias("name"),
        F.concat(F.lit("svc-"), user % 20).alias("service"),
        provider.alias("provider_type"),
        F.when(user % 7 != 0, F.concat(F.lit("p-"), user % 4)).alias("provider_id"),
        status.otherwise("firing").alias("status"),
        severity.alias("severity"),
        F.col("ts").cast("timestamp").alias("ts"),
        k.cast("int").alias("k"),
        F.create_map(F.lit("k"), k, F.lit("user"), user.cast("string")).alias("labels"),
        user.alias("user_id"),
        F.col("event_type"),
        F.col("value"),
        F.col("props"),
    )
    return base.withColumn(
        "content_hash", F.sha2(F.concat_ws("|", "name", "severity", "status"), 256)
    )


def line_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts derived from ``lineitem``: one fingerprint per part inside a tenant."""
    line = read_table(spark, folder, "lineitem")
    status = (
        F.when(F.col("l_linestatus") == "F", "resolved")
        .when(F.col("l_returnflag") == "A", "acknowledged")
        .otherwise("firing")
    )
    rank = F.least(F.lit(5), F.floor(F.col("l_quantity") / 10) + 1).cast("int")
    return line.select(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").cast("long"),
            F.date_format("l_shipdate", "yyyyMMdd"),
        ).alias("alert_id"),
        F.concat(F.lit("t"), F.col("l_orderkey") % 3).alias("tenant_id"),
        F.concat(F.lit("part-"), "l_partkey").alias("fingerprint"),
        status.alias("status"),
        rank.alias("severity_rank"),
        F.concat(F.lit("svc-"), F.col("l_suppkey") % 25).alias("service"),
        F.concat(F.lit("src-"), F.col("l_linenumber") % 4).alias("source"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_quantity").cast("long") % 7).alias("unresolved_counter"),
    )


def links(spark: SparkSession, folder: str) -> DataFrame:
    """Alert to incident links derived from ``lineitem``; returned lines are unlinked."""
    line = read_table(spark, folder, "lineitem")
    return line.select(
        F.col("l_orderkey").alias("incident_id"),
        F.concat(F.lit("t"), F.col("l_orderkey") % 3).alias("tenant_id"),
        F.concat(F.lit("part-"), "l_partkey").alias("fingerprint"),
        F.col("l_shipdate").cast("timestamp").alias("linked_at"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("timestamp")).alias(
            "deleted_at"
        ),
    )


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Incidents derived from ``orders``."""
    state = F.col("o_orderstatus")
    key = F.col("o_orderkey")
    priority = F.col("o_orderpriority")
    return read_table(spark, folder, "orders").select(
        key.alias("incident_id"),
        F.concat(F.lit("t"), key % 3).alias("tenant_id"),
        F.when(key % 5 != 0, F.concat(F.lit("inc-"), priority)).alias("user_generated_name"),
        F.concat(F.lit("ai-"), priority).alias("ai_generated_name"),
        F.when(state == "F", "resolved")
        .when(state == "P", "acknowledged")
        .otherwise("firing")
        .alias("status"),
        F.substring(priority, 1, 1).cast("int").alias("severity"),
        F.col("o_orderdate").cast("timestamp").alias("creation_time"),
        F.when(
            key % 11 != 0, F.col("o_orderdate").cast("timestamp")
        ).alias("start_time"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(days=key % 30)).alias(
            "last_seen_time"
        ),
        (key % 4 == 0).alias("is_predicted"),
        (key % 10 == 0).alias("is_candidate"),
        (key % 13 != 0).alias("is_visible"),
        (key % 3 == 0).alias("forced_severity"),
        (key % 6).alias("rule_id"),
        F.when(key % 8 == 0, key - 8).alias("same_incident_in_the_past_id"),
        F.concat(F.lit("user-"), F.col("o_custkey") % 10).alias("assignee"),
        F.element_at(
            F.array(
                F.lit("all_resolved"),
                F.lit("first_resolved"),
                F.lit("last_resolved"),
                F.lit("never"),
            ),
            (key % 4 + 1).cast("int"),
        ).alias("resolve_on"),
        F.array(
            F.concat(F.lit("svc-"), F.col("o_custkey") % 25), F.lit("svc-0")
        ).alias("affected_services"),
        F.array(F.concat(F.lit("src-"), key % 4)).alias("sources"),
    )


def enrichments(spark: SparkSession, folder: str) -> DataFrame:
    """Enrichment maps for line alerts, derived from ``part``; most are empty."""
    key = F.col("p_partkey")
    status = F.when(key % 2 == 0, F.lit("resolved")).otherwise(F.lit("acknowledged"))
    values = F.map_from_arrays(
        F.array(F.lit("status"), F.lit("note"), F.lit("disposable_status")),
        F.array(status, F.concat(F.lit(" "), "p_brand", F.lit(" ")), status),
    )
    return read_table(spark, folder, "part").select(
        F.concat(F.lit("t"), key % 3).alias("tenant_id"),
        F.concat(F.lit("part-"), key).alias("fingerprint"),
        F.map_filter(values, lambda key_, value_: key % 5 == 0).alias("enrichments"),
    )
