"""Noise, coverage and field reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertweave.operators.scan import ALERT_KEY

MICROS = 1_000_000


def close_pairs(alerts: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """Per key, the number of alert pairs at most ``gap_seconds`` apart.

    Alerts are first counted per (key, time). A pair lies in one time slice of the gap's
    length or in two neighbouring ones, so each slice is a group of its own with the slice
    before it borrowed, and a hot key spreads over its slices.
    """
    gap = gap_seconds * MICROS
    at = F.unix_micros("ts")
    counted = (
        alerts.groupBy(*ALERT_KEY, "ts")
        .agg(F.count(F.lit(1)).alias("m"))
        .withColumns({"at": at, "slice": F.floor(at / gap)})
    )
    own = F.struct(F.col("slice").alias("slice"), F.lit(True).alias("own"))
    lent = F.struct((F.col("slice") + 1).alias("slice"), F.lit(False).alias("own"))
    spread = counted.select(*ALERT_KEY, "m", "at", F.explode(F.array(own, lent)).alias("_s"))
    spread = spread.select(*ALERT_KEY, "m", "at", "_s.slice", "_s.own")
    w = Window.partitionBy(*ALERT_KEY, "slice").orderBy("at").rangeBetween(-gap, 0)
    before = F.sum("m").over(w) - F.col("m")
    m = F.col("m")
    paired = spread.withColumn("pairs", m * before + (m * (m - 1) / 2).cast("long"))
    return (
        paired.filter("own").groupBy(*ALERT_KEY).agg(F.sum("pairs").alias("pairs"))
    )


def spammy_alerts(
    alerts: DataFrame, gap_seconds: int = 3600, min_pairs: int = 3
) -> DataFrame:
    """Hourly histogram per tenant of the alerts of keys with at least ``min_pairs`` close
    pairs."""
    noisy = close_pairs(alerts, gap_seconds).filter(F.col("pairs") >= min_pairs)
    hourly = alerts.groupBy(*ALERT_KEY, F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        hourly.join(noisy, list(ALERT_KEY), "left_semi")
        .groupBy("tenant_id", "hour")
        .agg(F.sum("n").alias("n"))
    )


def field_catalog(alerts: DataFrame, payload: str = "event") -> DataFrame:
    """Every field of the payloads per tenant: top-level names, and ``outer.inner`` for
    objects; with the provider that sent it last."""
    spark = alerts.sparkSession
    own = ["tenant_id", "ts", "provider_type", "provider_id"]
    narrow = alerts.select(*own, F.try_parse_json(F.col(payload)).alias("_v"))
    top = narrow.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select(
        *own, F.col("key").alias("outer_key"), F.col("value").alias("_inner")
    )
    is_object = F.schema_of_variant("_inner").startswith("OBJECT")
    plain = top.filter(~is_object).withColumn("field", F.col("outer_key"))
    nested = (
        top.filter(is_object)
        .lateralJoin(spark.tvf.variant_explode(F.col("_inner").outer()))
        .withColumn("field", F.concat_ws(".", "outer_key", "key"))
    )
    cols = ["tenant_id", "field", "ts", "provider_type", "provider_id"]
    fields = plain.select(*cols).unionByName(nested.select(*cols))
    at = F.struct("ts", "provider_type", "provider_id")
    return (
        fields.groupBy("tenant_id", "field")
        .agg(F.max(at).alias("_l"))
        .select("tenant_id", "field", "_l.provider_type", "_l.provider_id")
    )


def fields_per_provider(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("tenant_id", "provider_type", "provider_id").agg(
        F.array_sort(F.collect_set("field")).alias("fields")
    )


def topology_coverage(services: DataFrame, alerts: DataFrame) -> DataFrame:
    """Services with a flag: has any alert."""
    seen = alerts.select("tenant_id", "service").distinct().withColumn("covered", F.lit(True))
    return services.join(seen, ["tenant_id", "service"], "left").withColumn(
        "covered", F.coalesce("covered", F.lit(False))
    )


def rule_usage(alerts: DataFrame, patterns: dict[str, str], text: str) -> DataFrame:
    """Alerts whose text each alerting rule's pattern matches, and whether the rule is
    used, in one pass and one small row per rule."""
    hits = [F.count_if(F.col(text).rlike(p)).alias(n) for n, p in patterns.items()]
    counts = alerts.agg(*hits)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("n")) for n in patterns]
    )
    return counts.select(F.explode(pairs).alias("_r")).select(
        "_r.rule", "_r.n", (F.col("_r.n") > 0).alias("used")
    )


def rule_usage_totals(usage: DataFrame) -> DataFrame:
    return usage.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("used").alias("used"),
        F.count_if(~F.col("used")).alias("unused"),
    )


def pipeline_counters(events: DataFrame) -> DataFrame:
    """Events in, out and in error per tenant."""
    return events.groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("events_in"),
        F.count_if(~F.col("is_error")).alias("events_out"),
        F.count_if("is_error").alias("events_error"),
    )
