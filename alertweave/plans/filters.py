"""Predicates and field maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertweave.functions import paths
from alertweave.functions import predicates as p
from alertweave.operators import reads
from alertweave.plans.registry import query
from alertweave.plans.sql import ALERTS, INCIDENTS, RANKED
from alertweave.sources import tables

TEXTS = """texts AS (SELECT event_id, CASE event_id % 11 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false'
  WHEN 2 THEN '0' WHEN 3 THEN '1' WHEN 4 THEN '.5' WHEN 5 THEN '-2' WHEN 6 THEN '' WHEN 7
  THEN 'on' WHEN 8 THEN CAST(value AS VARCHAR) WHEN 9 THEN NULL ELSE event_type END AS t,
  value FROM events)"""


def texts(spark, folder):
    kind = F.col("event_id") % 11
    fixed = ["TRUE", "false", "0", "1", ".5", "-2", "", "on"]
    t = F.when(kind == 8, F.col("value").cast("string")).when(kind == 10, F.col("event_type"))
    for i, word in enumerate(fixed):
        t = F.when(kind == i, F.lit(word)).otherwise(t)
    return tables.read_table(spark, folder, "events").select("event_id", t.alias("t"), "value")


@query(
    "p1_and_or_not",
    f"""WITH {ALERTS} SELECT alert_id FROM alerts
WHERE (status = 'firing' AND NOT (severity = 'low')) OR provider_id = 'p-1'""",
)
def logic(spark, folder):
    test = p.or_(
        p.and_(
            p.cmp(F.col("status"), "=", "firing"),
            p.not_(p.cmp(F.col("severity"), "=", "low")),
        ),
        p.cmp(F.col("provider_id"), "=", "p-1"),
    )
    return reads.filter_alerts(tables.alerts(spark, folder), test).select("alert_id")


@query(
    "p2_compare",
    f"""WITH {ALERTS} SELECT alert_id, provider_id IS NULL AS is_null,
  provider_id IS NOT NULL AS not_null, value > 10 AS gt, value >= 10 AS ge, value < 10 AS lt,
  value <= 10 AS le, provider_id <> 'p-1' AS ne, CAST(k AS DOUBLE) > 50 AS json_gt,
  CAST(k AS VARCHAR) = '50' AS json_text_eq FROM alerts""",
)
def compare(spark, folder):
    pid, value, k = F.col("provider_id"), F.col("value"), F.col("labels")["k"]
    return tables.alerts(spark, folder).select(
        "alert_id",
        p.cmp(pid, "=", None).alias("is_null"),
        p.cmp(pid, "!=", None).alias("not_null"),
        p.cmp(value, ">", 10).alias("gt"),
        p.cmp(value, ">=", 10).alias("ge"),
        p.cmp(value, "<", 10).alias("lt"),
        p.cmp(value, "<=", 10).alias("le"),
        p.cmp(pid, "!=", "p-1").alias("ne"),
        p.cmp(k, ">", 50, text=True).alias("json_gt"),
        p.cmp(k, "=", "50", text=True).alias("json_text_eq"),
    )


@query(
    "p3_in_list",
    f"""WITH {ALERTS} SELECT alert_id, severity IN ('high', 'critical') AS plain,
  provider_id IN ('p-1') OR provider_id IS NULL AS with_null,
  CAST(k AS VARCHAR) IN ('1', '2', 'x') AS mixed, provider_id IS NULL AS only_null,
  false AS empty FROM alerts""",
)
def in_list(spark, folder):
    return tables.alerts(spark, folder).select(
        "alert_id",
        p.in_list(F.col("severity"), ["high", "critical"]).alias("plain"),
        p.in_list(F.col("provider_id"), ["p-1", None]).alias("with_null"),
        p.in_list(F.col("k"), [1, 2, "x"]).alias("mixed"),
        p.in_list(F.col("provider_id"), [None]).alias("only_null"),
        p.in_list(F.col("provider_id"), []).alias("empty"),
    )


ARRAYS = """arrays AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1
  THEN CAST([] AS VARCHAR[]) WHEN 2 THEN [event_type, NULL] ELSE [event_type, 'all'] END AS a
  FROM events)"""


def arrays(spark, folder):
    kind = F.col("event_id") % 5
    a = (
        F.when(kind == 1, F.array().cast("array<string>"))
        .when(kind == 2, F.array(F.col("event_type"), F.lit(None)))
        .when(kind > 2, F.array(F.col("event_type"), F.lit("all")))
    )
    return tables.read_table(spark, folder, "events").select("event_id", a.alias("a"))


@query(
    "p4_array_has",
    f"""WITH {ARRAYS} SELECT event_id FROM arrays WHERE list_contains(a, 'click')
UNION ALL SELECT -event_id FROM arrays WHERE a IS NULL OR len(a) = 0 OR event_id % 5 = 2""",
)
def array_has(spark, folder):
    df, a = arrays(spark, folder), F.col("a")
    return df.filter(p.array_has(a, "click")).select("event_id").unionByName(
        df.filter(p.array_has(a, None)).select((-F.col("event_id")).alias("event_id"))
    )


@query(
    "p5_array_has_any",
    f"""WITH {ARRAYS} SELECT event_id FROM arrays
WHERE list_has_any(a, ['click', 'view'])
UNION ALL SELECT -event_id FROM arrays WHERE list_contains(a, 'error') OR a IS NULL
  OR len(a) = 0 OR event_id % 5 = 2""",
)
def array_has_any(spark, folder):
    df, a = arrays(spark, folder), F.col("a")
    return df.filter(p.array_has_any(a, ["click", "view"])).select("event_id").unionByName(
        df.filter(p.array_has_any(a, ["error", None])).select(
            (-F.col("event_id")).alias("event_id")
        )
    )


@query(
    "p6_text_tests",
    """SELECT doc_id, contains(lower(text), 'the ') AS contains_ci,
  contains(text, 'The ') AS contains_cs, starts_with(lower(text), 'a') AS starts,
  ends_with(lower(text), '.') AS ends, contains(text, '100%') AS percent_literal,
  contains(lower(text), 'a_b') AS underscore_literal FROM documents""",
)
def text_tests(spark, folder):
    t = F.col("text")
    return tables.read_table(spark, folder, "documents").select(
        "doc_id",
        p.contains(t, "THE ").alias("contains_ci"),
        p.contains(t, "The ", ci=False).alias("contains_cs"),
        p.starts_with(t, "A").alias("starts"),
        p.ends_with(t, ".").alias("ends"),
        p.contains(t, "100%").alias("percent_literal"),
        p.contains(t, "a_b").alias("underscore_literal"),
    )


FIELDS = paths.FieldMap(
    {
        "severity": [paths.Plain("severity")],
        "title": [paths.Plain("given_name"), paths.Plain("name")],
        "status": [paths.MapKey("enr", "status"), paths.Plain("status")],
        "alert.*": [paths.MapKey("enr"), paths.Json("props")],
    }
)


def mapped_alerts(spark, folder):
    k = F.col("k")
    overlay = F.create_map(F.lit("status"), F.when(k % 3 == 0, "suppressed"))
    return tables.alerts(spark, folder).withColumns(
        {
            "given_name": F.when(k % 2 == 0, F.concat(F.lit("given-"), "k")),
            "enr": F.when(k % 2 == 0, F.map_filter(overlay, lambda _, v: v.isNotNull())),
        }
    )


@query(
    "p7_has",
    """SELECT event_id, true AS plain, false AS unmapped, true AS json_key,
  false AS missing_key, coalesce(k % 6 = 0, false) AS map_key
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
)
def has(spark, folder):
    return mapped_alerts(spark, folder).select(
        F.col("alert_id").alias("event_id"),
        FIELDS.has("severity").alias("plain"),
        FIELDS.has("nope").alias("unmapped"),
        FIELDS.has("alert.k").alias("json_key"),
        FIELDS.has("alert.z").alias("missing_key"),
        FIELDS.has("alert.status").alias("map_key"),
    )


@query(
    "p8_truthy",
    f"""WITH {TEXTS} SELECT event_id FROM texts
WHERE t IS NOT NULL AND t <> '0' AND lower(t) <> 'false' AND t <> ''""",
)
def truthy(spark, folder):
    return texts(spark, folder).filter(p.truthy(F.col("t"))).select("event_id")


@query(
    "p9_to_bool",
    f"""WITH {TEXTS} SELECT event_id, CASE WHEN lower(t) = 'true' THEN true
  WHEN lower(t) = 'false' THEN false
  WHEN regexp_full_match(t, '[-+]?[0-9]*\\.?[0-9]+') THEN CAST(t AS DOUBLE) >= 1
  WHEN t <> '' THEN true ELSE false END AS b FROM texts""",
)
def to_bool(spark, folder):
    return texts(spark, folder).select("event_id", p.to_bool(F.col("t")).alias("b"))


@query(
    "p10_casts",
    f"""WITH {TEXTS} SELECT event_id, TRY_CAST(t AS DOUBLE) AS number,
  TRY_CAST(e.ts AS TIMESTAMP) AS ts,
  lower(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
    substr(h, 17, 4) || '-' || substr(h, 21, 12)) AS uuid, CAST(NULL AS VARCHAR) AS no_uuid
FROM texts JOIN (SELECT event_id, ts, md5(CAST(event_id AS VARCHAR)) AS h FROM events) e
USING (event_id)""",
)
def casts(spark, folder):
    key = F.col("event_id").cast("string")
    times = tables.read_table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("string").alias("ts_text")
    )
    return texts(spark, folder).join(times, "event_id").select(
        "event_id",
        p.to_number(F.col("t")).alias("number"),
        p.to_ts(F.col("ts_text")).alias("ts"),
        p.to_uuid(F.upper(F.md5(key))).alias("uuid"),
        p.to_uuid(F.concat(F.lit("x"), key)).alias("no_uuid"),
    )


@query(
    "p11_literals",
    """SELECT event_id, ts >= TIMESTAMP '2024-01-15 10:00:00' AS after_iso,
  CAST(user_id AS VARCHAR) = '46' AS numeric_text, 'it''s' AS unescaped, value > 5 AS number
FROM events""",
)
def literals(spark, folder):
    return tables.read_table(spark, folder, "events").select(
        "event_id",
        (F.col("ts").cast("timestamp") >= p.literal("2024-01-15T10:00:00Z")).alias("after_iso"),
        (F.col("user_id").cast("string") == p.literal("46")).alias("numeric_text"),
        p.literal("it\\'s").alias("unescaped"),
        (F.col("value") > p.literal(5)).alias("number"),
    )


@query(
    "p12_json_text",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing FROM events",
)
def json_text(spark, folder):
    return tables.read_table(spark, folder, "events").select(
        "event_id",
        paths.json_text(F.col("props"), "k").alias("k"),
        paths.json_text(F.col("props"), "a.b").alias("missing"),
    )


@query(
    "p13_field_map",
    f"""WITH {ALERTS} SELECT alert_id,
  CASE WHEN k % 2 = 0 THEN concat('given-', k) ELSE name END AS title,
  CASE WHEN k % 6 = 0 THEN 'suppressed' ELSE status END AS status,
  CAST(k AS VARCHAR) AS wildcard FROM alerts""",
)
def field_map(spark, folder):
    return mapped_alerts(spark, folder).select(
        "alert_id",
        FIELDS.resolve("title").alias("title"),
        FIELDS.resolve("status").alias("status"),
        FIELDS.resolve("alert.k").alias("wildcard"),
    )


@query(
    "p14_enum_compare",
    f"""WITH {RANKED} SELECT alert_id, severity_rank > 3 AS gt, severity_rank >= 3 AS ge,
  severity_rank < 3 AS lt, severity_rank <= 3 AS le, true AS le_last, false AS gt_last,
  true AS gt_unknown, false AS lt_unknown FROM ranked""",
)
def enum_compare(spark, folder):
    order = ["low", "info", "warning", "high", "critical"]
    s = F.col("severity")
    cases = {
        "gt": (">", "warning"),
        "ge": (">=", "warning"),
        "lt": ("<", "warning"),
        "le": ("<=", "warning"),
        "le_last": ("<=", "critical"),
        "gt_last": (">", "critical"),
        "gt_unknown": (">", "fatal"),
        "lt_unknown": ("<", "fatal"),
    }
    return tables.alerts(spark, folder).select(
        "alert_id", *[p.enum_cmp(s, op, v, order).alias(n) for n, (op, v) in cases.items()]
    )


@query(
    "p15_severity_compare",
    f"WITH {RANKED} SELECT alert_id FROM ranked WHERE severity_rank >= 4",
)
def severity_compare(spark, folder):
    test = p.severity_cmp(F.col("severity"), ">=", "high")
    return reads.filter_alerts(tables.alerts(spark, folder), test).select("alert_id")


@query(
    "p16_filter_alerts",
    f"""WITH {ALERTS} SELECT alert_id, 'stored' AS preset FROM alerts
  WHERE status = 'firing' AND k > 50
UNION ALL SELECT alert_id, 'empty' FROM alerts
UNION ALL SELECT alert_id, 'null_field' FROM alerts WHERE provider_id = 'p-2'""",
)
def filter_alerts(spark, folder):
    alerts = tables.alerts(spark, folder)
    stored = {
        "stored": "status = 'firing' and labels['k'] > 50",
        "empty": "",
        "null_field": "provider_id = 'p-2'",
        "missing_key": "labels['nope'] = 'x'",
    }
    parts = [
        reads.filter_alerts(alerts, test).select("alert_id", F.lit(n).alias("preset"))
        for n, test in stored.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "p17_loose_equality",
    f"""WITH {ALERTS} SELECT alert_id, CAST(k AS VARCHAR) = CAST(user_id AS VARCHAR) AS eq,
  CAST(k AS VARCHAR) <> CAST(user_id AS VARCHAR) AS ne FROM alerts""",
)
def loose_equality(spark, folder):
    text, number = F.col("labels")["k"], F.col("user_id")
    return tables.alerts(spark, folder).select(
        "alert_id",
        p.loose_eq(text, number).alias("eq"),
        p.loose_ne(text, number).alias("ne"),
    )


@query(
    "p18_unknown_field_selects_nothing",
    f"""WITH {ALERTS} SELECT 'known' AS field, count(*) AS n FROM alerts WHERE severity = 'high'
UNION ALL SELECT 'unknown', 0""",
)
def unknown_field(spark, folder):
    df = mapped_alerts(spark, folder)
    return df.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("known").alias("field"),
                    FIELDS.where("severity", lambda c: c == "high").alias("hit"),
                ),
                F.struct(
                    F.lit("unknown").alias("field"),
                    FIELDS.where("nope", lambda c: c == "high").alias("hit"),
                ),
            )
        ).alias("t")
    ).groupBy("t.field").agg(F.count_if("t.hit").alias("n"))


@query(
    "p19_arithmetic",
    f"""WITH {ALERTS} SELECT alert_id FROM alerts
WHERE (k + 1) * 2 % 7 = 3 AND CASE WHEN value > 50 THEN -k < -10 ELSE k / 2.0 > 20 END""",
)
def arithmetic(spark, folder):
    test = (
        "(k + 1) * 2 % 7 = 3 and if(value > 50, -k < -10, k / 2.0 > 20) "
        "and array(k)[0] = k"
    )
    return reads.filter_alerts(tables.alerts(spark, folder), test).select("alert_id")


AS_OF = "2000-01-01 00:00:00"


@query(
    "p20_time_filter",
    f"""WITH {INCIDENTS} SELECT incident_id, 'days' AS kind FROM incidents
  WHERE start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY
UNION ALL SELECT incident_id, 'between' FROM incidents WHERE last_seen_time BETWEEN
  TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
UNION ALL SELECT incident_id, 'lower' FROM incidents
  WHERE last_seen_time >= TIMESTAMP '1998-01-01'
UNION ALL SELECT incident_id, 'upper' FROM incidents
  WHERE last_seen_time <= TIMESTAMP '1993-01-01'""",
)
def time_filter(spark, folder):
    def ts(text):
        return F.lit(text).cast("timestamp")

    kinds = {
        "days": {"days": 365},
        "between": {"lower": ts("1996-01-01"), "upper": ts("1996-12-31")},
        "lower": {"lower": ts("1998-01-01")},
        "upper": {"upper": ts("1993-01-01")},
    }
    cols = (F.col("start_time"), F.col("last_seen_time"), ts(AS_OF))
    hits = F.array_compact(
        F.array(*[F.when(p.time_filter(*cols, **kw), F.lit(n)) for n, kw in kinds.items()])
    )
    return tables.incidents(spark, folder).select(
        "incident_id", F.explode(hits).alias("kind")
    )


@query(
    "p21_restrict",
    f"""WITH {INCIDENTS} SELECT incident_id FROM incidents
WHERE NOT is_candidate AND is_predicted AND is_visible
  AND incident_id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)""",
)
def restrict(spark, folder):
    line = tables.read_table(spark, folder, "lineitem")
    allowed = line.filter("l_quantity > 45").select(F.col("l_orderkey").alias("incident_id"))
    return reads.restrict(
        tables.incidents(spark, folder), candidate=False, predicted=True, ids=allowed
    ).select("incident_id")
