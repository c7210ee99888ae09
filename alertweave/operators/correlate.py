"""Correlation rules: alerts to incidents, with a gap in event time as the timeout."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.functions import paths
from alertweave.functions.predicates import attach_tests
from alertweave.functions.scalars import literal_map
from alertweave.operators.scan import (
    MAX_ROWS,
    Scan,
    lag_struct,
    run_scans,
    running_sum,
)

# fixed values
NO_KEY = "none"
MISSING = "N/A"
ANY, ALL = "any", "all"
NEVER = "never"
VARIABLE = re.compile(r"\{\{\s*([^}]+?)\s*\}\}")
INCIDENT_KEY = ("tenant_id", "rule_id", "group_key")


@dataclass(frozen=True)
class CorrelationRule:
    rule_id: str
    tenant_id: str
    name: str
    predicates: tuple[str, ...]
    timeframe_s: int
    group_by: tuple[str, ...] = ()
    threshold: int = 1
    create_on: str = ANY
    require_approve: bool = False
    resolve_on: str = NEVER
    name_template: str | None = None
    prefix: str | None = None
    multi_level: bool = False
    multi_level_property: str | None = None
    assignee: str | None = None
    is_deleted: bool = False


def active_rules(rules: list[CorrelationRule]) -> list[CorrelationRule]:
    return [r for r in rules if not r.is_deleted]


def rule_value(rules: list[CorrelationRule], value, type_: str) -> Column:
    """A property of the row's rule, from a literal map of the rules."""
    pairs = {r.rule_id: value(r) for r in active_rules(rules) if value(r) is not None}
    if not pairs:
        return F.lit(None).cast(type_)
    return F.try_element_at(literal_map(pairs), F.col("rule_id")).cast(type_)


def match_rules(alerts: DataFrame, rules: list[CorrelationRule]) -> DataFrame:
    """One row per alert and matching rule, with the numbers of the matched sub-rules.

    All predicates are compiled into one projection over one scan of the alerts. A
    predicate that fails, or on a missing field, does not match and leaves the others be.
    """
    rows, tests = attach_tests(alerts, [p for r in active_rules(rules) for p in r.predicates])
    hits = []
    for rule in active_rules(rules):
        subs = F.array_compact(
            F.array(*[F.when(tests[p], F.lit(i)) for i, p in enumerate(rule.predicates)])
        )
        applies = (F.col("tenant_id") == rule.tenant_id) & (F.size(subs) > 0)
        hits.append(
            F.when(
                applies, F.struct(F.lit(rule.rule_id).alias("rule_id"), subs.alias("matched"))
            )
        )
    found = F.explode(F.array_compact(F.array(*hits))).alias("_hit")
    return rows.select("*", found).select(*alerts.columns, "_hit.rule_id", "_hit.matched")


def _group_value(df: DataFrame, path: str) -> Column:
    head, *rest = paths.split_path(path)
    types = {f.name: f.dataType for f in df.schema}
    if head not in types:
        return F.lit(None).cast("string")
    if isinstance(types[head], T.ArrayType):
        return F.array_join(F.col(head), ",")
    if not rest:
        return F.col(head).cast("string")
    if isinstance(types[head], T.MapType):
        return F.try_element_at(F.col(head), F.lit(rest[0])).cast("string")
    return F.get_json_object(F.col(head), paths.json_path(rest))


def _multi_level_keys(df: DataFrame, rule: CorrelationRule) -> Column:
    """The distinct values of one property below each entry of a nested map."""
    head, *rest = paths.split_path(rule.group_by[0])
    if head not in df.columns:
        return F.array(F.lit(NO_KEY))
    value = F.col(head)
    if rest:
        value = F.get_json_object(value, paths.json_path(rest))
    nested = F.from_json(value, "map<string,map<string,string>>")
    picked = F.transform(
        F.map_values(nested),
        lambda entry_: F.try_element_at(entry_, F.lit(rule.multi_level_property)),
    )
    keys = F.array_distinct(F.array_compact(picked))
    return F.when(nested.isNull(), F.array(F.lit(NO_KEY))).otherwise(keys)


def group_key(matches: DataFrame, rules: list[CorrelationRule]) -> DataFrame:
    """Add ``group_key``: the grouping fields joined with a comma, ``none`` when there are
    none or one is null. A multi-level rule gives one row per nested value."""
    keys = F.array(F.lit(NO_KEY))
    for rule in active_rules(rules):
        if not rule.group_by:
            continue
        if rule.multi_level:
            own = _multi_level_keys(matches, rule)
        else:
            values = [_group_value(matches, p) for p in rule.group_by]
            complete = F.concat(*values).isNotNull()
            joined = F.when(complete, F.concat_ws(",", *values)).otherwise(F.lit(NO_KEY))
            own = F.array(joined)
        keys = F.when(F.col("rule_id") == rule.rule_id, own).otherwise(keys)
    return matches.withColumn("group_key", F.explode(keys))


def _session_scan() -> Scan:
    """Session number of each row, and whether a firing row opened that session by then.

    A slot's first row meets the last row of the slot before it at the summary level,
    so gaps across slots need no second pass.
    """
    firing = F.coalesce(F.col("status") == "firing", F.lit(False))
    limit = F.col("timeframe_s").cast("long") * 1_000_000

    def broken(later: Column, earlier: Column) -> Column:
        gap = F.unix_micros(later) - F.unix_micros(earlier)
        return F.coalesce((gap > limit).cast("int"), F.lit(0))

    def slot_broken() -> Column:
        gap = F.unix_micros("_s_from") - F.unix_micros("_s_prev")
        return F.coalesce((gap > F.col("_s_limit")).cast("int"), F.lit(0))

    base = F.coalesce("_s_base", F.lit(0))
    return Scan(
        local=lambda w, run: [
            {"_s_lag": F.lag("ts").over(w)},
            {"_s_brk": broken(F.col("ts"), F.col("_s_lag"))},
            {"_s_no": F.sum("_s_brk").over(run)},
            # session numbers grow, so the newest firing one is the largest
            {"_s_fire": F.max(F.when(firing, F.col("_s_no"))).over(run)},
        ],
        summary={
            "_s_from": F.min("ts"),
            "_s_to": F.max("ts"),
            "_s_limit": F.max(limit),
            "_s_brks": F.sum("_s_brk"),
            "_s_last": F.max("_s_fire"),
        },
        carry=lambda w, prior: [
            {"_s_prev": F.lag("_s_to").over(w)},
            {"_s_first": slot_broken()},
            {
                "_s_base": F.coalesce(
                    F.sum(F.col("_s_first") + F.col("_s_brks")).over(prior), F.lit(0)
                )
                + F.col("_s_first")
            },
            {"_s_open": F.max(F.col("_s_base") + F.col("_s_last")).over(prior)},
        ],
        final={
            "session_no": base + F.col("_s_no"),
            "opened": F.coalesce(
                F.greatest(base + F.col("_s_fire"), F.col("_s_open")) == base + F.col("_s_no"),
                F.lit(False),
            ),
        },
        carried=("_s_base", "_s_open"),
    )


def session_rows(
    keyed: DataFrame, rules: list[CorrelationRule], max_rows: int = MAX_ROWS
) -> DataFrame:
    """All rows with their session number and whether their incident is open by then."""
    timed = keyed.withColumn("timeframe_s", rule_value(rules, lambda r: r.timeframe_s, "int"))
    return run_scans(timed, [_session_scan()], keys=INCIDENT_KEY, max_rows=max_rows)


def opened_rows(rows: DataFrame) -> DataFrame:
    incident = F.concat_ws("/", *INCIDENT_KEY, F.col("session_no").cast("string"))
    return rows.filter("opened").drop("opened").withColumn("incident_id", incident)


def sessionize(
    keyed: DataFrame, rules: list[CorrelationRule], max_rows: int = MAX_ROWS
) -> DataFrame:
    """Alerts of an incident: sessions per (tenant, rule, key) that end when no alert came
    for longer than the rule's timeframe, without the rows before the first firing one.

    Exact for rules that resolve ``never``: a resolved incident ends its session early.
    """
    return opened_rows(session_rows(keyed, rules, max_rows))


def link_alerts(sessions: DataFrame) -> DataFrame:
    """One edge per incident and alert key, since its first alert."""
    return sessions.groupBy("incident_id", "tenant_id", "fingerprint").agg(
        F.min("ts").alias("linked_at")
    )


def session_incidents(sessions: DataFrame) -> DataFrame:
    """One row per incident: rule, key, first and last alert, counts, severity."""
    return sessions.groupBy("incident_id", *INCIDENT_KEY, "session_no").agg(
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n_events"),
        F.max("severity_rank").alias("severity_rank"),
    )


def past_incident_chain(incidents: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Add the previous incident of the same rule and key."""
    order = ("start_ts", "incident_id")
    scan = lag_struct("_past", {"id": F.col("incident_id")}, order)
    out = run_scans(
        incidents, [scan], keys=INCIDENT_KEY, order=order, max_rows=max_rows
    )
    return out.withColumn("past_incident_id", F.col("_past.id")).drop("_past")


def gate_visibility(
    sessions: DataFrame, rules: list[CorrelationRule], max_rows: int = MAX_ROWS
) -> DataFrame:
    """``visible_since`` per incident: the first alert at which max(linked keys, sum of
    their newest unresolved counters) reaches the threshold, if the rule needs no approval
    and creates on any match, or that alert matched all sub-rules.

    Each alert contributes the change it makes, so both totals are running sums.
    """
    seen = run_scans(
        sessions,
        [lag_struct("_seen", {"u": F.col("unresolved_counter")})],
        keys=("incident_id", "fingerprint"),
        max_rows=max_rows,
    )
    seen = seen.withColumns(
        {
            "_new": F.col("_seen").isNull().cast("int"),
            "_delta": F.col("unresolved_counter") - F.coalesce(F.col("_seen.u"), F.lit(0)),
        }
    )
    totals = run_scans(
        seen,
        [running_sum("_keys", F.col("_new")), running_sum("_open", F.col("_delta"))],
        keys=("incident_id",),
        max_rows=max_rows,
    )
    enough = F.greatest("_keys", "_open") >= rule_value(rules, lambda r: r.threshold, "int")
    direct = rule_value(rules, lambda r: r.create_on == ANY, "boolean")
    subs = rule_value(rules, lambda r: len(r.predicates), "int")
    free = ~rule_value(rules, lambda r: r.require_approve, "boolean")
    open_now = enough & free & (direct | (F.size("matched") == subs))
    return totals.groupBy("incident_id").agg(
        F.min(F.when(open_now, F.col("ts"))).alias("visible_since"),
        F.max(F.greatest("_keys", "_open")).alias("max_alerts"),
    )


def gate_all_history(sessions: DataFrame, rules: list[CorrelationRule]) -> DataFrame:
    """For rules that need all sub-rules: whether the newest alerts of the linked keys
    together match every sub-rule and all are firing."""
    newest = sessions.groupBy("incident_id", "rule_id", "tenant_id", "fingerprint").agg(
        F.max_by(F.struct("status", "matched"), F.struct("ts", "alert_id")).alias("_n")
    )
    # a row per matched sub-rule, so that a rule may have any number of them
    matched = newest.select(
        "incident_id",
        "rule_id",
        F.col("_n.status").alias("_status"),
        F.explode_outer("_n.matched").alias("_sub"),
    )
    grouped = matched.groupBy("incident_id", "rule_id").agg(
        F.count_distinct("_sub").alias("_subs"),
        F.bool_and(F.col("_status") == "firing").alias("all_firing"),
    )
    every = rule_value(rules, lambda r: len(r.predicates), "long")
    wants = rule_value(rules, lambda r: r.create_on == ALL, "boolean")
    return grouped.filter(wants).select(
        "incident_id",
        "all_firing",
        (F.col("_subs") == every).alias("all_matched"),
        ((F.col("_subs") == every) & F.col("all_firing")).alias("conditions_met"),
    )


def block_reopen(alerts: DataFrame) -> DataFrame:
    """Alerts that may open an incident: not those recovered from maintenance whose key was
    resolved later."""
    resolved = (
        alerts.filter("status = 'resolved'")
        .groupBy("tenant_id", "fingerprint")
        .agg(F.max("ts").alias("_resolved"))
    )
    recovered = F.coalesce(F.col("previous_status") == "maintenance", F.lit(False))
    late = F.coalesce(F.col("_resolved") > F.col("ts"), F.lit(False))
    joined = alerts.join(resolved, ["tenant_id", "fingerprint"], "left")
    return joined.filter(~(recovered & late)).drop("_resolved")


def template_variables(template: str) -> list[str]:
    return list(dict.fromkeys(VARIABLE.findall(template)))


def name_incidents(
    sessions: DataFrame, incidents: DataFrame, rules: list[CorrelationRule]
) -> DataFrame:
    """Incident names: the rule's name, or its template with the distinct values of all
    alerts in order of appearance; a value shows under its first variable only. Multi-level
    rules put the key in front, a prefix puts the running number there.

    Values are made distinct per incident before they are collected.
    """
    templated = [r for r in active_rules(rules) if r.name_template]
    named = incidents.withColumn("_rule_name", rule_value(rules, lambda r: r.name, "string"))
    text = F.col("_rule_name")
    if templated:
        values = F.lit(None)
        for rule in templated:
            pairs = [
                F.struct(
                    F.lit(i).alias("var"),
                    F.coalesce(
                        _group_value(sessions, v.removeprefix("alert.")), F.lit(MISSING)
                    ).alias("value"),
                )
                for i, v in enumerate(template_variables(rule.name_template))
            ]
            own = F.array(*pairs)
            values = F.when(F.col("rule_id") == rule.rule_id, own).otherwise(values)
        distinct = (
            sessions.select("incident_id", "ts", "alert_id", F.explode(values).alias("_v"))
            .groupBy("incident_id", F.col("_v.value").alias("value"))
            .agg(F.min(F.struct("_v.var", "ts", "alert_id")).alias("at"))
        )
        listed = distinct.groupBy("incident_id").agg(
            F.array_sort(F.collect_list(F.struct("at", "value"))).alias("_values")
        )
        named = named.join(listed, "incident_id", "left")
        for rule in templated:
            filled = _fill(rule.name_template)
            text = F.when(F.col("rule_id") == rule.rule_id, filled).otherwise(text)
    multi = F.coalesce(rule_value(rules, lambda r: r.multi_level, "boolean"), F.lit(False))
    text = F.when(multi, F.concat_ws(" - ", "group_key", text)).otherwise(text)
    if "running_number" in incidents.columns:
        prefix = rule_value(rules, lambda r: r.prefix, "string")
        numbered = F.concat(
            prefix, F.lit("-"), F.col("running_number").cast("string"), F.lit(" - "), text
        )
        text = F.coalesce(numbered, text)
    return named.withColumn("name", text).drop("_rule_name", "_values")


def _fill(template: str) -> Column:
    names = template_variables(template)
    parts: list[Column] = []
    at = 0
    for found in VARIABLE.finditer(template):
        if found.start() > at:
            parts.append(F.lit(template[at : found.start()]))
        number = names.index(found[1])
        own = F.filter("_values", lambda item_: item_["at"]["var"] == number)
        parts.append(F.array_join(F.transform(own, lambda item_: item_["value"]), ","))
        at = found.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts)
