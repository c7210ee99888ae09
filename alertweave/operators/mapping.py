"""Rule-driven field enrichment: regex extraction, lookup tables, topology."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.functions import paths
from alertweave.functions.predicates import or_, stored_test
from alertweave.functions.scalars import html_unescape
from alertweave.operators.enrich import render
from alertweave.operators.lookup_index import WILDCARD, first_rows

OUTCOMES = "enrichment_events"
OUTCOME_TYPE = (
    "array<struct<rule_id:int,enrichment_type:string,status:string,"
    "fields:map<string,string>>>"
)
SUCCESS, FAILURE, SKIPPED = "success", "failure", "skipped"
# \w, \d and \b cover all of Unicode, as in the patterns users write
UNICODE_CLASSES = "(?U)"


@dataclass(frozen=True)
class ExtractionRule:
    rule_id: int
    attribute: str
    regex: str
    priority: int = 0
    condition: str | None = None
    pre: bool = False
    disabled: bool = False
    # None: the rule is every tenant's
    tenant_id: str | None = None


@dataclass(frozen=True)
class MappingRule:
    """``matchers`` is a list of alternatives, each a list of attributes that must all
    match. ``fields`` names the lookup columns to copy."""

    rule_id: int
    matchers: list[list[str]]
    fields: list[str]
    priority: int = 0
    kind: str = "csv"
    condition: str | None = None
    override: bool = True
    disabled: bool = False
    multi_level: bool = False
    new_property_name: str = ""
    prefix_to_remove: str = ""
    lookup: str = ""
    # None: the rule is every tenant's
    tenant_id: str | None = None

    @property
    def attributes(self) -> list[str]:
        return list(dict.fromkeys(a.strip() for m in self.matchers for a in m))


def rules_by_priority(rules: list) -> list:
    """Enabled rules, highest priority first, then by id."""
    enabled = [r for r in rules if not r.disabled]
    return sorted(enabled, key=lambda r: (-r.priority, r.rule_id))


def java_regex(pattern: str) -> tuple[str, dict[str, int]]:
    """A pattern with ``(?P<name>...)`` groups as a Java one with numbered groups, and the
    number of each name."""
    names = dict(re.compile(pattern).groupindex)
    out = re.sub(r"\(\?P<\w+>", "(", pattern)
    out = re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\{names[m[1]]}", out)
    return UNICODE_CLASSES + out.replace("\\Z", "\\z"), names


def _with_missing(df: DataFrame, names: list[str]) -> DataFrame:
    new = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    return df.withColumns(new) if new else df


def _with_outcomes(df: DataFrame) -> DataFrame:
    if OUTCOMES in df.columns:
        return df
    return df.withColumn(OUTCOMES, F.array().cast(OUTCOME_TYPE))


def _outcome(rule_id: int, kind: str, status: Column, fields: Column) -> Column:
    event = F.struct(
        F.lit(rule_id).alias("rule_id"),
        F.lit(kind).alias("enrichment_type"),
        status.alias("status"),
        fields.alias("fields"),
    )
    return F.concat(F.col(OUTCOMES), F.array(event)).cast(OUTCOME_TYPE)


def _string_map(pairs: dict[str, Column]) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,string>")
    whole = F.create_map(*[x for k, c in pairs.items() for x in (F.lit(k), c)])
    return whole.cast("map<string,string>")


def extract(
    alerts: DataFrame, rules: list[ExtractionRule], pre: bool = False, unescape: bool = True
) -> DataFrame:
    """Named regex groups become fields, rule by rule in priority order.

    A rule applies when its attribute is not blank and its condition holds; ``source`` is
    never overridden; a group that took no part gives null. Later rules see the fields of
    earlier ones. ``enrichment_events`` records the outcome of every rule.
    """
    out = _with_outcomes(alerts)
    for rule in rules_by_priority([r for r in rules if r.pre == pre]):
        template = rule.attribute
        if not (template.startswith("{{") and template.endswith("}}")):
            template = "{{ " + template + " }}"
        value = render(template, _resolver(out))
        out = out.withColumn("_value", value)
        if unescape:
            out = out.withColumn("_value", html_unescape(F.col("_value")))
        regex, names = java_regex(rule.regex)
        names.pop("source", None)
        out, applies = _applies(out, rule)
        value = F.col("_value")
        hit = (F.length(value) > 0) & applies & value.rlike(regex)
        out = _with_missing(out.withColumn("_hit", hit), list(names))
        groups = {
            n: F.nullif(F.regexp_extract(value, regex, i), F.lit("")) for n, i in names.items()
        }
        cols = {n: F.when(F.col("_hit"), g).otherwise(F.col(n)) for n, g in groups.items()}
        cols[OUTCOMES] = _outcome(
            rule.rule_id,
            "extraction",
            F.when(F.col("_hit"), SUCCESS).otherwise(SKIPPED),
            F.when(F.col("_hit"), _string_map(groups)).otherwise(_string_map({})),
        )
        out = out.withColumns(cols).drop("_value", "_hit", "_test")
    return out


def _applies(df: DataFrame, rule: ExtractionRule | MappingRule) -> tuple[DataFrame, Column]:
    """``df`` with ``_test``, and whether an alert is the rule's tenant's and meets its condition."""
    blank = rule.condition is None or rule.condition.strip() in ("", WILDCARD)
    out, test = stored_test(df, None if blank else rule.condition)
    if rule.tenant_id is not None:
        test = test & F.coalesce(F.col("tenant_id") == rule.tenant_id, F.lit(False))
    return out, test


def _own_rows(rows: DataFrame, rule: MappingRule) -> DataFrame:
    """The lookup rows that a rule reads: those of its tenant, where rows have one."""
    if rule.tenant_id is None or "tenant_id" not in rows.columns:
        return rows
    return rows.filter(F.col("tenant_id") == rule.tenant_id)


def _resolver(df: DataFrame) -> Callable[[str], Column]:
    """Dotted path to a column: a top-level column, else a map or struct below one."""
    types = {f.name: f.dataType.typeName() for f in df.schema}

    def resolve(path: str) -> Column:
        head, *rest = paths.split_path(path)
        if head not in types:
            return F.lit(None).cast("string")
        if head == "source" and types[head] == "array":
            return paths.first_source(F.col(head))
        if not rest:
            return F.col(head)
        if types[head] == "map":
            return paths.map_text_at(F.col(head), ".".join(f"[{r}]" for r in rest))
        if types[head] == "string":
            return F.get_json_object(F.col(head), paths.json_path(rest))
        return reduce(lambda c, r: c.getField(r), rest, F.col(head))

    return resolve


def _gate(rule: MappingRule) -> Column:
    """Some alternative has all its attributes."""
    alternatives = [
        reduce(lambda a, b: a & b, [F.col(f"_m_{a.strip()}").isNotNull() for a in m])
        for m in rule.matchers
    ]
    return or_(*alternatives)


def map_lookup(alerts: DataFrame, rule: MappingRule, rows: DataFrame) -> DataFrame:
    """Copy the fields of the first lookup row (by ``row_idx``) that matches an alert.

    Matching runs on the distinct attribute values only, through an index of the cells; the
    alerts then join by equality.
    """
    resolve = _resolver(alerts)
    attrs = rule.attributes
    keyed = alerts.withColumns({f"_m_{a}": resolve(a).cast("string") for a in attrs})
    names = [f"_m_{a}" for a in attrs]
    rows = _own_rows(rows, rule)
    keyed, applies = _applies(keyed, rule)
    keyed = keyed.withColumn("_active", applies & _gate(rule)).drop("_test")

    values = keyed.filter("_active").select(*names).distinct()
    cells = rows.select("row_idx", *[F.col(a).cast("string").alias(f"_c_{a}") for a in attrs])
    first = first_rows(values, cells, rule.matchers)

    copied = [f for f in rule.fields if f not in attrs]
    lookup = rows.select(
        "row_idx", *[F.trim(F.col(f).cast("string")).alias(f"_v_{f}") for f in copied]
    )
    found = first.join(lookup, "row_idx").select(
        *[F.col(n).alias(f"_r{n}") for n in names],
        F.lit(True).alias("_found"),
        *[f"_v_{f}" for f in copied],
    )
    match = reduce(
        lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_r{n}")) for n in names]
    )
    joined = keyed.join(found, F.col("_active") & match, "left")
    joined = _apply(joined, rule, copied, {f: F.col(f"_v_{f}") for f in copied})
    return joined.drop(*names, *[f"_r{n}" for n in names], *[f"_v_{f}" for f in copied])


def _apply(joined: DataFrame, rule: MappingRule, copied: list[str], new: dict) -> DataFrame:
    """Write the copied fields and the outcome; needs ``_found`` and ``_active``."""
    out = _with_outcomes(_with_missing(joined, copied))
    cols = {}
    for name in copied:
        parts = [new[name], F.col(name)] if rule.override else [F.col(name), new[name]]
        cols[name] = F.coalesce(*parts)
    found = F.coalesce(F.col("_found"), F.lit(False))
    status = (
        F.when(~F.coalesce(F.col("_active"), F.lit(False)), SKIPPED)
        .when(found, SUCCESS)
        .otherwise(FAILURE)
    )
    fields = F.map_filter(_string_map(new), lambda key_, value_: value_.isNotNull())
    cols[OUTCOMES] = _outcome(
        rule.rule_id,
        "mapping",
        status,
        F.when(found, fields).otherwise(_string_map({})),
    )
    return out.withColumns(cols).drop("_found", "_active")


def map_lookup_multi(
    alerts: DataFrame, rule: MappingRule, rows: DataFrame, id_col: str = "alert_id"
) -> DataFrame:
    """Look up every element of a list attribute; ``new_property_name`` becomes a map from
    the element to the fields of its first row. Elements join by equality.

    Alerts that fail the condition or find nothing keep the older value; one of another type
    makes the property a text, with maps as JSON. ``enrichment_events`` records every outcome.
    """
    key, new = rule.matchers[0][0].strip(), rule.new_property_name
    element = F.col("_element")
    if rule.prefix_to_remove:
        element = F.replace(element, F.lit(rule.prefix_to_remove), F.lit(""))
    ids = [c for c in ("tenant_id", id_col) if c in alerts.columns]
    rows = _own_rows(rows, rule)
    keyed, applies = _applies(alerts, rule)
    keyed = keyed.withColumn("_active", applies & F.col(key).isNotNull()).drop("_test")
    elements = (
        keyed.filter("_active")
        .select(*ids, F.explode(key).alias("_element"))
        .select(*ids, F.trim(element).alias("_element"))
    )
    names = [c for c in rows.columns if c not in ("row_idx", "tenant_id")]
    values = F.map_filter(
        _string_map({n.strip(): F.trim(F.col(n).cast("string")) for n in names}),
        lambda key_, value_: value_.isNotNull(),
    )
    first = rows.groupBy(F.col(key).alias("_element")).agg(
        F.min_by(values, F.col("row_idx")).alias("_values")
    )
    found = (
        elements.distinct()
        .join(first, "_element")
        .groupBy(*[F.col(c).alias(f"_r_{c}") for c in ids])
        .agg(F.map_from_entries(F.collect_list(F.struct("_element", "_values"))).alias("_new"))
    )
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in ids])
    joined = _with_outcomes(keyed.join(found, F.col("_active") & on, "left"))
    value, hit = F.col("_new"), F.col("_new").isNotNull()
    if new in alerts.columns and alerts.schema[new].dataType.typeName() != "void":
        old = F.col(new)
        if alerts.schema[new].dataType.simpleString() != "map<string,map<string,string>>":
            text = alerts.schema[new].dataType.typeName() in ("map", "struct", "array")
            value, old = F.to_json(value), F.to_json(old) if text else old.cast("string")
        value = F.coalesce(value, old) if rule.override else F.coalesce(old, value)
    status = (
        F.when(~F.coalesce("_active", F.lit(False)), SKIPPED).when(hit, SUCCESS).otherwise(FAILURE)
    )
    fields = F.when(hit, _string_map({new: F.to_json("_new")})).otherwise(_string_map({}))
    outcome = _outcome(rule.rule_id, "mapping", status, fields)
    out = joined.withColumns({new: value, OUTCOMES: outcome})
    return out.drop("_active", "_new", *[f"_r_{c}" for c in ids])


def topology_lookup(
    alerts: DataFrame,
    rule: MappingRule,
    services: DataFrame,
    applications: DataFrame | None = None,
    bridge: DataFrame | None = None,
) -> DataFrame:
    """Copy the fields of the service (smallest id) whose columns equal the alert's; the
    repository falls back to the one of an application of the service."""
    attrs = rule.attributes
    if applications is not None and bridge is not None:
        repo = (
            bridge.join(applications, "application_id")
            .filter(F.length("repository") > 0)
            .groupBy("service_id")
            .agg(F.max("repository").alias("_app_repository"))
        )
        services = services.join(repo, "service_id", "left").withColumn(
            "repository",
            F.coalesce(F.nullif(F.col("repository"), F.lit("")), F.col("_app_repository")),
        )
    copied = list(rule.fields)
    picked = F.min_by(
        F.struct(*[F.trim(F.col(f).cast("string")).alias(f) for f in copied]),
        F.col("service_id"),
    )
    first = services.groupBy(
        F.col("tenant_id").alias("_t"), *[F.col(a).alias(f"_r_{a}") for a in attrs]
    ).agg(picked.alias("_service"))
    resolve = _resolver(alerts)
    keyed = alerts.withColumns({f"_m_{a}": resolve(a).cast("string") for a in attrs})
    keyed, applies = _applies(keyed, rule)
    keyed = keyed.withColumn("_active", applies & _gate(rule)).drop("_test")
    on = F.col("_active") & (F.col("tenant_id") == F.col("_t"))
    for a in attrs:
        on = on & (F.col(f"_m_{a}") == F.col(f"_r_{a}"))
    joined = keyed.join(first, on, "left").withColumn("_found", F.col("_service").isNotNull())
    out = _apply(joined, rule, copied, {f: F.col(f"_service.{f}") for f in copied})
    return out.drop("_t", "_service", *[f"_m_{a}" for a in attrs], *[f"_r_{a}" for a in attrs])


def map_alerts(
    alerts: DataFrame, rules: list[MappingRule], lookups: dict[str, DataFrame]
) -> DataFrame:
    """All enabled mapping rules in priority order; later rules see and may overwrite the
    results of earlier ones. ``lookups`` holds the tables the rules name."""
    out = alerts
    for rule in rules_by_priority(rules):
        if rule.kind == "topology":
            out = topology_lookup(
                out, rule, lookups["services"], lookups.get("applications"),
                lookups.get("bridge"),
            )
        elif rule.multi_level:
            out = map_lookup_multi(out, rule, lookups[rule.lookup])
        else:
            out = map_lookup(out, rule, lookups[rule.lookup])
    return out


def enrichment_outcomes(enriched: DataFrame, *keep: str) -> DataFrame:
    """One row per alert and rule: status and the fields written."""
    return enriched.select(*keep, F.explode(OUTCOMES).alias("_o")).select(*keep, "_o.*")
