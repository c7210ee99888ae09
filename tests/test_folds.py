"""Scans against a plain fold over each key, on random sequences.

Keys of more than a few rows are cut, so every carry across slots is exercised.
"""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from alertweave.operators import correlate, dedup, enrich, health, scan, sequence, throttle
from alertweave.operators.correlate import CorrelationRule

START = dt.datetime(2024, 1, 1)
SCHEMA = (
    "tenant_id string, fingerprint string, alert_id long, ts timestamp, status string, "
    "content_hash string, service string, severity_rank int, unresolved_counter long"
)


def random_alerts(seed, keys=40, length=30, step=90, statuses=None):
    rng = random.Random(seed)
    statuses = statuses or ["firing"] * 3 + ["resolved", "acknowledged", "suppressed"]
    rows, number = [], 0
    for key in range(keys):
        at = START
        # one key holds a third of all rows
        n = length * keys // 2 if key == 0 else rng.randint(1, length)
        for _ in range(n):
            # equal times happen
            at += dt.timedelta(seconds=rng.choice([0, 1, rng.randint(1, step), 4 * step]))
            number += 1
            rows.append(
                (
                    "t0",
                    f"f{key}",
                    number,
                    at,
                    rng.choice(statuses),
                    rng.choice("abc"),
                    f"s{key % 5}",
                    rng.randint(1, 5),
                    rng.randint(0, 4),
                )
            )
    return rows


def by_key(rows, key=lambda r: r[1]):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[3], r[2]))
    return groups


@pytest.fixture(scope="module")
def alerts(spark):
    rows = random_alerts(1)
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("rows_held", [3, 30, 100_000])
def test_sequence_features(alerts, rows_held):
    rows, df = alerts
    want = {}
    for group in by_key(rows).values():
        prev = None
        for r in group:
            status, ts = r[4], r[3]
            p = prev or {}
            start = None
            if status == "firing":
                start = p["start"] if prev and p["status"] == "firing" else ts
            since = None
            if status != "resolved":
                if prev is None:
                    since = ts if status == "firing" else None
                elif p["status"] == "resolved":
                    since = ts if status == "firing" else None
                else:
                    since = p["since"]
            if status == "acknowledged":
                fire = 0
            elif prev is None or p["status"] == "acknowledged":
                fire = 1
            else:
                fire = p["fire"] + 1
            if status == "resolved":
                unres = 0
            elif prev is None or p["status"] == "resolved":
                unres = 1
            else:
                unres = p["unres"] + 1
            prev = dict(status=status, start=start, since=since, fire=fire, unres=unres)
            first = None if r is group[0] else group[0][3]
            want[r[2]] = (start, since, fire, unres, first)
    out = sequence.with_sequence_features(
        df.drop("unresolved_counter"), max_rows=rows_held
    ).select(
        "alert_id",
        "firing_start",
        "firing_since_resolved",
        "firing_counter",
        "unresolved_counter",
        "started_at",
    )
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got == want


@pytest.mark.parametrize("rows_held", [5, 100_000])
def test_previous_and_duplicates(alerts, rows_held):
    rows, df = alerts
    kinds, previous, resolved = {}, {}, {}
    for group in by_key(rows).values():
        before, last_resolved = None, None
        for r in group:
            kinds[r[2]] = (
                "none" if before is None else "full" if before[5] == r[5] else "partial"
            )
            previous[r[2]] = before and before[2]
            resolved[r[2]] = last_resolved
            before = r
            if r[4] == "resolved":
                last_resolved = r[2]
    out = dedup.classify_duplicates(df, max_rows=rows_held)
    assert {r.alert_id: r.dedup_type for r in out.collect()} == kinds
    out = sequence.previous_alert(df, max_rows=rows_held)
    assert {r.alert_id: r.previous_id for r in out.collect()} == previous
    out = sequence.previous_alert(df, status="resolved", max_rows=rows_held)
    assert {r.alert_id: r.previous_id for r in out.collect()} == resolved


def test_touch_last_received(alerts):
    rows, df = alerts
    want = {}
    for group in by_key(rows).values():
        kept, before = None, None
        for r in group:
            if before is None or before != r[5]:
                kept = r[2]
            want[kept] = r[3]
            before = r[5]
    out = dedup.touch_last_received(dedup.classify_duplicates(df, max_rows=4), 4)
    assert {r.alert_id: r.last_received for r in out.collect()} == want


def test_lead_and_following(spark, alerts):
    rows, df = alerts
    nexts, resolved = {}, {}
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            nexts[r[2]] = group[i + 1][2] if i + 1 < len(group) else None
            later = [x[2] for x in group[i + 1 :] if x[4] == "resolved"]
            resolved[r[2]] = later[0] if later else None
    hit = F.when(F.col("status") == "resolved", F.col("alert_id"))
    out = scan.run_scans(
        df,
        [
            scan.lead_struct("_next", {"id": F.col("alert_id")}),
            scan.following_first("later", hit),
        ],
        max_rows=4,
    ).select("alert_id", "_next.id", "later")
    got = out.collect()
    assert {r[0]: r[1] for r in got} == nexts
    assert {r[0]: r[2] for r in got} == resolved


RULE = CorrelationRule("r", "t0", "rule", ("true",), 300, ("service",))


@pytest.mark.parametrize("rows_held", [3, 40, 100_000])
def test_sessions(alerts, rows_held):
    """Incident per key: opens on firing only, ends after the timeframe without alerts."""
    rows, df = alerts
    want = {}
    for service, group in by_key(rows, key=lambda r: r[6]).items():
        number, is_open, last = 0, False, None
        for r in group:
            if last is not None and (r[3] - last).total_seconds() > 300:
                number, is_open = number + 1, False
            last = r[3]
            is_open = is_open or r[4] == "firing"
            if is_open:
                want[r[2]] = f"t0/r/{service}/{number}"
    keyed = correlate.group_key(correlate.match_rules(df, [RULE]), [RULE])
    out = correlate.sessionize(keyed, [RULE], max_rows=rows_held)
    assert {r.alert_id: r.incident_id for r in out.collect()} == want


def test_visibility_gate(alerts):
    rows, df = alerts
    rule = CorrelationRule("r", "t0", "rule", ("true",), 300, ("service",), threshold=6)
    keyed = correlate.group_key(correlate.match_rules(df, [rule]), [rule])
    linked = correlate.sessionize(keyed, [rule], max_rows=6)
    members = defaultdict(list)
    for r in linked.collect():
        members[r.incident_id].append(r)
    want = {}
    for incident, group in members.items():
        counters, since = {}, None
        for r in sorted(group, key=lambda r: (r.ts, r.alert_id)):
            counters[r.fingerprint] = r.unresolved_counter
            if since is None and max(len(counters), sum(counters.values())) >= 6:
                since = r.ts
        want[incident] = since
    out = correlate.gate_visibility(linked, [rule], max_rows=6)
    assert {r.incident_id: r.visible_since for r in out.collect()} == want


def test_disposable_fields(spark, alerts):
    """Operations replayed one by one among the alerts of their key."""
    rows, df = alerts
    rng = random.Random(5)
    ops, number = [], 0
    for r in rows:
        for _ in range(rng.randint(0, 2)):
            number += 1
            field = rng.choice(["status", "dismissed", "team", "note"])
            value = rng.choice(["x", "y", "z", None])
            at = r[3] + dt.timedelta(seconds=rng.choice([0, 0, 1, 5]))
            ops.append((r[0], r[1], at, number, field, value, rng.random() < 0.5))
    op_df = spark.createDataFrame(
        ops,
        "tenant_id string, fingerprint string, ts timestamp, seq long, field string, "
        "value string, disposable boolean",
    )
    want = {}
    for key, group in by_key(rows).items():
        steps = [((r[3], 0, r[2]), "alert", r) for r in group]
        steps += [((o[2], 1, o[3]), "op", o) for o in ops if o[1] == key]
        state, disposable, seen = {}, set(), False
        for _, kind, x in sorted(steps, key=lambda s: s[0]):
            if kind == "alert":
                seen = True
                if x[4] == "resolved":
                    for f in enrich.DISPOSE_KEYS:
                        state.pop(f, None)
                else:
                    for f in disposable:
                        state.pop(f, None)
                        if f == "dismissed":
                            state[f] = "false"
                disposable = set()
            else:
                _, _, _, _, field, value, once = x
                if value is None:
                    state.pop(field, None)
                else:
                    state[field] = value
                if once:
                    disposable.add(field)
        if seen and state:
            want[key] = state
    out = enrich.current_enrichments(df, op_df, max_rows=6)
    got = {r.fingerprint: r.enrichments for r in out.collect() if r.enrichments}
    assert got == want


def test_close_pairs(alerts):
    rows, df = alerts
    want = {}
    for key, group in by_key(rows).items():
        n = 0
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if (b[3] - a[3]).total_seconds() > 120:
                    break
                n += 1
        want[key] = n
    out = health.close_pairs(df, gap_seconds=120)
    assert {r.fingerprint: r.pairs for r in out.collect()} == want


@pytest.mark.parametrize("chunk", [45, 600])
def test_throttle(alerts, chunk):
    rows, df = alerts
    want = set()
    for group in by_key(rows, key=lambda r: r[6]).values():
        ready = None
        for r in group:
            if ready is None or r[3] >= ready:
                want.add(r[2])
                ready = r[3] + dt.timedelta(seconds=45)
    events = df.select("service", "ts", F.col("alert_id").alias("id"))
    out = throttle.throttle(events, ["service"], interval_seconds=45, chunk_seconds=chunk)
    assert {r.id for r in out.collect()} == want


def test_a_hot_instant_is_cut(spark):
    """Half of a key's rows come at one instant; no slot holds many of them."""
    times = [START if i % 2 else START + dt.timedelta(seconds=i) for i in range(4000)]
    rows = [("t", "hot", i, at) for i, at in enumerate(times)] + [("t", None, 4000, START)]
    df = spark.createDataFrame(rows, "tenant_id string, fingerprint string, alert_id long, ts timestamp")
    cuts = scan._slot_cuts(df, scan.ALERT_KEY, scan.ALERT_ORDER, 100)
    places = [tuple(c) for c in cuts.collect()[0]["_cuts"]]
    slots = defaultdict(int)
    for at, i in ((r[3], r[2]) for r in rows[:4000]):
        slots[sum(c <= (at, i) for c in places)] += 1
    assert len(slots) > 20 and max(slots.values()) < 400
    out = scan.run_scans(df, [scan.since_reset("n", F.lit(False))], max_rows=100)
    assert out.columns == [*df.columns, "n"]
    got = {(r.fingerprint, r.alert_id): r.n for r in out.collect()}
    order = sorted((r[3], r[2]) for r in rows[:4000])
    assert got == {("hot", i): n for n, (_, i) in enumerate(order, 1)} | {(None, 4000): 1}


def test_running_number(spark):
    rows = [("t", START + dt.timedelta(seconds=i // 3), i) for i in range(500)]
    df = spark.createDataFrame(rows, "tenant_id string, creation_time timestamp, incident_id long")
    out = sequence.running_number(df, max_rows=7).collect()
    assert all(r.running_number == r.incident_id + 1 for r in out)
