"""Incidents that close on the way, against a plain fold over the alerts of a key."""

from __future__ import annotations

import pytest

from alertweave.operators import correlate, resolution
from alertweave.operators.correlate import CorrelationRule
from test_folds import SCHEMA, by_key, random_alerts


def fold(group, policy, timeframe):
    """Alert id to the number of its incident among those of the key."""
    out, number, links, last = {}, 0, None, None
    for r in group:
        at, status, key = r[3], r[4], r[1]
        if links is not None and (at - last).total_seconds() > timeframe:
            links = None
        last = at
        if links is None:
            if status != "firing":
                continue
            links, number = {}, number + 1
        links[key] = status
        out[r[2]] = number
        done = policy == "last_resolved" and status == "resolved"
        if policy == "all_resolved":
            done = all(s == "resolved" for s in links.values())
        if done:
            links = None
    return out


@pytest.mark.parametrize("policy", ["never", "last_resolved", "all_resolved"])
def test_resolution_splits_sessions(spark, policy):
    statuses = ["firing"] * 2 + ["resolved"] * 3 + ["acknowledged"]
    rows = random_alerts(9, keys=24, length=40, statuses=statuses)
    df = spark.createDataFrame(rows, SCHEMA)
    rule = CorrelationRule("r", "t0", "rule", ("true",), 300, ("service",), resolve_on=policy)
    want = {}
    for service, group in by_key(rows, key=lambda r: r[6]).items():
        for alert, number in fold(group, policy, 300).items():
            want.setdefault((service, number), set()).add(alert)
    keyed = correlate.group_key(correlate.match_rules(df, [rule]), [rule])
    out = resolution.sessions_with_resolution(keyed, [rule], max_rows=5)
    got = {}
    for r in out.collect():
        got.setdefault(r.incident_id, set()).add(r.alert_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
