"""The index of lookup cells against every cell tried on every value."""

from __future__ import annotations

import random
import re

import pytest

from alertweave.operators import lookup_index, mapping
from alertweave.operators.mapping import MappingRule

CELLS = [
    "*", None, "alpha", "al.ha", "^beta$", "a(b", "[", "x|y", "(?i)ALPHA", "gam+a", "del?ta", "de{2}p", r"a\.b", r"\d+",
    ".*", "(foo|bar)baz", "[]a]lpha", "[^a]lpha", "ab", "a", "", r"\bcpu\b", "(?P<n>disk)-full", "(?:a)lpha", r"\x61lpha",
]
VALUES = [
    None, "alpha", "ALPHA", "beta", "betas", "a(b", "[", "gammma", "gaa", "delta", "deta", "deep", "a.b", "axb", "42", "",
    "foobaz", "barbaz", "]lpha", "blpha", "cpu", "high cpu load", "disk-full", "x", "y", "z",
]


def matches(value, cell) -> bool:
    if cell == "*":
        return True
    if value is None or cell is None:
        return value is None and cell is None
    if value == cell:
        return True
    try:
        return re.search(cell, value) is not None
    except re.error:
        return False


@pytest.mark.parametrize("cell", [c for c in CELLS if c not in ("*", None)])
def test_a_match_holds_the_grams(cell):
    for value in VALUES:
        if value is not None and value != cell and matches(value, cell):
            assert lookup_index.cell_grams(cell) <= lookup_index.value_grams(value)


def test_pairs_need_few_trials():
    assert lookup_index.required_texts("host-(a|b)[0-9]+-web*") == ["host-", "-we"]
    assert lookup_index.required_texts("a|b") == lookup_index.required_texts("(?i)abc") == []
    assert lookup_index.cell_grams("ab.c") == {"ab"}


def test_first_rows(spark):
    rng = random.Random(3)
    # row numbers are sparse
    rows = [(rng.randint(0, 10**9), rng.choice(CELLS), rng.choice(CELLS), rng.choice(CELLS)) for _ in range(150)]
    rows += [(2 * 10**9, "*", "*", "nothing like it")]
    values = list({(rng.choice(VALUES), rng.choice(VALUES), rng.choice(VALUES)) for _ in range(120)})
    matchers = [["a", "b"], ["c"]]
    cells = spark.createDataFrame(rows, "row_idx long, _c_a string, _c_b string, _c_c string")
    given = spark.createDataFrame(values, "_m_a string, _m_b string, _m_c string")
    want = {}
    for a, b, c in values:
        hit = [i for i, x, y, z in rows if matches(a, x) and matches(b, y) or matches(c, z)]
        if hit:
            want[a, b, c] = min(hit)
    got = {tuple(r)[:3]: r.row_idx for r in lookup_index.first_rows(given, cells, matchers).collect()}
    assert got == want


def test_a_bad_cell_matches_only_itself(spark):
    alerts = spark.createDataFrame([(1, "ab"), (2, "a(b"), (3, None)], "alert_id long, name string")
    lookup = spark.createDataFrame([(7, "a(b", "bad"), (10**9, "a.", "good")], "row_idx long, name string, team string")
    out = mapping.map_lookup(alerts, MappingRule(1, [["name"]], ["team"]), lookup)
    assert {r.alert_id: r.team for r in out.collect()} == {1: "good", 2: "bad", 3: None}
    assert [r.status for r in mapping.enrichment_outcomes(out, "alert_id").orderBy("alert_id").collect()] == [
        "success", "success", "skipped"
    ]
    empty = mapping.map_lookup(alerts, MappingRule(1, [["name"]], ["team"]), lookup.limit(0))
    assert {r.team for r in empty.collect()} == {None}


def test_many_cells(spark):
    """100,000 cells, each found by a gram of its own."""
    rows = spark.range(100_000).selectExpr("id * 1000 AS row_idx", "concat('host-', id, '-web$') AS _c_a")
    values = spark.range(0, 100_000, 500).selectExpr("concat('eu.host-', id, '-web') AS _m_a")
    got = lookup_index.first_rows(values, rows, [["a"]]).collect()
    assert {r._m_a: r.row_idx for r in got} == {f"eu.host-{i}-web": i * 1000 for i in range(0, 100_000, 500)}
