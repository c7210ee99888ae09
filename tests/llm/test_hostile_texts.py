"""Worst texts for each rule, offsets after lowering, marginals by enumeration, any column names."""

from __future__ import annotations

import itertools
import time

import numpy as np
import pytest

from alertweave.llm import decontaminate, secret_scan, toxicity
from alertweave.llm.common import prepare

WORST = {
    "assign": ["password", "password" + " " * 90, "token=" + " " * 90, "secret\"", "api_"],
    "access": ["AKIA", "AKIA "],
    "hex": ["a" * 23 + " ", "0123456789abcdef"],
    "private_key": [
        "-----BEGIN PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----\nMIIEvQIBADANBgkqhkiG\n", "-----END ", "-----BEGIN A ",
        "-----BEGIN PRIVATE KEY----- > \n", "-----BEGIN PRIVATE KEY-----\nProc-Type:\n",
    ],
    "repository_token": ["ghp_", "ghp_" + "a" * 35 + " "],
    "chat_token": ["xoxb-", "xoxb-a "],
    "cloud_key": ["AIza", "AIza" + "a" * 34 + " "],
    "web_token": ["eyJ", "eyJaaaaaaaaa.", "eyJaaaaaaaaa.eyJaaaaaaaa ", "eyJaaaaaaaaaa.eyJ"],
}


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.kind)
def test_rules_read_a_megabyte_in_time(rule):
    pattern = rule.compiled()
    for part in WORST[rule.kind]:
        for text in (part * (1_000_000 // len(part)), part + "a" * 1_000_000, part + "A " * 500_000):
            start = time.process_time()
            secret_scan.matches(rule, pattern, text)
            assert time.process_time() - start < 2, (rule.kind, part)


def test_web_tokens():
    rule = next(r for r in secret_scan.RULES if r.kind == "web_token")
    token = "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJ_-"
    text = f"a {token}, '{token}' x{token} eyJshort.eyJshort.x"
    assert [text[a:b] for a, b in secret_scan.matches(rule, rule.compiled(), text)] == [token, token]


def test_offsets_are_of_the_original_text():
    for text in ("İİ fool x", "ii fool x", "ẞİ FOOL İ"):
        lowered = text.lower()
        found = np.array([0.9 * (word == "fool") for word in toxicity.TOKEN.findall(lowered)])
        spans = toxicity.spans_of(text, lowered, found)
        assert [text[s["start"] : s["end"]].lower() for s in spans] == ["fool"]


def test_marginals_by_enumeration():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 8):
        weights, moves = rng.normal(0, 2, n), rng.normal(0, 1, (2, 2))
        total, toxic, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=n):
            log = sum(w for w, y in zip(weights, labels, strict=True) if y)
            steps = list(itertools.pairwise(labels))
            log += sum(moves[a, b] for a, b in steps)
            p = np.exp(log)
            total += p
            toxic += p * np.array(labels)
            for a, b in steps:
                pairs[a, b] += p
        chains = toxicity.Chains.of(np.zeros(n, int))
        got, both = toxicity.marginals(weights[chains.order], chains, moves)
        out = np.empty(n)
        out[chains.order] = got
        assert np.allclose(out, toxic / total) and np.allclose(both, pairs / total)


@pytest.mark.parametrize("block_bytes", [1 << 20, 8])
def test_kept_columns_may_have_any_name(spark, block_bytes):
    prepare(spark)
    names = ["doc_id", "__body", "__earlier", "__text", "__k0", "n_hit"]
    docs = spark.createDataFrame([(1, "a", "b", "c", "d", "e", "one two")], "doc_id long, __body string, __earlier string, __text string, __k0 string, n_hit string, text string")
    items = spark.createDataFrame([(5, "ONE two"), (6, "three four"), (7, "five")], "item_id long, text string")
    row = decontaminate.find_leaks(docs, items, keep=names, block_bytes=block_bytes).first()
    assert [row[n] for n in names] == [1, "a", "b", "c", "d", 2]
    assert row.item_ids == ["5"]
