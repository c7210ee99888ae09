"""The n-gram join by fragments: partial overlaps summed per pair, links counted."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertweave.llm import ngram_join
from alertweave.llm.common import prepare


def shingles(text):
    words = text.lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def mutated(rng, n):
    """Texts in families, each member with some words replaced."""
    texts = []
    while len(texts) < n:
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 60))]
        for _ in range(rng.randint(1, 12)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 50)}"
            texts.append(" ".join(own))
    return texts[:n]


def linked(a, b):
    n = len(a & b)
    return 100 * n >= 80 * (len(a) + len(b) - n)


@pytest.mark.parametrize("bounds", [{}, {"BLOCK_NODES": 3, "STRIP_ROWS": 2, "HELD_ROWS": 4, "MATRIX_CELLS": 64}])
def test_components_and_links(spark, monkeypatch, bounds):
    prepare(spark)
    for name, value in bounds.items():
        monkeypatch.setattr(ngram_join, name, value)
    texts = mutated(random.Random(11), 250)
    sets = [shingles(t) for t in texts]
    links = {i: [j for j, b in enumerate(sets) if j != i and linked(a, b)] for i, a in enumerate(sets)}
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in links[i]:
            old, new = max(group[i], group[j]), min(group[i], group[j])
            group = [new if g == old else g for g in group]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_join.near_duplicates(docs).collect()}
    assert {i: r.component_id for i, r in got.items()} == dict(enumerate(group))
    assert {i: r.n_links for i, r in got.items()} == {i: len(x) for i, x in links.items()}
    assert max(map(len, links.values())) > 3


def order_of(total=1000):
    keys = np.array([5 << 40, 9 << 40], np.uint64)
    return ngram_join.Order(keys >> np.uint64(20), np.array([300, 200]), 20, total)


def test_fragments_cut_the_global_order():
    order = order_of()
    rng = np.random.default_rng(1)
    rare = np.sort(rng.integers(0, 1 << 64, 500, np.uint64, endpoint=False))
    parts = order.parts(np.sort(np.append(rare, order.keys << np.uint64(20))))
    # the rare half is two fragments by hash, the frequent ones follow by frequency
    assert sum(map(len, parts)) == 502
    assert set(np.concatenate(parts[:2]).tolist()) == set(rare.tolist())
    assert 180 < len(parts[0]) < 320 and parts[0].max() < parts[1].min()
    assert [p.tolist() for p in parts[2:]] == [[9 << 40], [5 << 40]]


def test_partial_overlaps_of_two_fragments_are_summed(spark):
    """Neither fragment alone makes the pair a link, and each is counted in a task of its own."""
    prepare(spark)

    def row(node, fragment, values):
        return 1, 1, node, 10, 1, fragment, bytearray(np.array(values, np.uint64).tobytes())

    rows = [row(n, 0, [1, 2, 3, 4 + 10 * n, 5 + 10 * (n > 7)]) for n in (7, 8, 9)]
    rows += [row(n, 2, [100, 101, 102, 103, 104] if n < 9 else [200, 201, 202, 203, 204]) for n in (7, 8, 9)]
    rows[1] = row(8, 0, [1, 2, 3, 74, 5])
    schema = "root long, blocks long, node long, n long, copies long, fragment int, hashes binary"
    partial = ngram_join.partial_overlaps(spark.createDataFrame(rows, schema))
    assert {r.fragment: r["n"] for r in partial.groupBy("fragment").agg(F.count("*").alias("n")).collect()} == {0: 1, 2: 1}
    one = partial.filter("fragment = 0")
    assert ngram_join.links_of(one).collect() == []
    got = ngram_join.links_of(partial).collect()
    assert {(r.a, r.b) for r in got if r.b is not None} >= {(7, 8)} or {(8, 7)} <= {(r.a, r.b) for r in got}
    assert {(r.a, r.links) for r in got if r.links is not None} == {(7, 1), (8, 1)}


def test_a_forest_connects_what_links_connect():
    rng = np.random.default_rng(6)
    for _ in range(100):
        matrix = rng.random((rng.integers(1, 9), rng.integers(1, 12))) < 0.2

        def groups(pairs):
            group = {("r", i): ("r", i) for i in range(matrix.shape[0])} | {("c", i): ("c", i) for i in range(matrix.shape[1])}
            for a, b in pairs:
                old, new = group["c", b], group["r", a]
                group = {k: new if g == old else g for k, g in group.items()}
            return {frozenset(k for k in group if group[k] == g) for g in group.values()}

        made = ngram_join.forest(matrix)
        assert groups(made.tolist()) == groups(np.argwhere(matrix).tolist())
        assert all(matrix[a, b] for a, b in made) and len(made) <= sum(matrix.shape)


def test_no_text_is_shuffled_for_the_first_fragment(spark, monkeypatch, capsys):
    """Groups that meet are compared by half hashes; their texts stay where they are read."""
    prepare(spark)
    frames, first, cut = [], ngram_join.pairs_of, ngram_join.cut
    compared = []

    def pairs_of(sets):
        compared.extend([*frames, sets])
        return first(sets)

    monkeypatch.setattr(ngram_join, "pairs_of", pairs_of)
    monkeypatch.setattr(ngram_join, "cut", lambda df: frames.append(df) or cut(df))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = mutated(random.Random(5), 60)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        ngram_join.near_duplicates(docs)
        capsys.readouterr()
        for df in compared:
            df.explain("formatted")
        shuffled = re.findall(r"\(\d+\) Exchange.*?\nInput \[\d+\]: \[(.*?)\]", capsys.readouterr().out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(shuffled) > 3 and not [columns for columns in shuffled if "text#" in columns]


def test_half_hashes_that_agree_lose_no_link(spark):
    """Sets of 7, two with the same and one with 6 of them; the last bits of some hashes agree within a set and across sets."""
    prepare(spark)
    high = [i << 32 for i in range(1, 30)]
    alike = [h + 7 for h in high[:4]]
    sets = {1: alike + [1, 2, 3], 2: alike + [1, 2, 3], 3: alike[:3] + [high[9] + 7, 1, 2, 3], 4: [50, 51, 52, 53, 54, 55, 56]}
    order = type("Order", (), {"parts": lambda self, own: [own] + [own[:0]] * 3})()
    shared = type("Shared", (), {"value": order})()

    class Given(ngram_join.Reader):
        def read(self, data):
            nodes = [int(d) for d in data]
            return np.array(nodes), [np.sort(np.array(sets[n], np.uint64)) for n in nodes]

    docs = spark.createDataFrame([(n, str(n)) for n in sets], "doc_id long, text string").coalesce(1)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ngram_join, "Reader", Given)
        start = {}
        patch.setattr(ngram_join, "append_columns", lambda df, text, keep, fields, make: start.setdefault("work", make()))
        ngram_join.sets_read(docs, ["doc_id"], 0, shared, 1, narrow=True)
    nodes, sizes, hashes = start["work"]([str(n) for n in sets])
    assert sizes == [7] * 4 and [len(h) for h in hashes] == [16, 16, 16, 28]
    rows = [(1, 1, n, size, bytearray(h)) for n, size, h in zip(nodes, sizes, hashes, strict=True)]
    made = ngram_join.pairs_of(spark.createDataFrame(rows, "root long, blocks long, node long, n long, hashes binary"))
    met = {node for pair in made.collect() for node in pair}
    assert {1, 2} <= met and 4 not in met
