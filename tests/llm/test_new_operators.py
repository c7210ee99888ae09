"""Spelling variants, periodic runs and line dedup against plain versions, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from alertweave.llm import line_dedup, repeats, spelling
from alertweave.llm.common import prepare

FOLDER = "/root/testdata/sf0.001"
QUERIES = contract.queries()
WHITE = "\t\n\v\f\r "
UPPER = str.maketrans(spelling.UPPER, spelling.UPPER.lower())


def documents(folder: str = FOLDER) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text: str) -> int:
    return zlib.crc32(text.encode())


def nearness(counts: dict[str, int]) -> set[tuple]:
    """(word, form, root, n, n_near, form_n) by trying every edit of every word."""
    letters = set("".join(counts))
    form, near = {}, {}
    for w in counts:
        edits = set()
        for i in range(len(w) + 1):
            edits |= {w[:i] + c + w[i:] for c in letters}
            edits |= {w[:i] + c + w[i + 1 :] for c in letters | {""}} if i < len(w) else set()
        found = (edits & counts.keys()) - {w}
        near[w] = len(found)
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, near[w], counts[form[w]] if form[w] else None) for w, n in counts.items()}


def columns(rows) -> set[tuple]:
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling(spark):
    counts = Counter()
    for doc_id, text in documents():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = crc(f"{doc_id}:{run}")
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = QUERIES["op11_spelling"](spark, FOLDER).collect()
    assert len(got) == len(counts)
    assert columns(got) == nearness(counts)


@pytest.mark.parametrize(("letters", "range_words"), [("aabé", 1000), ("aab", 40), ("ab", 5)])
def test_spelling_in_several_ranges(spark, letters, range_words):
    """Words that differ by little, chains of forms, and tries cut into many ranges."""
    prepare(spark)
    rng = random.Random(range_words)
    words = {"".join(rng.choices(letters, k=rng.randint(7, 9))) for _ in range(200)}
    counts = {w: rng.choice([2, 3, 20, 25, 200, 300, 2500, 30_000]) for w in words}
    counts["a" * 3000] = 7
    counts["a" * 2999] = 70
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert columns(spelling.variants(rows, range_words).collect()) == nearness(counts)


def test_spelling_edge_cases(spark):
    prepare(spark)
    rows = [(1, None, "x"), (2, "", "x"), (None, "wording Wording", "x"), (3, "WORDING words", "x"), (3, "WordinÀ wordinÀ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    found = spelling.variants(spelling.count_words(spelling.runs_of(docs)))
    assert columns(found.collect()) == {
        ("wording", None, "wording", 3, 1, None), ("wordinÀ", None, "wordinÀ", 2, 1, None)
    }
    assert spelling.variants(spelling.count_words(spelling.runs_of(docs.filter("doc_id = 1")))).count() == 0


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of maximal stretches, by comparing words one by one."""
    out = []
    ids = np.unique(np.array(words or [""]), return_inverse=True)[1]
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]]).astype(int)
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for i, j in zip(starts.tolist(), ends.tolist(), strict=True):
            if j + q - i >= max(6, 4 * q):
                part = words[i : j + q]
                if not any(part[k:] == part[:-k] for k in range(1, q)):
                    out.append((i, j + q - i, q))
    return sorted(out)


def plain_collapse(words: list, runs: list) -> str:
    lost = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in lost)


def best_of(runs: list):
    from fractions import Fraction

    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)


def test_periodic_runs(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    docs = documents()
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), crc(str(doc_id))
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        some += len(runs)
        row, best = got[doc_id], best_of(runs)
        assert (row.n_runs, (row.start, row.length, row.period)) == (len(runs), best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == sha("".join("%d,%d,%d\n" % r for r in runs))
        assert row.collapsed_sha256 == sha(plain_collapse(words, runs))
    assert some


def test_periodic_runs_of_random_texts():
    rng = random.Random(7)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words: list[str] = []
            while len(words) < rng.randint(0, 70):
                words += rng.choices("ab" if rng.random() < 0.6 else "abcd", k=rng.randint(1, 9)) * rng.randint(1, 8)
                words = words[: len(words) - rng.randint(0, 3)]
            texts.append(" ".join(words))
        sizes, runs, best, left = repeats.read_texts(texts)
        for i, text in enumerate(texts):
            words = text.split()
            wanted = plain_runs(words)
            assert sizes[i] == len(words)
            assert [tuple(r.values()) for r in runs[i]] == wanted
            assert (tuple(best[i].values()) if best[i] else (None,) * 3) == best_of(wanted)
            assert left[i] == plain_collapse(words, wanted)


def test_range_successors():
    rng = np.random.default_rng(2)
    values = rng.permutation(777)
    low = rng.integers(0, 777, 3000)
    high = low + rng.integers(0, 777 - low + 1)
    than = rng.integers(0, 777, 3000)
    got = repeats.WaveletMatrix(values).successors(low, high, than)
    for a, b, x, y in zip(low, high, than, got, strict=True):
        assert y == min((v for v in values[a:b] if v > x), default=-1)


def test_periodic_runs_edge_cases(spark):
    prepare(spark)
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (None, "a b " * 4, "x"), (4, "a " * 100_000, "x"), (4, "a a a a a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in repeats.find_runs(docs).collect()), key=str)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 8, [(0, 8, 2)], "a b"),
        (4, 100_000, [(0, 100_000, 1)], "a"), (4, 5, [], "a a a a a"),
    ], key=str)
    assert repeats.find_runs(docs.filter("false")).count() == 0


def plain_dedup(docs: list[tuple]) -> dict:
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[line.strip(WHITE).translate(UPPER)].add(doc_id)
    out = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        left = []
        for line in lines:
            key = line.strip(WHITE).translate(UPPER)
            if len(key) < 10 or len(holders[key]) < 2 or min(holders[key]) == doc_id:
                left.append(line)
        out[doc_id] = (len(lines), len(lines) - len(left), "\n".join(left))
    return out


def kept(index, docs) -> dict:
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in index.kept(docs).collect()}


def test_line_dedup(spark):
    got = {r.doc_id: r for r in QUERIES["op13_line_dedup"](spark, FOLDER).collect()}
    wanted = plain_dedup(documents())
    assert set(got) == set(wanted)
    for i, (n, gone, text) in wanted.items():
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (n, gone, sha(text))


def test_line_dedup_is_reversible(spark):
    """Deliveries, deletions and a delivery after reopening, with shards that double."""
    prepare(spark)
    rng = random.Random(5)
    pool = [f"Line number {i} of these" for i in range(30)] + ["short", "  ", "ÄBCDEFGHIJ"]

    def text(i):
        styles = [str.upper, str, lambda s: f"  {s}\t"]
        lines = [
            rng.choice(styles)(rng.choice(pool)) if rng.random() < 0.6 else f"own line {i} {rng.random()}"
            for _ in range(rng.randint(0, 6))
        ]
        return "\n".join(lines) if i % 17 else None

    docs = [(i, text(i)) for i in range(200)]

    def frame(part):
        return spark.createDataFrame(part, "doc_id long, text string")

    index = line_dedup.LineIndex(spark, line_dedup.LineIndex.temporary(spark).path, shard_keys=16)
    index.add(frame(docs[:120]))
    assert kept(index, frame(docs[:120])) == plain_dedup(docs[:120])
    index.add(frame(docs[120:]))
    assert index.bits >= 3
    assert kept(index, frame(docs)) == plain_dedup(docs)
    # the least holders go, so that others take their place
    index.remove(frame(docs[:50]).select("doc_id"))
    assert kept(index, frame(docs[50:])) == plain_dedup(docs[50:])
    again = line_dedup.LineIndex.open(spark, index.path, shard_keys=16)
    again.add(frame(docs[:50]))
    assert kept(again, frame(docs)) == plain_dedup(docs)
    assert again.keys == again.counts().count()


def test_line_dedup_edge_cases(spark):
    prepare(spark)
    line = "one line of some length"
    rows = [(1, None, "x"), (2, "", "x"), (3, f"{line}\n{line}", "x"), (3, line, "x"), (None, line, "x"), (4, f"a\n\t{line.upper()} \n", "x"), (5, line * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    index = line_dedup.LineIndex.temporary(spark)
    assert index.kept(docs).count() == len(rows)
    index.add(docs.filter("false"))
    index.add(docs)
    got = sorted((tuple(r) for r in index.kept(docs).collect()), key=str)
    assert got == sorted([
        (1, 1, 0, ""), (2, 1, 0, ""), (3, 2, 0, f"{line}\n{line}"), (3, 1, 0, line), (None, 1, 0, line),
        (4, 3, 1, "a\n"), (5, 1, 0, line * 20_000),
    ], key=str)


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, 12_000))
    known = line_dedup.CuckooFilter(1 << 12)
    known.insert(keys)
    known = line_dedup.CuckooFilter.loads(known.dumps(), 1 << 12)
    assert known.contains(keys).all()
    assert known.contains(rng.integers(-(2**63), 2**63 - 1, 50_000)).mean() < 0.001
    known.remove(keys[:6000])
    assert known.contains(keys[6000:]).all()
    assert not known.contains(keys[:6000]).any()
    # more of one fingerprint than its two buckets hold
    same = np.full(20, 12345)
    known = line_dedup.CuckooFilter(4)
    known.insert(same)
    known = line_dedup.CuckooFilter.loads(known.dumps(), 4)
    assert known.stash and known.contains(same[:1]).all()
    known.remove(same)
    assert not known.stash and not known.table.any()
