"""Each operator's query against a plain version of what it computes, over whole tables."""

from __future__ import annotations

import hashlib
import html
import json
import math
import re
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

import __spark_entry__ as contract
from alertweave.llm import bpe, chat, decontaminate, secret_scan, token_counts, topk

FOLDER = "/root/testdata/sf0.001"
# with labels to learn from and secrets to find
LARGER = "/root/testdata/sf0.01"
QUERIES = contract.queries()


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def rows_of(name: str, folder: str = FOLDER) -> list[dict]:
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def result(spark, name: str, folder: str = FOLDER) -> list[dict]:
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def components(sets: dict[int, frozenset]) -> dict[int, int]:
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        overlap = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    overlap[j] += 1
        for j, n in overlap.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_token_counts(spark):
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        pieces = token_counts.pieces_of(json.load(file)["model"]["vocab"])

    def greedy(word):
        symbols = token_counts.symbols(word.encode())
        i = n = 0
        while i < len(symbols):
            j = next((j for j in range(len(symbols), i, -1) if symbols[i:j] in pieces), None)
            if j is None:
                return 1
            i, n = j, n + 1
        return n

    wanted = {r["doc_id"]: sum(map(greedy, (r["text"] or "").lower().split())) for r in rows_of("documents")}
    assert {r["doc_id"]: r["n_tokens"] for r in result(spark, "op1_token_counts")} == wanted


def leaks(text: str | None, items: list[dict], window: int = 10):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = re.findall(word, ascii_lower(text or ""))
    hit, found = set(), set()
    for item in items:
        own = re.findall(word, ascii_lower(item["text"] or ""))
        for k in range(max(1, len(own) - window + 1) if own else 0):
            part = own[k : k + window]
            for i in range(len(words) - len(part) + 1):
                if words[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    found.add(str(item["item_id"]))
    return len(words), len(hit), sorted(found)


def test_decontamination(spark):
    items = rows_of("benchmark")
    got = {r["doc_id"]: r for r in result(spark, "op2_decontamination")}
    docs = rows_of("documents")
    assert len(got) == len(docs)
    for r in docs:
        n, hit, found = leaks(r["text"], items)
        row = got[r["doc_id"]]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, hit, len(found))
        assert row["items_sha256"] == sha(",".join(found))
        assert row["contaminated"] == (hit > 0)


def reference_encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark):
    encoding = reference_encoding()
    got = {r["doc_id"]: r for r in result(spark, "op3_byte_bpe")}
    for r in rows_of("documents"):
        text = r["text"] or ""
        ids = encoding.encode_ordinary(text)
        row = got[r["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(b"".join(i.to_bytes(4, "little") for i in ids))
        assert row["decoded_sha256"] == sha(text)


def test_toxicity_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in rows_of("labels", LARGER)}
    rows = QUERIES["op4_toxicity"](spark, LARGER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = ([h for h in held if h[2] == y] for y in (1, 0))
    pairs = [(a[0] > b[0]) + 0.5 * (a[0] == b[0]) for a in toxic for b in clean]
    assert sum(pairs) / len(pairs) > 0.85
    assert sum(h[1] for h in toxic) >= 0.7 * len(toxic)
    assert sum(h[1] for h in clean) <= 0.05 * len(clean)


def test_top_k(spark):
    vectors = {}
    for r in rows_of("embeddings"):
        x = r["embedding"]
        if x is not None and all(c is not None and math.isfinite(c) for c in x):
            vectors[r["vec_id"]] = [math.floor(256 * c) for c in x]
    wanted = []
    for q, x in vectors.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors.items() if i != q)
            wanted += [(q, k, i, -s) for k, (s, i) in enumerate(scores[:5], 1)]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in result(spark, "op5_topk")]
    assert sorted(got) == sorted(wanted)


def test_top_k_visits_all_that_is_in_reach(spark, monkeypatch):
    """With small blocks, one of them per visit, results need the second visit."""
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 8)
    monkeypatch.setattr(topk, "FIRST_BLOCKS", 1)
    test_top_k(spark)


def test_ngram_join(spark):
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows_of("documents")}
    wanted = components({i: s for i, s in sets.items() if s})
    got = {r["doc_id"]: r for r in result(spark, "op6_ngram_join")}
    assert len(got) == len(sets)
    for i, s in sets.items():
        assert got[i]["n_shingles"] == len(s)
        assert got[i]["component_id"] == wanted.get(i, i)


def test_chat(spark):
    said = "</s>[INST] ok [/INST]"
    rows = rows_of("conversations") + [
        {"conv_id": -7, "turn": t, "role": r, "text": said} for t, r in enumerate(("user", "assistant"))
    ]
    chats = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        chats[r["conv_id"]].append((r["role"], r["text"] or ""))
    got = {r["conv_id"]: r for r in result(spark, "op7_chat")}
    assert set(got) == set(chats)
    for conv, turns in chats.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for role, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha(loss))
        pieces = (p for role, t in turns for p, _ in chat.TEMPLATE.segments(role, t))
        assert row["formatted_chars"] == sum(map(len, pieces))


def test_secrets(spark):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    got = {r["doc_id"]: r for r in result(spark, "op8_secrets", LARGER)}
    some = 0
    for r in rows_of("documents", LARGER):
        text = r["text"] or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        some += len(spans)
        row = got[r["doc_id"]]
        for order, kind in enumerate(("assign", "access", "hex")):
            assert row[f"n_{kind}"] == sum(s[1] == order for s in spans)
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        assert row["base_sha256"] == sha(listed)
        assert set(listed.split(",")) <= set(row["spans"].split(","))
    assert some


def test_html(spark):
    got = {r["page_id"]: r for r in result(spark, "op10_html")}
    pages = rows_of("pages")
    assert len(got) == len(pages)
    for r in pages:
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", body))
        texts = [" ".join(html.unescape(b).split()) for b in blocks]
        text = " ".join(t for t in texts if t)
        row = got[r["page_id"]]
        assert (row["url"], row["text"], row["n_chars"]) == (r["url"], text, len(text))


def test_pipeline(spark):
    """Against the stages' rules, applied one after the other to what the stage before kept."""
    import corpus_pipeline

    folder, docs = FOLDER, corpus_pipeline.table(spark, FOLDER, "documents")
    encoding, items = reference_encoding(), rows_of("benchmark")
    before = {r["doc_id"]: r for r in rows_of("documents")}
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.cut(stage(spark, docs, folder))
        if name != "byte_bpe":
            assert frame.columns == docs.columns
        after = {r.doc_id: r.asDict() for r in frame.collect()}
        assert after
        if name == "near_duplicates":
            wanted = components({i: s for i, r in before.items() if (s := shingles(r["text"]))})
            assert set(after) == {i for i in before if wanted.get(i, i) == i}
        if name == "decontamination":
            assert set(after) == {i for i, r in before.items() if not leaks(r["text"], items)[1]}
        if name in ("toxicity", "near_duplicates", "decontamination"):
            assert all(before[i] == r for i, r in after.items())
        if name == "secrets":
            assert set(after) == set(before)
            for i, r in after.items():
                assert r["n_chars"] == len(r["text"])
                for rule in secret_scan.RULES:
                    assert not secret_scan.matches(rule, rule.compiled(), r["text"])
                    if not secret_scan.matches(rule, rule.compiled(), before[i]["text"]):
                        continue
                    assert "[SECRET]" in r["text"]
        if name == "byte_bpe":
            assert set(after) == set(before)
            for i, r in after.items():
                assert r["ids_sha256"] == sha(r["ids"]) and r["decoded_sha256"] == sha(before[i]["text"])
                assert r["n_tokens"] == len(encoding.encode_ordinary(before[i]["text"]))
        docs, before = frame, after


@pytest.mark.parametrize("blocks", [1, 300])
def test_decontamination_in_several_automata(spark, blocks):
    text = "One two three four five six seven eight nine ten eleven é twelve"
    docs = spark.createDataFrame(
        [(1, text, "x"), (2, None, "y"), (3, "!!", "z"),
         (4, "a b", "n_words")],
        "doc_id long, text string, n_hit string",
    )
    items = spark.createDataFrame(
        [(5, "two THREE four five six seven eight nine ten eleven"), (6, "A b!"), (None, "twelve"), (7, None), (8, "")],
        "item_id long, text string",
    )
    got = decontaminate.find_leaks(docs, items, keep=["doc_id", "n_hit"], block_bytes=1 << 20 if blocks == 1 else 8)
    rows = {r.doc_id: r for r in got.collect()}
    assert (rows[1].n_words, rows[1].n_hit, rows[1].item_ids) == (13, 11, ["5", "null"])
    hit = [text[s.start : s.end] for s in rows[1].spans]
    assert hit == ["two three four five six seven eight nine ten eleven", "twelve"]
    assert (rows[2].n_words, rows[2].n_hit, rows[3].n_words) == (0, 0, 0)
    assert (rows[4].n_hit, rows[4].item_ids) == (2, ["6"])


def test_decontamination_knows_only_the_contract_s_separators(spark):
    """White space beyond ASCII is part of a word, in items as in documents."""
    docs = spark.createDataFrame(
        [(1, "x a\u00a0b c y"), (2, "a b c"), (3, "\u3000 d\u2028e"), (4, "d e")], "doc_id long, text string"
    )
    items = spark.createDataFrame([(1, "A\u00a0B, c"), (2, "\u3000\nD\u2028E")], "item_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in decontaminate.find_leaks(docs, items).collect()}
    assert rows == {1: (4, 2, ["1"]), 2: (3, 0, []), 3: (2, 2, ["2"]), 4: (2, 0, [])}
