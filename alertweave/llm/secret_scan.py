"""Secret scans over a trigram index.

Every rule's regex is turned into a Boolean query over trigrams that any match must contain.
The texts of a batch are indexed by those trigrams, postings are intersected and united, and
only candidates are verified with the regex. A rule without mandatory trigrams reads every
text. The index is local to a batch, so nothing is shuffled and nothing is collected.

Defined results: null text has no spans; texts of any length are scanned whole; rows are
independent; an empty table gives an empty table; only kept columns reach the result, and a
kept column with a result's name gives way to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as op
from re import _parser as regex_parser

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.llm.common import append_columns

# sets of strings that a part of a regex can match are followed up to this size
EXACT_STRINGS = 64
CLASS_LETTERS = 4


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if ``group`` of it has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = re.ASCII

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, self.flags)


BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        flags=re.ASCII | re.IGNORECASE,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # runs that are shorter than 24 characters never count
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
# the key itself: all up to its end mark, which no other key begins before, or where there is none,
# the fields and lines, or long words, of its base64 block
KEY_BODY = (
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END (?:[A-Z]+ )*PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:(?:[\s>#*|]|\\[nrt])*+(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset):(?:(?!\\n)[^\r\n])*)*+"
    r"(?:(?:[\s>#*|\"',]|\\[nrt])*+[A-Za-z0-9+/]{16,}+={0,2}"
    r"|(?:\r?\n|\\n)[ \t>#*|]*+=?[A-Za-z0-9+/]++={0,2}(?=[ \t]*+(?:\r?\n|\\n|\Z)))*+)"
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY(?: BLOCK)?-----" + KEY_BODY),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    # no start inside a run and no way back into one, so that nothing is read twice
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+"),
)
RULES = BASE_RULES + MORE_RULES

# a query is True (any text), a trigram, or ("and" | "or", queries)
Query = bool | bytes | tuple


def both(queries: Iterable[Query]) -> Query:
    parts = tuple(dict.fromkeys(q for q in queries if q is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def either(queries: Iterable[Query]) -> Query:
    parts = tuple(dict.fromkeys(queries))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", parts)


def of_strings(strings: Iterable[str]) -> Query:
    """What a text that holds one of the strings must contain."""
    found = []
    for string in sorted(strings):
        data = string.encode().lower()
        found.append(both(data[i : i + 3] for i in range(len(data) - 2)))
    return either(found)


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """Trigrams, lower-cased, that every match of the regex contains."""
    exact, query, _ = _sequence(regex_parser.parse(pattern, flags))
    return both([query, of_strings(exact)])


def _sequence(items) -> tuple[set[str], Query, bool]:
    """Strings that the end of the part can be, what came before, if that end is all of it."""
    exact: set[str] = {""}
    whole = True
    queries: list[Query] = []
    for item in items:
        strings, query = _part(*item)
        if query is not True:
            queries.append(query)
        if strings is not None and len(exact) * len(strings) <= EXACT_STRINGS:
            exact = {a + b for a in exact for b in strings}
            continue
        queries.append(of_strings(exact))
        exact = {""} if strings is None else strings
        whole = False
    return exact, both(queries), whole


def _part(kind, value) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return {chr(value)}, True
    if kind is op.IN:
        letters = {chr(v) for k, v in value if k is op.LITERAL}
        plain = all(k is op.LITERAL for k, _ in value)
        return (letters if plain and len(letters) <= CLASS_LETTERS else None), True
    if kind is op.SUBPATTERN:
        return _closed(value[3])
    if kind is op.BRANCH:
        ways = [_closed(way) for way in value[1]]
        if all(strings is not None for strings, _ in ways):
            every = set().union(*(strings for strings, _ in ways))
            if len(every) <= EXACT_STRINGS:
                return every, True
        return None, either(
            both([q, of_strings(s) if s is not None else True]) for s, q in ways
        )
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, inner = value
        strings, query = _closed(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, True
        if low == 0:
            return None, True
        if strings is not None and low == high and len(strings) ** low <= EXACT_STRINGS:
            repeated = {""}
            for _ in range(low):
                repeated = {a + b for a in repeated for b in strings}
            return repeated, True
        return None, both([query, of_strings(strings) if strings is not None else True])
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}, True
    return None, True


def _closed(items) -> tuple[set[str] | None, Query]:
    """A part as one: its exact strings if nothing else is in it."""
    exact, query, whole = _sequence(items)
    if whole:
        return exact, query
    return None, both([query, of_strings(exact)])


def needed(query: Query) -> set[bytes]:
    if query is True:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*(needed(q) for q in query[1]))


class Index:
    """Postings of the trigrams that some rule asks for, for one batch of texts."""

    def __init__(self, trigrams: Iterable[bytes]) -> None:
        self.number = {t: i + 1 for i, t in enumerate(sorted(trigrams))}
        self.known = np.zeros(1 << 24, np.uint16)
        for trigram, i in self.number.items():
            self.known[int.from_bytes(trigram)] = i

    def postings(self, texts: list[str]) -> dict[bytes, np.ndarray]:
        data = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        joined = np.frombuffer(b"\0".join(data) + b"\0\0", np.uint8).astype(np.uint32)
        codes = (joined[:-2] << 16) | (joined[1:-1] << 8) | joined[2:]
        found = self.known.take(codes)
        at = np.flatnonzero(found)
        ends = np.cumsum([len(d) + 1 for d in data])
        owner = np.searchsorted(ends, at, side="right")
        pairs = np.unique(found[at].astype(np.int64) * (len(texts) + 1) + owner)
        which, rows = np.divmod(pairs, len(texts) + 1)
        return {t: rows[which == i] for t, i in self.number.items()}


def candidates(query: Query, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Rows whose text can match."""
    if query is True:
        return np.arange(n)
    if isinstance(query, bytes):
        return postings[query]
    sets = [candidates(q, postings, n) for q in query[1]]
    out = sets[0]
    for rows in sets[1:]:
        out = np.intersect1d(out, rows) if query[0] == "and" else np.union1d(out, rows)
    return out


def matches(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, without those that are too short."""
    return [m.span() for m in pattern.finditer(text) if len(m[rule.group]) >= rule.least]


def scan_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
) -> DataFrame:
    """``spans`` (kind, start, end in code points) of every text, by start, then by rule."""

    def start():
        compiled = [(rule, rule.compiled(), trigram_query(rule.pattern, rule.flags)) for rule in rules]
        index = Index(set().union(*(needed(query) for _, _, query in compiled)))

        def work(texts):
            texts = [t or "" for t in texts]
            postings = index.postings(texts)
            spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for order, (rule, pattern, query) in enumerate(compiled):
                for row in candidates(query, postings, len(texts)).tolist():
                    spans[row] += [(a, order, b) for a, b in matches(rule, pattern, texts[row])]
            return [
                [
                    [{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(found)]
                    for found in spans
                ]
            ]

        return work

    fields = "spans array<struct<kind: string, start: int, end: int>>"
    return append_columns(docs, text, keep, fields, start)


def span_list(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        spans,
        start,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                    F.lit(mark),
                ).alias("out"),
            ),
        ).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
