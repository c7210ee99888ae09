"""Toxicity by a linear-chain conditional random field.

Tokens of a document are clean or toxic. Their labels are learned from document labels: in
toxic documents, words whose forms are far likelier there than in clean ones are toxic. The
field has a weight for each hashed form of a word (the word, its beginnings and its end) and
for each pair of neighbouring labels. Forward-backward marginals of a text give the offending
spans, and their strongest value and sum, calibrated on documents that were not used for the
weights, the score of the document.

Training reads a bounded sample of labelled rows (``TRAIN_DOCS``, ``TRAIN_CHARS``,
``TRAIN_SENTENCES``); every
document is scored, whole. Labels, languages, sources and ids are no inputs of a score.

Defined results: null, empty and wordless texts get the score of a text without marginals;
an empty or one-sided training set gives score 0 everywhere; documents that repeat an id are
scored each; label rows that are null or contradict each other count as they are; an empty
table gives an empty table; only kept columns reach the result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.llm.common import append_columns

# bounds of the training sample: documents per label, characters of a document
TRAIN_DOCS = {1: 1500, 0: 4000}
TRAIN_CHARS = 20_000
# sentences with and without toxic words that the weights are fitted to
TRAIN_SENTENCES = 20_000
THRESHOLD = 0.3
# hashed forms
SLOTS = 1 << 18
# a span's tokens have at least this marginal
SPAN_MARGINAL = 0.5
CACHE_WORDS = 400_000

TOKEN = re.compile(r"\w+|[.!?\n]")
STOPS = frozenset(".!?\n")
BEGINNINGS = (3, 4, 5, 6)


def forms(word: str) -> list[str]:
    """What the field looks at: the word, its beginnings and its last letters."""
    return [f"w{word}", *(f"{n}{word[:n]}" for n in BEGINNINGS if len(word) >= n), f"e{word[-3:]}"]


def slots(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % SLOTS for f in forms(word)]


def is_held_out(doc_id: Column) -> Column:
    """The fixed fold that no training sees."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2


def sentences(words: list[str]) -> np.ndarray:
    """Number of the sentence of each token; marks end one and belong to none (-1)."""
    marks = np.fromiter((w in STOPS for w in words), bool, len(words))
    number = np.cumsum(marks)
    number[marks] = -1
    return number


@dataclass
class Chains:
    """Sentences side by side, the longest first, so that all are read token by token."""

    order: np.ndarray  # positions of tokens, token by token, longest sentence first
    width: np.ndarray  # sentences that have a token at each step

    @staticmethod
    def of(sentence: np.ndarray) -> Chains:
        """``sentence`` numbers the sentence of each token, -1 for none, ascending."""
        tokens = np.flatnonzero(sentence >= 0)
        if not len(tokens):
            return Chains(tokens, np.zeros(0, np.int64))
        _, first, length = np.unique(sentence[tokens], return_index=True, return_counts=True)
        by_length = np.argsort(-length, kind="stable")
        first, length = first[by_length], length[by_length]
        width = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
        order = np.concatenate([tokens[first[:w] + i] for i, w in enumerate(width)])
        return Chains(order, width)


def marginals(emission: np.ndarray, chains: Chains, moves: np.ndarray):
    """Marginals of the toxic label, in the order of ``chains``, and of label pairs, summed.

    ``emission`` is the toxic label's log weight of each token in that order; ``moves`` is a
    2 x 2 matrix of log weights, from clean and toxic to clean and toxic.
    """
    scores = np.exp(np.stack([np.zeros_like(emission), np.clip(emission, -30, 30)], 1))
    weights, starts = np.exp(moves), np.concatenate([[0], np.cumsum(chains.width)])
    ahead, back = np.empty_like(scores), np.ones_like(scores)
    pairs = np.zeros((2, 2))
    for i, w in enumerate(chains.width):
        a = starts[i]
        now = scores[a : a + w]
        if i:
            now = now * (ahead[starts[i - 1] : starts[i - 1] + w] @ weights)
        ahead[a : a + w] = now / now.sum(1, keepdims=True)
    for i in range(len(chains.width) - 2, -1, -1):
        a, b, w = starts[i], starts[i + 1], chains.width[i + 1]
        later = scores[b : b + w] * back[b : b + w]
        now = later @ weights.T
        joint = ahead[a : a + w, :, None] * weights[None] * later[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        back[a : a + w] = now / now.sum(1, keepdims=True)
    both = ahead * back
    return both[:, 1] / both.sum(1), pairs


@dataclass
class Field:
    """Weights of forms and of neighbouring labels, and the calibration of a document."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    calibration: np.ndarray

    def token_marginals(self, emission: np.ndarray, sentence: np.ndarray) -> np.ndarray:
        """Marginals by token; 0 for marks."""
        out = np.zeros(len(emission))
        chains = Chains.of(sentence)
        if len(chains.order):
            out[chains.order], _ = marginals(emission[chains.order], chains, self.moves)
        return out

    def emission(self, word: str) -> float:
        return 0.0 if word in STOPS else self.bias + float(self.weights[slots(word)].sum())

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(values @ self.calibration, -30, 30)))


def summary(found: np.ndarray) -> list[float]:
    """What the calibration sees of a document's marginals."""
    top = np.clip(found.max() if len(found) else 0.0, 1e-6, 1 - 1e-6)
    strong = found[found > 0.1].sum() if len(found) else 0.0
    return [1.0, float(np.log(top / (1 - top))), float(np.log1p(strong))]


def toxic_words(docs: list[tuple[list[str], int]]) -> set[str]:
    """Words of toxic documents one of whose forms is far likelier there."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    total = [0, 0]
    for words, label in sorted(docs, key=lambda d: -d[1]):
        total[label] += 1
        found = {f for w in set(words) - STOPS for f in forms(w) if f[0] != "e"}
        # forms that no toxic document has are of no interest
        seen[label].update(found if label else found & seen[1].keys())
    strong = {
        f
        for f, n in seen[1].items()
        if n >= 3
        and len(f) > 3
        and np.log((n + 0.5) / (total[1] + 1)) - np.log((seen[0][f] + 0.5) / (total[0] + 1)) > 2.5
        and n / total[1] > 8 * seen[0][f] / max(1, total[0])
    }
    every = {w for words, label in docs if label for w in words}
    return {w for w in every if w not in STOPS and not strong.isdisjoint(forms(w))}


def fit(docs: list[tuple[str, int]], seed: int = 7) -> Field:
    """Weights from the documents; the calibration from a quarter that they leave out."""
    rng = np.random.default_rng(seed)
    pool: dict[str, str] = {}  # one object for each word
    split = [([pool.setdefault(w, w) for w in TOKEN.findall(text.lower())], y) for text, y in docs]
    side = rng.random(len(split)) < 0.75
    learn = [d for d, s in zip(split, side, strict=True) if s]
    check = [d for d, s in zip(split, side, strict=True) if not s]
    if len({label for _, label in learn}) < 2 or len({label for _, label in check}) < 2:
        return Field(np.zeros(SLOTS), 0.0, np.zeros((2, 2)), np.array([-30.0, 0.0, 0.0]))
    field = fit_weights(learn, rng)
    values = []
    for d, _ in check:
        emission = np.array([field.emission(w) for w in d])
        values.append(summary(field.token_marginals(emission, sentences(d))))
    field.calibration = logistic(np.array(values), np.array([y for _, y in check], float))
    return field


def fit_weights(docs: list[tuple[list[str], int]], rng, rounds: int = 5) -> Field:
    """Adaptive gradient ascent of the label sequences' likelihood, in parts of the sentences."""
    field = Field(np.zeros(SLOTS + 1), -2.0, np.zeros((2, 2)), np.array([-30.0, 0.0, 0.0]))
    toxic = toxic_words(docs)
    words = [w for d, _ in docs for w in [*d, "\n"]]
    number = sentences(words)
    labels = np.array([w in toxic and bool(y) for d, y in docs for w in [*d, "\n"]])
    index: dict[str, int] = {}
    word = np.array([index.setdefault(w, len(index)) for w in words])
    # slots of each word, filled up with one whose weight stays 0
    known = np.full((len(index), len(BEGINNINGS) + 2), SLOTS)
    for w, i in index.items():
        if w not in STOPS:
            found = slots(w)
            known[i, : len(found)] = found
    inside = np.flatnonzero(number >= 0)
    groups, first, length = np.unique(number[inside], return_index=True, return_counts=True)
    starts = inside[first]
    has = np.zeros(len(groups), bool)
    has[np.searchsorted(groups, number[inside[labels[inside]]])] = True
    chosen = [
        rng.permutation(np.flatnonzero(has == kind))[:TRAIN_SENTENCES] for kind in (True, False)
    ]
    chosen = np.concatenate(chosen)
    squares, moved, bias_square = np.full(SLOTS + 1, 1e-2), np.full((2, 2), 1.0), 1.0
    for _ in range(rounds):
        for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // 4000)):
            part = np.sort(part)
            tokens = np.concatenate([np.arange(a, a + n) for a, n in zip(starts[part], length[part])])
            chains = Chains.of(number[tokens])
            at = tokens[chains.order]
            ids = known[word[at]]
            emission = field.bias + field.weights[ids].sum(1)
            found, pairs = marginals(emission, chains, field.moves)
            gap = labels[at] - found
            gradient = np.bincount(ids.ravel(), np.repeat(gap, ids.shape[1]), SLOTS + 1)
            gradient -= 0.02 * field.weights
            gradient[SLOTS] = 0.0
            squares += gradient**2
            field.weights += 0.5 * gradient / np.sqrt(squares)
            bias_square += gap.sum() ** 2
            field.bias += 0.5 * gap.sum() / np.sqrt(bias_square)
            change = true_pairs(labels[at].astype(int), chains) - pairs - 0.02 * field.moves
            moved += change**2
            field.moves += 0.3 * change / np.sqrt(moved)
    return field


def true_pairs(labels: np.ndarray, chains: Chains) -> np.ndarray:
    """How often each pair of labels is next to each other."""
    edge = np.concatenate([[0], np.cumsum(chains.width)])
    out = np.zeros(4)
    for i in range(len(chains.width) - 1):
        w = chains.width[i + 1]
        before, after = labels[edge[i] : edge[i] + w], labels[edge[i + 1] : edge[i + 1] + w]
        out += np.bincount(before * 2 + after, minlength=4)
    return out.reshape(2, 2)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method with a small penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def training_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int]]:
    """At most ``TRAIN_DOCS`` documents of each label, chosen by a hash of their id."""
    known = labels.select("doc_id", "toxic").filter("toxic in (0, 1) and doc_id is not null")
    known = known.filter(~is_held_out(F.col("doc_id"))).distinct()
    order = F.xxhash64("doc_id", F.lit("sample")), F.col("doc_id")
    chosen = [
        known.filter(F.col("toxic") == label).orderBy(*order).limit(n)
        for label, n in TRAIN_DOCS.items()
    ]
    # the sample's ids are bounded by TRAIN_DOCS
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select("doc_id", "text").filter(F.length("text").between(1, TRAIN_CHARS))
    rows = texts.join(ids, "doc_id").orderBy("doc_id", "toxic", "text").limit(sum(TRAIN_DOCS.values()))
    return [(r.text, r.toxic) for r in rows.select("text", "toxic").collect()]


def train(docs: DataFrame, labels: DataFrame) -> Field:
    return fit(training_sample(docs, labels))


class Emissions(dict):
    def __init__(self, field: Field) -> None:
        self.field = field

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = self.field.emission(word)
        return value


def tag(
    docs: DataFrame,
    field: Field,
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``score``, ``predicted`` and ``spans`` (start, end, marginal) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def start():
        model = shared.value
        emissions = Emissions(model)

        def work(texts):
            lowered = [(t or "").lower() for t in texts]
            words = [TOKEN.findall(t) for t in lowered]
            flat = [w for d in words for w in [*d, "\n"]]
            values = np.fromiter(map(emissions.__getitem__, flat), float, len(flat))
            found = model.token_marginals(values, sentences(flat))
            out: list[list] = [[], [], []]
            at = 0
            for t, low, d in zip(texts, lowered, words, strict=True):
                mine = found[at : at + len(d)]
                at += len(d) + 1
                score = float(model.score(np.array(summary(mine))))
                out[0].append(score)
                out[1].append(int(score >= threshold))
                out[2].append(spans_of(t or "", low, mine))
            return out

        return work

    fields = "score double, predicted int, spans array<struct<start: int, end: int, marginal: double>>"
    return append_columns(docs, text, keep, fields, start)


def spans_of(text: str, lowered: str, found: np.ndarray) -> list[dict]:
    """Offsets of toxic tokens in the text as it was; lowering may have made it longer."""
    hits = np.flatnonzero(found >= SPAN_MARGINAL)
    if not len(hits):
        return []
    at = np.array([m.span() for m in TOKEN.finditer(lowered)])[hits]
    if len(lowered) != len(text):
        ends = np.cumsum([len(c.lower()) for c in text])
        at = np.searchsorted(ends, at - [0, 1], side="right") + [0, 1]
    return [
        {"start": a, "end": b, "marginal": m}
        for (a, b), m in zip(at.tolist(), found[hits].tolist(), strict=True)
    ]
