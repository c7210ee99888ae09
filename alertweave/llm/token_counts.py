"""Word-piece counts in linear time.

A trie of the vocabulary has failure links, and each node knows how many pieces are complete
when its link is taken. Reading a word once thus gives the number of pieces of the greedy
longest-match-first segmentation without building any piece.

Defined results: null, empty and blank texts have no words and no tokens; a word that the
vocabulary cannot segment is one unknown token; texts of any length are read whole; rows are
independent; an empty table gives an empty table; only kept columns reach the result, and a
kept column with a result's name gives way to it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame

from alertweave.llm.common import append_columns

# words kept in a task's cache before it starts anew
CACHE_WORDS = 400_000
VOCABULARY_BYTES = 64 << 20
# what the vocabulary writes after the last byte of a word
WORD_END = "</w>"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, others from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return letters


def symbols(word: bytes) -> tuple[int, ...]:
    """Bytes of a word; the last one is marked by 256."""
    return (*word[:-1], word[-1] + 256)


def pieces_of(vocabulary: Iterable[str]) -> set[tuple[int, ...]]:
    """Vocabulary entries as symbols; entries that are not made of bytes are left out."""
    letters = byte_letters()
    out = set()
    for entry in vocabulary:
        body = entry.removesuffix(WORD_END)
        if body and all(c in letters for c in body):
            piece = bytes(letters[c] for c in body)
            out.add(symbols(piece) if body != entry else tuple(piece))
    return out


class Automaton:
    """Trie with failure links and the number of pieces that each link completes."""

    def __init__(self, pieces: Iterable[tuple[int, ...]]) -> None:
        self.child: dict[tuple[int, int], int] = {}
        self.link: list[int] = [-1]
        self.done: list[int] = [0]
        ends = {0: False}
        for piece in sorted(pieces):
            node = 0
            for symbol in piece:
                node = self.child.setdefault((node, symbol), len(ends))
                ends.setdefault(node, False)
            ends[node] = True
        self.link *= len(ends)
        self.done *= len(ends)
        level = [(0, s, c) for (p, s), c in self.child.items() if p == 0]
        below: dict[int, list[tuple[int, int]]] = {}
        for (parent, symbol), node in self.child.items():
            below.setdefault(parent, []).append((symbol, node))
        while level:
            for parent, symbol, node in level:
                if ends[node]:
                    self.link[node], self.done[node] = 0, 1
                    continue
                at, done = self.link[parent], self.done[parent]
                while at >= 0 and (at, symbol) not in self.child:
                    at, done = self.link[at], done + self.done[at]
                if at >= 0:
                    self.link[node], self.done[node] = self.child[at, symbol], done
            level = [(n, s, c) for _, _, n in level for s, c in below.get(n, ())]

    def count(self, word: bytes) -> int:
        """Pieces of the word; 1 if it has no segmentation."""
        child, link, done = self.child, self.link, self.done
        node, n = 0, 0
        for symbol in symbols(word):
            while (following := child.get((node, symbol))) is None:
                if link[node] < 0:
                    return 1
                n += done[node]
                node = link[node]
            node = following
        while node:
            if link[node] < 0:
                return 1
            n += done[node]
            node = link[node]
        return n


class WordCounts(dict):
    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(word.encode("utf-8", "surrogatepass"))
        return n


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", keep: Iterable[str] = ("doc_id",)
) -> DataFrame:
    """``n_words`` (lower-cased, cut at white space) and ``n_tokens`` of every text."""
    with open(vocabulary, "rb") as file:  # an installed file, read by the driver
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"vocabulary larger than {VOCABULARY_BYTES} bytes")
    entries = list(json.loads(data)["model"]["vocab"])
    shared = docs.sparkSession.sparkContext.broadcast(entries)

    def start():
        counts = WordCounts(Automaton(pieces_of(shared.value)))

        def work(texts):
            split = [(t or "").lower().split() for t in texts]
            return [
                [len(words) for words in split],
                [sum(map(counts.__getitem__, words)) for words in split],
            ]

        return work

    return append_columns(docs, text, keep, "n_words long, n_tokens long", start)
