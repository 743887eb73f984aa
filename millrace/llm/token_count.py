"""Token counts by heap-and-linked-list byte-pair merging.

A piece of text starts as a linked list of byte symbols and a heap of its
adjacent pairs by rank. The lowest rank is popped and merged again and again;
the number of tokens is the number of initial symbols minus the merges. No
token id is ever emitted.

Rows are independent: one pass, no shuffle. Counts of pieces are remembered
per task in a table of bounded size, since natural text repeats its words.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata

import regex
from pyspark.sql import DataFrame

from millrace.llm.common import per_batch, texts

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

#: The contractions and classes that split text before the merges.
_SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: A blank beside a space: there a space need not start a piece.
_CROWDED = regex.compile(r"[ ]\s|\s[ ]")
_REMEMBERED_LENGTH = 64


def initial_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in the vocabulary file: a byte that is a
    visible Latin-1 character stands for itself, the others follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


#: Stands in for a character that the tokenizer takes for neither letter nor number.
_OTHER = "\uffff"


@functools.cache
def young_characters() -> frozenset[str]:
    """Letters and numbers of ``regex`` that this Python's character database does
    not know yet. The tokenizer does not know them either."""
    unassigned = "".join(chr(c) for c in range(0x110000)
                         if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn")
    return frozenset(regex.findall(r"[\p{L}\p{N}]", unassigned))


def pieces(text: str) -> list[str]:
    if text.isascii() or young_characters().isdisjoint(text):
        return _SPLIT.findall(text)
    young = young_characters()
    shape = "".join(_OTHER if c in young else c for c in text)
    return [text[m.start():m.end()] for m in _SPLIT.finditer(shape)]


@functools.cache
def counter_for(path: str) -> MergeCounter:
    """One counter per vocabulary and worker process."""
    return MergeCounter(path)


class MergeCounter:
    """Counts of tokens by a vocabulary file with merges.

    ``remembered`` bounds the pieces whose counts a task keeps; when as many
    new ones have come, the older half is forgotten.
    """

    def __init__(self, path: str, remembered: int = 400_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary = model["vocab"]
        alphabet = initial_alphabet()
        self.symbols = [vocabulary[alphabet[b]] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = (vocabulary[left], vocabulary[right])
            self.merges.setdefault(key, (rank, vocabulary[left + right]))
        special = [t["content"] for t in spec.get("added_tokens", []) if t["content"]]
        longest_first = sorted(special, key=lambda s: (-len(s), s))
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if special else None
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.half = max(1, remembered // 2)

    def merged(self, data: bytes) -> int:
        """Tokens of one piece: symbols minus merges."""
        ids = [self.symbols[b] for b in data]
        count = len(ids)
        merges = self.merges
        heap = [(*merges[pair], i, pair) for i, pair in enumerate(zip(ids, ids[1:]))
                if pair in merges]
        if not heap:
            return count
        heapq.heapify(heap)
        after = [*range(1, count), -1]
        before = list(range(-1, count - 1))
        while heap:
            _, new, left, pair = heapq.heappop(heap)
            right = after[left]
            # Stale: one of the two symbols has been merged since.
            if right < 0 or ids[left] != pair[0] or ids[right] != pair[1]:
                continue
            ids[left], ids[right] = new, -1
            count -= 1
            following = after[left] = after[right]
            after[right] = -1
            if following >= 0:
                before[following] = left
                pair = (new, ids[following])
                if pair in merges:
                    heapq.heappush(heap, (*merges[pair], left, pair))
            previous = before[left]
            if previous >= 0:
                pair = (ids[previous], new)
                if pair in merges:
                    heapq.heappush(heap, (*merges[pair], previous, pair))
        return count

    def piece(self, text: str) -> int:
        return len(text) if len(text) == 1 and text.isascii() else self.merged(text.encode())

    def chunk(self, text: str) -> int:
        """Tokens of a stretch that begins and ends at a piece's border."""
        found = self.young.get(text)
        if found is not None:
            return found
        found = self.old.get(text)
        if found is None:
            found = sum(map(self.piece, pieces(text)))
        if len(text) <= _REMEMBERED_LENGTH:
            if len(self.young) >= self.half:
                self.old, self.young = self.young, {}
            self.young[text] = found
        return found

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings.

        A space between two characters that are not blank always starts a
        piece, so the text may be cut there before the pattern is applied.
        """
        if not text:
            return 0
        if _CROWDED.search(text):
            return sum(map(self.chunk, _cut_at_lone_spaces(text)))
        first, *rest = text.split(" ")
        count, known = (self.chunk(first) if first else 0), self.young.get
        for word in rest:
            word = " " + word
            found = known(word)
            count += self.chunk(word) if found is None else found
        return count

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return (sum(map(self.plain, self.special.split(text)))
                + len(self.special.findall(text)))


_LONE_SPACE = regex.compile(r"(?<=\S)(?=[ ]\S)")


def _cut_at_lone_spaces(text: str) -> list[str]:
    cuts = [0, *(m.start() for m in _LONE_SPACE.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """Tokens of each document's whole text, special strings counted as one token.

    NULL and empty texts have no bytes and no tokens. Every row of ``docs``
    gives one row, repeated and NULL ids included; other columns are left out.
    """
    def make():
        counter = counter_for(vocabulary)

        def step(batch):
            whole = texts(batch)
            counts = [counter.count(t) for t in whole]
            return {
                "doc_id": batch.column("doc_id"),
                "n_bytes": [len(t.encode()) for t in whole],
                "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
            }
        return step

    return per_batch(docs.select("doc_id", "text"), SCHEMA, make)
