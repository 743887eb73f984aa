"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The queue holds one bucket per merge rank with positions of a linked list of
symbols, and two levels of 256-bit words that tell which buckets hold any. The next
rank is found by find-first-set from the top word down. Entries that a
merge has made stale are skipped when they come up. Pushing and popping cost the same
however long the piece is, which suits very long pieces.

Rows are independent: one pass, no shuffle. Texts are cut into stretches that the pattern
treats apart, and different stretches are found, as Arrow columns; their ids are put together
by one take. Ids of pieces are remembered per task in a table of bounded size; the new ones of
some texts go through the queue at once, so that one pop serves many of them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from millrace.llm.common import held, per_batch, slices

COLUMNS = {
    "doc_id": "bigint", "n_tokens": "bigint", "ids": "array<int>", "ids_sha256": "string",
    "decoded": "binary", "decoded_sha256": "string",
}
_REMEMBERED_LENGTH = 64
#: Pieces that a codec keeps with their ids.
REMEMBERED = 600_000
#: Bytes of text that are coded together.
_TOGETHER = 4_000_000
#: Bytes of pieces that share the queue.
_MERGED = 100_000
_ID = np.dtype("<i4")


_WIDTH = 256
_BIT = [1 << i for i in range(_WIDTH)]


class RankQueue:
    """A queue of (rank, position), lowest rank first, equal ranks by position.

    ``low`` has a bit per rank, ``top`` one per word of ``low``. Ranks above
    ``_WIDTH`` squared make ``top`` longer, not the number of levels larger.
    """

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // _WIDTH + 1)
        self.top = 0
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if not bucket:
            word = rank >> 8
            self.low[word] |= _BIT[rank & 255]
            self.top |= 1 << word
        bucket.append(position)

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank with all its positions, in order; only while ``top`` is set."""
        top = self.top
        word = (top & -top).bit_length() - 1
        bits = self.low[word]
        rank = (word << 8) + (bits & -bits).bit_length() - 1
        self.low[word] = bits = bits & (bits - 1)
        if not bits:
            self.top = top & (top - 1)
        bucket = self.buckets[rank]
        self.buckets[rank] = []
        if len(bucket) > 1:
            bucket.sort()
        return rank, bucket


class RankCodec:
    """Encoder and decoder for a file of base64 byte strings and their ranks."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as file:
            for line in file:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.size = size = max(self.ranks.values()) + 1
        tokens = {rank: token for token, rank in self.ranks.items()}
        #: By id: the bytes, and the id as decimal text with a comma.
        self.bytes = pa.array([tokens.get(i) for i in range(size)], pa.large_binary())
        self.decimals = pa.array([b"%d," % i for i in range(size)], pa.large_binary())
        self.split = regex.compile(pattern)
        self.words = pattern == _PATTERN
        self.queue = RankQueue(size)
        # Rank of a merge by the two symbols, as one number.
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * size + right] = rank
        # The same of two bytes.
        symbols = [self.ranks[bytes((b,))] for b in range(256)]
        self.symbols = np.array(symbols, _ID)
        self.byte_pairs = np.array(
            [self.pairs.get(a * size + b, -1) for a in symbols for b in symbols], np.int32)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.half = max(1, remembered // 2)

    def pieces(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each piece. All pieces share the queue, each has a list of its own."""
        if not parts:
            return []
        pairs, queue, size = self.pairs.get, self.queue, self.size
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(part) for part in parts])
        ids = self.symbols[data].tolist()
        after, before = np.arange(1, len(ids) + 1), np.arange(-1, len(ids) - 1)
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        after, before = after.tolist(), before.tolist()
        # Rank of the pair that begins at each position, -1 where there is none.
        ranked = np.full(len(ids), -1, np.int32)
        ranked[:-1] = self.byte_pairs[data[:-1].astype(np.int32) * 256 + data[1:]]
        ranked[ends - 1] = -1
        order = np.argsort(ranked, kind="stable")[np.count_nonzero(ranked < 0):]
        in_order = ranked[order]
        starts = np.flatnonzero(np.diff(in_order, prepend=-1)).tolist()
        buckets, push, pop = queue.buckets, queue.push, queue.pop
        for rank, positions in zip(in_order[starts].tolist(), np.split(order, starts[1:])):
            push(rank, -1)
            buckets[rank] = positions.tolist()
        ranked = ranked.tolist()
        while queue.top:
            rank, positions = pop()
            as_left = rank * size
            for place, left in enumerate(positions, 1):
                # Stale: a symbol here was merged since, and the pair is another now.
                if ranked[left] != rank:
                    continue
                right = after[left]
                ids[left], ids[right] = rank, -1
                ranked[right] = -1
                lower = False
                following = after[left] = after[right]
                if following >= 0:
                    before[following] = left
                    ranked[left] = new = pairs(as_left + ids[following], -1)
                    if new >= 0:
                        lower = new < rank
                        if buckets[new]:
                            buckets[new].append(left)
                        else:
                            push(new, left)
                else:
                    ranked[left] = -1
                previous = before[left]
                if previous >= 0:
                    ranked[previous] = new = pairs(ids[previous] * size + rank, -1)
                    if new >= 0:
                        lower = lower or new < rank
                        if buckets[new]:
                            buckets[new].append(previous)
                        else:
                            push(new, previous)
                if lower:
                    # A pair that comes before this rank: the others of this rank wait.
                    for waiting in positions[place:]:
                        push(rank, waiting)
                    break
        merged = np.array(ids, _ID)
        left_over = merged >= 0
        bounds = [0, *(4 * np.cumsum(left_over)[ends - 1]).tolist()]
        whole = merged[left_over].tobytes()
        return [whole[a:b] for a, b in zip(bounds, bounds[1:])]

    def code(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the places where each text's begin, and end."""
        split = _stretches(pc.fill_null(column, ""))
        coded = split.flatten().dictionary_encode()
        row = self._of_stretches(coded.dictionary).take(coded.indices)
        if not len(row):
            return np.zeros(0, _ID), np.zeros(len(column) + 1, np.int64)
        _, offsets, data = row.buffers()
        # The ids of all stretches lie in their order: a text's begin where its first stretch's do.
        at = np.frombuffer(offsets, np.int64)[split.offsets.to_numpy()] // 4
        return np.frombuffer(data or b"", _ID)[:at[-1]], at

    def _of_stretches(self, stretches: pa.Array) -> pa.Array:
        """Ids of different stretches; those of a word and of what is behind it are looked up apart."""
        if not self.words:
            return pa.array(self._looked_up(stretches.to_pylist()), pa.large_binary())
        found = pc.extract_regex(stretches, _WORD)
        words = pc.struct_field(found, "word").dictionary_encode()
        rest = pc.if_else(found.is_valid(), pc.struct_field(found, "rest"),
                          stretches).dictionary_encode()
        word_ids = pa.array(self._pieces_of(words.dictionary.to_pylist()), pa.large_binary())
        rest_ids = pa.array(self._looked_up(rest.dictionary.to_pylist()), pa.large_binary())
        empty = pa.scalar(b"", pa.large_binary())
        return pc.binary_join_element_wise(pc.fill_null(word_ids.take(words.indices), empty),
                                           rest_ids.take(rest.indices), empty)

    def _looked_up(self, stretches: list[str]) -> list[bytes]:
        """Ids of different stretches. Those that are not remembered are split by the pattern."""
        found, fresh = self._remembered(stretches)
        split = [self.split.findall(stretches[i]) for i in fresh]
        parts = list({part for parts in split for part in parts})
        ids = dict(zip(parts, self._pieces_of(parts)))
        made = [b"".join([ids[part] for part in parts]) for parts in split]
        self._remember(stretches, fresh, made, found)
        return found

    def _pieces_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces. Those that are not remembered are merged together,
        in order, so that pieces which merge alike lie side by side in memory."""
        found, fresh = self._remembered(pieces)
        fresh.sort(key=pieces.__getitem__)
        data = [pieces[i].encode() for i in fresh]
        made = [None if rank is None else rank.to_bytes(4, "little")
                for rank in map(self.ranks.get, data)]
        parted = np.array([i for i, ids in enumerate(made) if ids is None], np.int64)
        sizes = np.cumsum([len(data[i]) for i in parted], dtype=np.int64)
        for places in np.split(parted, np.flatnonzero(np.diff(sizes // _MERGED)) + 1):
            for i, ids in zip(places, self.pieces([data[i] for i in places])):
                made[i] = ids
        self._remember(pieces, fresh, made, found)
        return found

    def _remembered(self, names: list[str]) -> tuple[list[bytes | None], list[int]]:
        """The ids of each name that are remembered, and the places of the others."""
        found = list(map(self.young.get, names))
        fresh = []
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = ids = self.old.get(names[i])
                if ids is None:
                    fresh.append(i)
                else:
                    self._keep(names[i], ids)
        return found, fresh

    def _remember(self, names: list[str], fresh: list[int], made: list[bytes],
                  found: list[bytes | None]) -> None:
        for i, ids in zip(fresh, made):
            found[i] = ids
            if len(names[i]) <= _REMEMBERED_LENGTH:
                self._keep(names[i], ids)

    def _keep(self, name: str, ids: bytes) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[name] = ids

    def encode(self, text: str) -> list[int]:
        return self.code(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(self.bytes.take(pa.array(ids, pa.int32())).to_pylist())


def codec_for(ranks: str, pattern: str, remembered: int) -> RankCodec:
    """One codec per vocabulary and worker process, until the worker turns to other work."""
    return held(_key(ranks, pattern, remembered), lambda: RankCodec(ranks, pattern, remembered))


def _key(ranks: str, pattern: str, remembered: int) -> tuple:
    return "byte_bpe", ranks, pattern, remembered


#: The pattern whose words are known: a run of letters is a piece, whatever is behind it.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD = r"^(?P<word> ?[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>(?s:[\x00-@\[-`{-\x7F].*)?)$"
#: A blank beside a space: there a space need not start a piece. Arrow knows ASCII blanks only by name.
_BLANK = (r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}"
          r"\x{3000}]")
_CROWDED = f" {_BLANK}|{_BLANK} "
_LONE_SPACE = regex.compile(r"(?<=\S)(?=[ ]\S)")


def _stretches(column: pa.Array) -> pa.ListArray:
    """Each text in stretches. A space between two characters that are not blank always
    starts a piece, so a text may be cut there before the pattern is applied."""
    crowded = pc.match_substring_regex(column, _CROWDED)
    split = pc.split_pattern(pc.if_else(crowded, "", column), " ")
    rest = split.flatten()
    first = np.zeros(len(rest), bool)
    first[split.offsets.to_numpy()[:-1]] = True
    split = pa.ListArray.from_arrays(split.offsets, pc.if_else(
        pa.array(first), rest, pc.binary_join_element_wise("", rest, " ")))
    places = np.flatnonzero(crowded.to_numpy(zero_copy_only=False))
    if not len(places):
        return split
    cut = pa.array([_LONE_SPACE.split(text) for text in column.take(pa.array(places)).to_pylist()],
                   split.type)
    order = np.arange(len(split))
    order[places] = np.arange(len(places)) + len(split)
    return pa.concat_arrays([split, cut]).take(pa.array(order))


class _Cut:
    """Values in a row, put together from each place of ``at`` to the next."""

    def __init__(self, values: pa.Array, at: np.ndarray):
        _, offsets, data = values.buffers()
        places = np.frombuffer(offsets, np.int64) if len(values) else np.zeros(1, np.int64)
        self.data = memoryview(data) if data else memoryview(b"")
        self.bounds = places[at].tolist()

    def sha256(self, less: int = 0) -> list[str]:
        """Digests, without the last ``less`` bytes of each."""
        return [hashlib.sha256(self.data[a:max(a, b - less)]).hexdigest()
                for a, b in zip(self.bounds, self.bounds[1:])]

    def values(self) -> list[bytes]:
        return [bytes(self.data[a:b]) for a, b in zip(self.bounds, self.bounds[1:])]


def encode_decode(docs: DataFrame, ranks: str, pattern: str,
                  columns: tuple[str, ...] = tuple(COLUMNS),
                  remembered: int = REMEMBERED) -> DataFrame:
    """Ids of each document's whole text, the bytes they decode to, and digests of both.

    NULL and empty texts have no ids and no bytes. Every row of ``docs`` gives
    one row, repeated and NULL ids included; other columns are left out. Only
    ``columns`` leave the task. ``remembered`` bounds the pieces that a worker keeps
    with their ids, some 120 bytes each; others are merged again when they come up.
    """
    def make():
        codec = codec_for(ranks, pattern, remembered)

        def step(batch):
            for part in slices(batch, _TOGETHER):
                ids, at = codec.code(part.column("text"))
                coded = pa.array(ids)
                decoded = _Cut(codec.bytes.take(coded), at)
                row = {
                    "doc_id": part.column("doc_id"),
                    "n_tokens": pa.array(np.diff(at)),
                    "ids_sha256": _Cut(codec.decimals.take(coded), at).sha256(less=1),
                    "decoded_sha256": decoded.sha256(),
                }
                if "ids" in columns:
                    row["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), coded)
                if "decoded" in columns:
                    row["decoded"] = decoded.values()
                yield {name: row[name] for name in columns}
        return step

    schema = ", ".join(f"{name} {COLUMNS[name]}" for name in columns)
    return per_batch(docs.select("doc_id", "text"), schema, make,
                     holds=_key(ranks, pattern, remembered))


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """As :func:`encode_decode`, digests only, so that ids and bytes stay in the task."""
    return encode_decode(docs, ranks, pattern,
                         ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
