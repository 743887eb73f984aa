"""Cost-balanced packing of documents into training sequences.

A document costs its tokens plus attention within it, which grows with the square of
its length. Documents come in descending order, and each goes whole to the
sequence of least cost that has room for it. One that no sequence has room for is cut where the
widest gap ends, and its rest waits its turn by its own length.

A task packs its documents in windows of about a million tokens as it reads them: no shuffle, and what it
holds at once does not grow with the input. As many sequences are open as the window's
tokens fill; what is left over fills sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.common import held, hold_only, slices


@dataclass(frozen=True)
class Packing:
    """``capacity``: tokens of a sequence, a power of two. ``end``: the id behind each document. ``window``:
    tokens that are packed together. A piece of ``t`` tokens costs ``linear * t + quadratic * t * t``; the default is
    the ratio of a layer that is 1,024 wide. ``remembered``: words whose ids a worker keeps."""

    capacity: int = 2048
    end: int = 1
    window: int = 1_000_000
    linear: int = 6 * 1024
    quadratic: int = 1
    remembered: int = 600_000


def room(tokens: int, capacity: int) -> list[int]:
    """Lengths of the sequences that ``tokens`` fill: full ones, then falling powers of two."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [
        1 << bit for bit in reversed(range(capacity.bit_length())) if rest >> bit & 1]


def assign(lengths: list[int], conf: Packing) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths.

    Ties of length go by the document's place, ties of cost by the sequence's.
    """
    sizes = np.array(room(sum(lengths), conf.capacity), np.int64)
    left, cost = sizes.copy(), np.zeros(len(sizes), np.int64)
    beyond = np.iinfo(np.int64).max
    waiting = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    pieces = []
    while waiting:
        minus, document, start = waiting[0]
        fitting = np.where(left >= -minus, cost, beyond)
        place = int(fitting.argmin())
        take = -minus
        if fitting[place] == beyond:
            place = int(left.argmax())
            take = int(left[place])
            heapq.heapreplace(waiting, (minus + take, document, start + take))
        else:
            heapq.heappop(waiting)
        pieces.append((document, start, take, place, int(sizes[place] - left[place])))
        left[place] -= take
        cost[place] += conf.linear * take + conf.quadratic * take * take
    return pieces


def chunks_of(column: pa.Array) -> pa.ListArray:
    """Stretches of each text that the tokenizer treats apart. It never joins what spaces or
    line ends part, and lower-cases A-Z itself; a text that may hold special tokens is left as it is."""
    low = pc.replace_substring(pc.fill_null(column, ""), "\n", " ")
    return pc.split_pattern(
        pc.if_else(pc.match_substring(low, "<|"), low, pc.ascii_lower(low)), " ")


#: Chunks that begin with letters, which are one word to the tokenizer: it composes, lower-cases and splits
#: them as they are. Marks behind them are treated apart; an apostrophe might begin a word.
_LETTERS = r"^(?P<letters>[a-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"


def _byte_signs() -> dict[int, str]:
    """The tokenizer's signs for the bytes of each letter beyond ASCII, lower-cased."""
    letters = [c for c in map(chr, range(0xC0, 0x100)) if c not in "×÷"]
    # Signs of bytes: themselves where they print, else the next from U+0100 on.
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    signs = {**{b: chr(b) for b in printed}, **{b: chr(256 + i) for i, b in enumerate(others)}}
    return {ord(c): "".join(signs[b] for b in c.lower().encode()) for c in letters}


def word_model(tokenizer: str):
    """The word model alone, for words in byte signs; None if the tokenizer prepares words otherwise
    than by composing, lower-casing, splitting at other than letters and byte signs."""
    from tokenizers import Tokenizer

    spec = json.loads(tokenizer)
    normal, split = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    if (
        [n.get("type") for n in normal.get("normalizers", [])] != ["NFC", "Replace", "Lowercase"]
        or normal["normalizers"][1]["pattern"] != {"Regex": "\\s+"}
        or [p.get("type") for p in split.get("pretokenizers", [])] != ["Split", "ByteLevel"]
        or split["pretokenizers"][0]["pattern"] != {
            "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        or split["pretokenizers"][1]["add_prefix_space"] or split["pretokenizers"][1]["use_regex"]
        or spec["post_processor"] or spec["truncation"] or spec["padding"]
        or any(not t["special"] or not t["content"].startswith("<|") for t in spec["added_tokens"])
    ):
        return None
    return Tokenizer.from_str(json.dumps(
        {**spec, "normalizer": None, "pre_tokenizer": None, "added_tokens": []}))


class WordIds:
    """Ids of texts by a tokenizer; those of short chunks are remembered. Chunks of letters go to the
    tokenizer's word model at once, which spares the steps that leave them as they are."""

    def __init__(self, path: str, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = word_model(self.tokenizer.to_str())
        self.signs = _byte_signs()
        self.known: dict[str, bytes] = {}
        self.remembered = remembered

    def ids(self, column: pa.Array | list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if isinstance(column, list):
            column = pa.array(column, pa.string())
        split = chunks_of(column)
        coded = split.flatten().dictionary_encode()
        row = self._of_chunks(coded.dictionary).take(coded.indices)
        if not len(row):
            return [b""] * len(column)
        # The ids of all chunks lie in their order: a text's begin where its first chunk's do.
        _, offsets, data = row.buffers()
        at = np.frombuffer(offsets, np.int64)[split.offsets.to_numpy()].tolist()
        whole = memoryview(data) if data else b""
        return [bytes(whole[a:b]) for a, b in zip(at, at[1:])]

    def _of_chunks(self, chunks: pa.Array) -> pa.Array:
        """Ids of different chunks; those of letters and of the marks behind them are looked up apart."""
        if len(self.known) > self.remembered:
            self.known = {}
        if self.words is None:
            return self._looked_up(chunks, self.tokenizer)
        found = pc.extract_regex(chunks, _LETTERS)
        letters, marks = pc.struct_field(found, "letters"), pc.struct_field(found, "marks")
        words = letters.dictionary_encode()
        rest = pc.if_else(found.is_valid(), marks, chunks).dictionary_encode()
        word_ids = self._looked_up(words.dictionary, self.words).take(words.indices)
        rest_ids = self._looked_up(rest.dictionary, self.tokenizer).take(rest.indices)
        empty = pa.scalar(b"", pa.large_binary())
        return pc.binary_join_element_wise(pc.fill_null(word_ids, empty), rest_ids, empty)

    def _looked_up(self, chunks: pa.Array, tokenizer) -> pa.Array:
        """Ids of different chunks, those that are not known by this tokenizer."""
        chunks, known = chunks.to_numpy(zero_copy_only=False).tolist(), self.known
        fresh = [c for c in chunks if c not in known]
        if fresh:
            written = fresh if tokenizer is not self.words else [
                c if c.isascii() else c.translate(self.signs) for c in fresh]
            known.update(zip(fresh, [array("I", found.ids).tobytes() for found in
                             tokenizer.encode_batch_fast(written, add_special_tokens=False)]))
        found = pa.array([known[c] for c in chunks], pa.large_binary())
        for chunk in fresh:
            if len(chunk) > 64:
                del known[chunk]
        return found


SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, sequence_tokens bigint")


def pack(docs: DataFrame, tokenizer: str, conf: Packing = Packing(),
         with_ids: bool = False) -> DataFrame:
    """A row per piece: ``doc_id``, its ``start`` and ``length`` in the document's ids, their ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, the piece's ``offset`` there and ``sequence_tokens``, how many the sequence
    holds; ``with_ids`` adds ``ids``.

    NULL and empty texts are one token, the end. Each row of ``docs`` is packed, repeated and NULL
    ids included; other columns are left out. A sequence holds documents of one task, and its id
    begins with the task's number, so a task that runs again gives the same rows.
    """
    end = np.array([conf.end], "<u4").tobytes()
    key = ("packing", tokenizer, conf.remembered)

    def packed(window, first):
        pieces = assign([len(ids) // 4 for _, ids in window], conf)
        filled = room(sum(len(ids) // 4 for _, ids in window), conf.capacity)
        pieces.sort(key=lambda p: (p[3], p[4]))
        cut = [window[d][1][4 * start:4 * (start + n)] for d, start, n, _, _ in pieces]
        columns = [
            pa.array([window[p[0]][0] for p in pieces], pa.int64()),
            pa.array([p[1] for p in pieces], pa.int64()),
            pa.array([p[2] for p in pieces], pa.int64()),
            pa.array([zlib.crc32(ids) for ids in cut], pa.int64()),
            pa.array([len(window[p[0]][1]) // 4 for p in pieces], pa.int64()),
            pa.array([first + p[3] for p in pieces], pa.int64()),
            pa.array([p[4] for p in pieces], pa.int64()),
            pa.array([filled[p[3]] for p in pieces], pa.int64()),
        ]
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        if with_ids:
            columns.append(pa.array([np.frombuffer(ids, "<i4") for ids in cut],
                                    pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names), len(filled)

    def run(batches):
        from pyspark import TaskContext

        hold_only(key)
        coder = held(key, lambda: WordIds(tokenizer, conf.remembered))
        next_id = TaskContext.get().partitionId() << 40
        window, tokens = [], 0
        for batch in batches:
            ids_of_docs = batch.column("doc_id").to_pylist()
            made = (ids for part in slices(batch, 4_000_000) for ids in coder.ids(part.column("text")))
            for doc_id, ids in zip(ids_of_docs, made):
                window.append((doc_id, ids + end))
                tokens += len(ids) // 4 + 1
                if tokens >= conf.window:
                    rows, used = packed(window, next_id)
                    yield rows
                    next_id += used
                    window, tokens = [], 0
        if window:
            yield packed(window, next_id)[0]

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
