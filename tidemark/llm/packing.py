"""Packing of documents into token sequences of a fixed length by the sum-of-squares rule.

A task packs the documents it reads; nothing is shuffled. A document's whole windows go out as they are. What is left
of it is put, online, where it makes the sum over all fill levels of the squared number of windows at that level
smallest. Only counts per level and the open windows are kept, and there are at most ``most_open`` of these.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import batches_of, rows_of

LENGTH = 1024
OPEN = 4096  # windows a task holds open
WORDS = 400_000  # pieces of text whose ids a task remembers

PAIRED_SPACE = re.compile(r"\s\s")
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class Ids(dict):
    """Token ids of texts, as little-endian 32-bit numbers.

    Texts are cut at the names of added tokens first; each name has its one id. The tokenizer's own cuts of the rest
    include every single space between two other characters: the space begins the next piece. So texts are cut there,
    and the ids of each distinct piece are asked for once.
    """

    def __init__(self, tokenizer_file: str, pattern: str, added: Mapping[str, int]):
        import tiktoken

        with open(tokenizer_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.added = {name: struct.pack("<I", number) for name, number in added.items()}
        longest_first = sorted(map(re.escape, added), key=len, reverse=True)
        self.names = re.compile(f"({'|'.join(longest_first)})" if added else "(?!)")
        self.encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= WORDS:
            self.clear()
        ids = self.encode(piece)
        found = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def of(self, text: str) -> bytes:
        between = self.names.split(text)
        return b"".join(self.added[part] if k % 2 else self.rest(part) for k, part in enumerate(between))

    def rest(self, text: str) -> bytes:
        parts = LONE_SPACE.split(text) if PAIRED_SPACE.search(text) else text.split(" ")
        return b"".join(map(self.__getitem__, [parts[0], *[" " + p for p in parts[1:]]]))


class Levels:
    """Open windows by fill level, 1 to ``length - 1``."""

    def __init__(self, length: int):
        self.length = length
        self.counts = np.zeros(length, np.int64)
        self.windows: list[list[list[tuple]]] = [[] for _ in range(length)]
        self.open = 0

    def place(self, size: int) -> list[tuple]:
        """Takes out the window for a piece of ``size``, new or open; equal costs prefer the fullest."""
        n, top = self.counts, self.length
        # Taking a window from level h saves 2 n[h] - 1, putting it to level h + size costs 2 n[h + size] + 1.
        cost = np.full(top, np.iinfo(np.int64).max)
        cost[0] = 2 * n[size] + 1 if size < top else 0
        after = np.zeros(top - size, np.int64)
        after[: top - size] = np.append(2 * n[size + 1 :] + 1, 0)
        levels = np.arange(1, top - size + 1)
        cost[levels] = np.where(n[levels] > 0, after - 2 * n[levels] + 1, np.iinfo(np.int64).max)
        best = top - 1 - int(np.argmin(cost[::-1]))
        if best == 0:
            return []
        self.counts[best] -= 1
        self.open -= 1
        return self.windows[best].pop()

    def put(self, window: list[tuple], fill: int) -> None:
        self.counts[fill] += 1
        self.open += 1
        self.windows[fill].append(window)

    def take_all(self) -> Iterator[list[tuple]]:
        """All open windows, fullest first; none stays."""
        for fill in range(self.length - 1, 0, -1):
            yield from self.windows[fill]
            self.windows[fill] = []
        self.counts[:] = 0
        self.open = 0


# A piece: document, first id, ids as bytes, ids of the document.
def _cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
    doc, start, ids, total = piece
    return (doc, start, ids[: 4 * at], total), (doc, start + at, ids[4 * at :], total)


def joined(windows: Iterable[list[tuple]], length: int) -> Iterator[list[tuple]]:
    """Windows that are not full, cut and joined to full ones; the rest is cut to powers of two, which need no padding."""
    held: list[tuple] = []
    fill = 0
    for piece in (p for w in windows for p in w):
        while fill + len(piece[2]) // 4 >= length:
            head, piece = _cut(piece, length - fill)
            yield [*held, head]
            held, fill = [], 0
        if piece[2]:
            held.append(piece)
            fill += len(piece[2]) // 4
    while fill:
        room = 1 << (fill.bit_length() - 1)
        fill -= room
        window = []
        while room:
            piece = held.pop(0)
            if len(piece[2]) // 4 > room:
                piece, left = _cut(piece, room)
                held.insert(0, left)
            room -= len(piece[2]) // 4
            window.append(piece)
        yield window


def packed_windows(docs: Iterable[tuple], length: int, most_open: int) -> Iterator[list[tuple]]:
    """Windows of pieces from ``(document, ids as bytes)``."""
    levels = Levels(length)
    for doc, ids in docs:
        total = len(ids) // 4
        piece = (doc, 0, ids, total)
        while len(piece[2]) >= 4 * length:
            head, piece = _cut(piece, length)
            yield [head]
        size = len(piece[2]) // 4
        if size:
            window = levels.place(size)
            window.append(piece)
            fill = sum(len(p[2]) for p in window) // 4
            if fill == length:
                yield window
            else:
                levels.put(window, fill)
        if levels.open > most_open:
            yield from joined(levels.take_all(), length)
    yield from joined(levels.take_all(), length)


def pack(
    docs: DataFrame, tokenizer_file: str, pattern: str, added: Mapping[str, int], length: int = LENGTH, end: int = 0, most_open: int = OPEN, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, one row per piece.

    A document is its text's ids and then ``end``; a null text is empty, so every row has a piece. Each id is in
    exactly one piece. A sequence has at most ``length`` ids; one whose length is not a power of two would be padded
    to ``length``, but the windows left open at a task's end are cut and joined, so there is none. Rows that repeat
    an id are packed each, null ids too; a very long text has as many pieces as it needs. Other columns are not read. An
    empty table gives no rows. ``tokenizer_file`` has a byte-level vocabulary as ranks, ``pattern``
    cuts texts for it, ``added`` has the ids of added tokens by their names in texts, and every executor must be able to read the file; ``sequence_id`` has the task's number in its upper bits.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)])
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, "long")
    stop = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, first = Ids(tokenizer_file, pattern, added), TaskContext.get().partitionId() << 33
        fields = None

        def documents(batches):
            for batch in batches:
                nonlocal fields
                fields = batch.schema.field("doc_id").type
                for doc, t in rows_of([batch], "doc_id", "text"):
                    yield doc, ids.of(t or "") + stop

        def pieces():
            for k, window in enumerate(packed_windows(documents(batches), length, most_open)):
                at = 0
                for doc, start, raw, total in window:
                    size = len(raw) // 4
                    yield doc, start, size, zlib.crc32(raw), total, first + k, at
                    at += size

        found = pieces()
        head = next(found, None)
        if head is not None:
            names = [pa.field("doc_id", fields), *(pa.field(f.name, pa.int64()) for f in schema.fields[1:])]
            yield from batches_of(_chained(head, found), pa.schema(names))

    return rows.mapInArrow(run, schema)


def _chained(head: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
    yield head
    yield from rest
