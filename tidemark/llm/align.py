"""Alignment of two tokenizers' ids over the same text.

Both tokenizers begin a token at every space that stands alone between two other characters. So a text is cut there,
each distinct piece is encoded and aligned once, and a text's groups are those of its pieces in a row. New pieces are
joined with such spaces to runs. The cumulative ends of both token lists of a run are keys of two dictionaries, end to
index. The keys that both have, sorted, slice both lists into groups; inside a slice the tokens whose bytes overlap are
linked.

How often an id pair is linked corpus-wide is summed over blocks of documents: a block lists each pair once, so what is
shuffled are a block's distinct pairs, and its documents meet the sums by block.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import rows_of
from tidemark.session import staged

LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
BLOCK_LINKS, BLOCK_ROWS = 1 << 18, 4096  # a block of documents is closed when it has so many
PIECES = 400_000  # distinct pieces that a task remembers
RUN_CHARS = 1 << 16  # of new pieces that are encoded as one text
ID_BITS = 32


class Aligned(NamedTuple):
    """Pieces by number: if both sides give a piece's bytes, its tokens and groups; then the links of all pieces in a row."""

    facts: np.ndarray  # fits, tokens of both, groups
    groups: list[bytes]
    counts: np.ndarray  # links of each piece
    pairs: np.ndarray


def slices(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The ends that both have, and the number of tokens up to each in both lists."""
    index_a = dict(zip(ends_a, range(1, len(ends_a) + 1), strict=True))
    index_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    return common, list(map(index_a.__getitem__, common)), list(map(index_b.__getitem__, common))


def links(ends_a: list[int], ends_b: list[int], bounds: tuple[int, int, int, int]) -> Iterator[tuple[int, int]]:
    """Places in both lists of the tokens of a group whose bytes overlap; there are fewer than both have tokens."""
    a, stop_a, b, stop_b = bounds
    while a < stop_a and b < stop_b:
        yield a, b
        end_a, end_b = ends_a[a], ends_b[b]
        a += end_a <= end_b
        b += end_b <= end_a


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens.

    The first has a byte-level vocabulary as ranks and the pattern that cuts texts for it; the names of special tokens
    are plain text to it. The second is a model of pieces.
    """

    def __init__(self, ranks_file: str, pattern: str, pieces_file: str):
        import sentencepiece
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("alignment", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        self.bytes_b = [self._piece(k) for k in range(self.b.vocab_size())]
        self.sizes_a, self.sizes_b = (list(map(len, table)) for table in (self.bytes_a, self.bytes_b))
        self.digits = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))

    def _piece(self, number: int) -> bytes:
        text = self.b.id_to_piece(number)
        one = BYTE_PIECE.fullmatch(text)
        return bytes([int(one[1], 16)]) if one else text.replace("▁", " ").encode()

    def aligned(self, pieces: list[str]) -> list[Aligned]:
        """The pieces in order, each with the space before it, which the second tokenizer sets itself.

        Many are encoded as one text, with the lone spaces between them at which a text would be cut. Pieces that can't
        stand beside such a space, or that don't come back among others, are encoded alone.
        """
        found, run, size = [], [], 0
        for piece in pieces:
            fit = bool(piece) and not piece[0].isspace() and not piece[-1].isspace()
            if run and (not fit or size > RUN_CHARS):
                found += self._run(run)
                run, size = [], 0
            if fit:
                run.append(piece)
                size += len(piece) + 1
            else:
                found += self._run([piece])
        return found + (self._run(run) if run else [])

    def _run(self, pieces: list[str]) -> list[Aligned]:
        text = " ".join(pieces)
        raw = (" " + text).encode()
        ids_a, ids_b = self.a(" " + text), self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != raw or b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            if len(pieces) > 1:
                return [x for p in pieces for x in self._run([p])]
            return [Aligned(np.zeros((1, 4), np.int64), [b""], np.zeros(1, np.int64), np.empty(0, np.int64))]
        ends_a = list(accumulate(map(self.sizes_a.__getitem__, ids_a)))
        ends_b = list(accumulate(map(self.sizes_b.__getitem__, ids_b)))
        common, upto_a, upto_b = slices(ends_a, ends_b)
        stops = np.array([upto_a, upto_b])
        starts = np.concatenate([np.zeros((2, 1), np.int64), stops[:, :-1]], axis=1)
        # Most groups are one token of either side; the links of the others are expanded one group at a time.
        wide = np.flatnonzero((stops - starts > 1).any(axis=0))
        first_a, first_b = np.array(ids_a)[starts[0]], np.array(ids_b)[starts[1]]
        digits = self.digits.__getitem__
        groups = list(map("%s|%s".__mod__, zip(first_a.tolist(), first_b.tolist(), strict=True)))
        counts, more = np.ones(len(common), np.int64), []
        for k in wide.tolist():
            a, b, c, d = *starts[:, k].tolist(), *stops[:, k].tolist()
            groups[k] = f"{','.join(map(digits, ids_a[a:c]))}|{','.join(map(digits, ids_b[b:d]))}"
            expanded = [ids_a[i] << ID_BITS | ids_b[j] for i, j in links(ends_a, ends_b, (a, c, b, d))]
            counts[k] = len(expanded)
            more += expanded
        pairs = np.repeat(first_a << ID_BITS | first_b, counts)
        pairs[np.repeat(np.isin(np.arange(len(common)), wide, assume_unique=True), counts)] = more
        # A piece ends where both have a token end.
        sizes = np.fromiter((len(p.encode()) + 1 for p in pieces), np.int64, len(pieces))
        last = np.searchsorted(common, np.cumsum(sizes)) + 1
        first = np.append(0, last[:-1])
        facts = np.stack([np.ones(len(pieces), np.int64), *np.diff(np.append(0, stops[0][last - 1])[None]), *np.diff(np.append(0, stops[1][last - 1])[None]), last - first], axis=1)
        texts = [";".join(groups[x:y]).encode() for x, y in zip(first.tolist(), last.tolist(), strict=True)]
        of_links = np.append(0, np.cumsum(counts))
        return [Aligned(facts, texts, of_links[last] - of_links[first], pairs)]


class Memory:
    """Aligned pieces by number; the links of piece k are ``pairs[starts[k]:starts[k + 1]]``, as numbers of id pairs."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.pair_number: dict[int, int] = {}
        self.facts = np.zeros((0, 4), np.int64)
        self.pairs, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, texts: list[list[str]]) -> None:
        """Encodes and aligns the pieces of texts that are new."""
        new = list(dict.fromkeys(p for pieces in texts for p in pieces if p not in self.number))
        if not new:
            return
        found = self.tokenizers.aligned(new)
        n = len(self.groups)
        after = n + len(new)
        self.number.update(zip(new, range(n, after), strict=True))
        for f in found:
            self.groups += f.groups
        codes, places = np.unique(np.concatenate([f.pairs for f in found]), return_inverse=True)
        numbers = np.array([self.pair_number.setdefault(c, len(self.pair_number)) for c in codes.tolist()], np.int32)
        ends = self.starts[n] + np.cumsum(np.concatenate([f.counts for f in found]))
        self.facts, self.starts, self.pairs = _grown(self.facts, after), _grown(self.starts, after + 1), _grown(self.pairs, ends[-1])
        self.facts[n:after] = np.concatenate([f.facts for f in found])
        self.starts[n + 1 : after + 1] = ends
        self.pairs[self.starts[n] : ends[-1]] = numbers[places] if len(codes) else []

    def linked(self, pieces: np.ndarray) -> np.ndarray:
        """The numbers of all linked id pairs of pieces in a row."""
        first = self.starts[pieces]
        counts = self.starts[pieces + 1] - first
        places = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return self.pairs[places]


@lru_cache(maxsize=1)
def memory_of(ranks_file: str, pattern: str, pieces_file: str) -> Memory:
    """One for all tasks that a worker runs after each other."""
    return Memory(Tokenizers(ranks_file, pattern, pieces_file))


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    """Room for ``size`` rows or more."""
    if len(values) >= size:
        return values
    more = np.zeros((max(size, 2 * len(values)) - len(values), *values.shape[1:]), values.dtype)
    return np.concatenate([values, more])


def aligned_blocks(docs: DataFrame, ranks_file: str, pattern: str, pieces_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document, and one per block of them that lists its linked id pairs.

    Rows of documents: ``block, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``, where ``pairs`` are
    places in the block's list. Rows of blocks: ``block, listed, counts``. A block is bounded by parameters, but for
    a single text that is longer.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc_id", rows.schema["doc_id"].dataType)])
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string")
    for name, part in (("pairs", T.IntegerType()), ("times", T.IntegerType()), ("listed", T.LongType()), ("counts", T.LongType())):
        schema = schema.add(name, T.ArrayType(part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = memory_of(ranks_file, pattern, pieces_file)
        block, held, linked, kind = TaskContext.get().partitionId() << 33, [], 0, None

        def closed() -> pa.RecordBatch:
            found = [np.unique(numbers, return_counts=True) for *_, numbers in held]
            totals = np.zeros(len(memory.pair_number), np.int64)
            for numbers, times in found:
                totals[numbers] += times
            there = np.flatnonzero(totals)
            codes = np.fromiter(memory.pair_number, np.int64, len(memory.pair_number))[there]
            out = [
                (block, *facts, np.searchsorted(there, numbers).astype(np.int32), times.astype(np.int32), None, None)
                for (*facts, _), (numbers, times) in zip(held, found, strict=True)
            ]
            out.append((block, *[None] * 8, codes, totals[there]))
            types = [pa.int64(), kind, *[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int32())] * 2, *[pa.list_(pa.int64())] * 2]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in range(0, batch.num_rows, 256):
                some = list(rows_of([batch.slice(part, 256)], "doc_id", "text"))
                texts = [LONE_SPACE.split(t) if t else [] for _, t in some]
                memory.learn(texts)
                for (doc, _), pieces in zip(some, texts, strict=True):
                    places = np.fromiter(map(memory.number.__getitem__, pieces), np.int64, len(pieces))
                    fits, *facts = memory.facts[places].T if len(pieces) else np.zeros((4, 1), np.int64)
                    if fits.all() and len(pieces):
                        numbers = memory.linked(places)
                        digest = hashlib.sha256(b";".join(map(memory.groups.__getitem__, places.tolist()))).hexdigest()
                        held.append((doc, *(int(f.sum()) for f in facts), len(numbers), digest, numbers))
                    else:
                        held.append((doc, 0, 0, 0, 0, "", np.empty(0, np.int32)))
                    linked += held[-1][4]
                    if linked >= BLOCK_LINKS or len(held) >= BLOCK_ROWS:
                        yield closed()
                        block, held, linked = block + 1, [], 0
            if len(memory.number) > PIECES:
                if held:
                    yield closed()
                    block, held, linked = block + 1, [], 0
                memory.clear()
        if held:
            yield closed()

    return rows.mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, n, best``: how many links hold an id pair, and whether no pair with its second id has more."""
    listed = blocks.select(F.explode(F.arrays_zip("listed", "counts")).alias("p"))
    counts = staged(listed.groupBy(F.col("p.listed").alias("pair")).agg(F.sum("p.counts").alias("n")), "pairs")
    second = F.col("pair").bitwiseAND(2**ID_BITS - 1)
    tops = counts.groupBy(second.alias("b")).agg(F.max("n").alias("top"))
    return counts.join(tops, second == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, ranks_file: str, pattern: str, pieces_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row of ``docs``.

    ``n_links`` counts the pairs of tokens whose bytes overlap; ``count_sum`` adds, over a document's links, how many
    links of the whole table hold the same two ids, and ``n_best`` counts the links whose pair has the most of all
    with its second id, ties included. A null or empty text, and one whose bytes a tokenizer does not give back, has
    zeros and an empty ``groups_sha256``. Names of special tokens are plain text. Rows that repeat an id have a row
    each and count each. Whole texts are read; the pieces of a very long one are in its block alone. Other columns are
    not read. An empty table gives no rows. Every executor must be able to read both files.
    """
    blocks = staged(aligned_blocks(docs, ranks_file, pattern, pieces_file, key, text), "blocks")
    of_blocks = blocks.where(F.col("listed").isNotNull()).select("block", "listed", "counts")
    facts = staged(pair_counts(of_blocks), "pair-counts")
    pairs = of_blocks.select("block", F.posexplode("listed").alias("place", "pair"))
    looked = pairs.join(facts, "pair").select(F.col("block").alias("of"), "place", "n", "best")
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    rows = blocks.where(F.col("listed").isNull()).select("block", *names, "pairs", "times")
    schema = T.StructType([rows.schema[n] for n in names]).add("n_best", "long").add("count_sum", "long")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        n, best = np.zeros((2, len(place)), np.int64)
        n[place], best[place] = right.column("n").to_numpy(), right.column("best").to_numpy()
        of = pc.list_parent_indices(left.column("pairs")).to_numpy()
        places, times = (pc.list_flatten(left.column(x)).to_numpy().astype(np.int64) for x in ("pairs", "times"))
        sums = [np.zeros(len(left), np.int64) for _ in range(2)]
        np.add.at(sums[0], of, times * best[places])
        np.add.at(sums[1], of, times * n[places])
        columns = [left.column(x) for x in names] + [pa.array(s) for s in sums]
        return pa.Table.from_arrays(columns, names=schema.names)

    found = rows.groupBy("block").cogroup(looked.groupBy("of")).applyInArrow(run, schema)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
