"""Skip-gram word vectors with hierarchical softmax, fitted block by block: no process holds all words."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.paging import number_pages
from tidemark.operators.wordtable import WordTable, block_marks, count_tokens, in_blocks, marked_words, words_of_blocks
from tidemark.session import lent, new_folder, scratch, shuffles_end, staged, written

FIT_TOKENS = 2_000_000  # tokens of a block, which one task trains on
STEPS, LEAST_STEP, MOST_STEP = 256, 64, 8192  # a block is learnt in so many steps, of so many words each
MOST_GRADIENTS = 8  # of a vector in one step; more count as so many of their mean
FARTHEST = 6.0  # products beyond this are learnt: no gradient
ONE = 2.0**30  # vectors are averaged as whole multiples of its inverse, so in any order alike


def code_lengths(groups: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """``(length, words)``, lengths ascending, of a Huffman code for ``(count, words)``: words with equal counts at once."""
    heap = [(count, k, words) for k, (count, words) in enumerate(sorted(groups))]
    heapq.heapify(heap)
    made: list[tuple[tuple[int, int], ...]] = [() for _ in heap]  # of each kind of node, its children and how many
    leaves = len(heap)
    while heap and (len(heap) > 1 or heap[0][2] > 1):
        count, kind, n = heapq.heappop(heap)
        if n > 1:
            heapq.heappush(heap, (2 * count, len(made), n // 2))
            made.append(((kind, 2),))
            if n % 2:
                heapq.heappush(heap, (count, kind, 1))
        else:
            other, second, m = heapq.heappop(heap)
            heapq.heappush(heap, (count + other, len(made), 1))
            made.append(((kind, 1), (second, 1)))
            if m > 1:
                heapq.heappush(heap, (other, second, m - 1))
    depths: list[dict[int, int]] = [{} for _ in made]
    if heap:
        depths[heap[0][1]][0] = 1
    found: dict[int, int] = {}
    for kind in range(len(made) - 1, -1, -1):
        for depth, n in depths[kind].items():
            for child, times in made[kind]:
                depths[child][depth + 1] = depths[child].get(depth + 1, 0) + times * n
            if kind < leaves:
                found[depth] = found.get(depth, 0) + n
    return sorted(found.items())


def _leaf(place: Column, lengths: Sequence[tuple[int, int]]) -> Column:
    """The leaf of the word at a place by falling count: nodes are numbered from the root, 1, and those below n are 2n, 2n + 1."""
    start, code, last, leaf = 0, 0, 0, F.lit(None).cast("bigint")
    ranges = []
    for length, n in lengths:
        code <<= length - last
        ranges.append((start + n, (1 << length) + code - start))
        start, code, last = start + n, code + n, length
    for end, shift in reversed(ranges):
        leaf = F.when(place < end, place + F.lit(shift)).otherwise(leaf)
    return leaf


def vocabulary(words: DataFrame, min_count: int) -> DataFrame:
    """``word, key``: the leaf of each word of ``word, n``. The driver gets how many words have each count."""
    known = staged(words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "vocabulary")
    groups = [(r["n"], r["words"]) for r in known.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()]
    if not groups:
        raise ValueError("no words to learn vectors of")
    placed = number_pages(known.select((-F.col("n")).alias("_least"), "word"), ["_least", "word"], 1 << 50)
    return placed.select("word", _leaf(F.col("place"), code_lengths(groups)).alias("key"))


def _added(sums: np.ndarray, at: np.ndarray, gradients: np.ndarray, hits: np.ndarray, rate: float, seen: np.ndarray) -> None:
    """Adds gradients to the rows ``at``, of one with over ``MOST_GRADIENTS`` so many times their mean. ``seen`` is all zeros."""
    np.add.at(seen, at, hits)
    gradients *= (rate * MOST_GRADIENTS / np.maximum(seen[at], MOST_GRADIENTS))[:, None]
    seen[at] = 0
    for j in range(sums.shape[1]):
        np.add.at(sums[:, j], at, gradients[:, j])


def _learnt(tokens: str, size: int, window: int, seed: int, done: int, rounds: int, rate: float) -> Callable:
    """Trains the vectors of a block's words and nodes on its rows."""

    def run(key: tuple, rows: pa.Table, state: pa.Table) -> pa.Table:
        random = np.random.default_rng([seed, done, key[0].as_py()])
        lists = rows.sort_by("_order").column(tokens).combine_chunks()
        words, inner = (state.filter(test) for test in (pc.is_valid(state.column("word")), pc.is_null(state.column("word"))))
        at = pc.index_in(pc.list_flatten(lists), value_set=words.column("word").combine_chunks()).fill_null(-1).to_numpy()
        row = pc.list_parent_indices(lists).to_numpy()[at >= 0]
        at = at[at >= 0]
        numbers = lambda t: pc.list_flatten(t.column("x").combine_chunks()).to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float32)
        leaf, vectors = words.column("key").to_numpy(), numbers(words)
        above = [np.unique(leaf[leaf > 1] >> 1)]
        while above[-1].size and above[-1][-1] > 1:
            above.append(np.unique(above[-1][above[-1] > 1] >> 1))
        nodes = np.unique(np.concatenate(above))
        weights = np.zeros((len(nodes), size), np.float32)
        if inner.num_rows:
            weights[np.searchsorted(nodes, inner.column("key").to_numpy())] = numbers(inner)
        parent, up = np.searchsorted(nodes, leaf >> 1), np.searchsorted(nodes, nodes >> 1)
        length = (np.frexp(leaf.astype(float))[1] - 1).astype(np.int64)
        seen_words, seen_nodes = np.zeros(len(leaf), np.float32), np.zeros(len(nodes), np.float32)
        away = np.array([d for d in range(-window, window + 1) if d])
        step = min(max(len(at) // STEPS, LEAST_STEP), MOST_STEP)
        for begin in range(0, len(at), step):
            place = np.arange(begin, min(begin + step, len(at)))
            pace = rate * max(1 - (done + begin / len(at)) / rounds, 1e-4)
            # As in the library: each word has a window of 1 to the full number of places, its neighbours are the input.
            beside = place[:, None] + away
            inside = np.abs(away) <= random.integers(1, window + 1, len(place))[:, None]
            inside &= (beside >= 0) & (beside < len(at))
            beside = np.clip(beside, 0, len(at) - 1)
            inside &= row[beside] == row[place][:, None]
            found: list[list[np.ndarray]] = [[], [], [], [], []]
            for long in np.unique(length[at[place]]):
                if not long:  # the only word of all
                    continue
                mine = length[at[place]] == long
                out, of, mask = at[place[mine]], at[beside[mine]], inside[mine]
                path = np.empty((len(out), long), np.int64)
                path[:, -1] = parent[out]
                for k in range(long - 2, -1, -1):
                    path[:, k] = up[path[:, k + 1]]
                wanted = 1 - (leaf[out][:, None] >> np.arange(long - 1, -1, -1) & 1).astype(np.float32)
                x, u = vectors[of], weights[path]
                error = x @ u.transpose(0, 2, 1)
                product = error[mask]  # most of the time goes into tanh, so it gets the neighbours inside only
                near = np.abs(product) < FARTHEST
                product *= 0.5
                np.tanh(product, out=product)
                product *= 0.5
                np.subtract(np.repeat(wanted - 0.5, mask.sum(1), 0), product, out=product)
                product *= near
                error[...] = 0
                error[mask] = product
                for part, values in zip(found, (of[mask], (error @ u)[mask], path.ravel(), (error.transpose(0, 2, 1) @ x).reshape(-1, size), np.repeat(mask.sum(1), long)), strict=True):
                    part.append(values)
            if found[0]:
                of, turned, path, moved, hits = (np.concatenate(part) for part in found)
                _added(vectors, of, turned, np.ones(len(of), np.float32), pace, seen_words)
                _added(weights, path, moved, hits.astype(np.float32), pace, seen_nodes)
        x = np.concatenate([vectors, weights]).ravel() if done + 1 < rounds else vectors.ravel()
        n = len(x) // size
        column = [*words.column("word").to_pylist(), *[None] * (n - len(leaf))]
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x), size).cast(pa.list_(pa.float32()))
        keys = np.concatenate([leaf, nodes])[:n]
        return pa.table({"_of": pa.array(np.full(n, key[0].as_py(), np.int32)), "word": pa.array(column, pa.string()), "key": pa.array(keys), "x": lists})

    return run


class SkipGram(Estimator):
    """Vectors of all words of at least ``min_count`` occurrences, with a :class:`WordTable` as the model.

    The method is that of the library's ``Word2Vec``: skip-grams in windows of random width, hierarchical softmax over a
    Huffman code of the counts, ``rounds`` passes with a falling rate, parts of the rows that are trained apart and
    averaged after each pass, per word and node over the parts that have it. Its numbers are others: the starting vectors come from
    the words' hashes, a step learns from many words at once, and rows aren't cut after 1000 words. A part is a block of at most about
    ``FIT_TOKENS`` tokens, and there are at least ``tasks``; a task holds the words of its block, so work and memory
    follow the rows. To the driver come the counts that occur and how many words have each. Equal rows give equal vectors.
    Of the tables that are staged only that of the vectors stays.
    """

    def __init__(self, input_col: str, output_col: str, size: int, min_count: int = 0, tasks: int = 16, rounds: int = 2, seed: int = 0, window: int = 5, rate: float = 0.025):
        super().__init__()
        self.input_col, self.output_col, self.size, self.min_count = input_col, output_col, size, min_count
        self.tasks, self.rounds, self.seed, self.window, self.rate = tasks, rounds, seed, window, rate

    def _fit(self, dataset: DataFrame) -> WordTable:
        spark = dataset.sparkSession
        path = new_folder(spark, "word-vectors")
        with scratch(spark), shuffles_end(spark):
            vectors = self._learn(dataset, path)
        return WordTable(vectors, self.input_col, self.output_col, self.size)

    def _learn(self, dataset: DataFrame, path: str) -> DataFrame:
        """The vectors, written to ``path``. What a round has learnt goes when its means are written."""
        size, axes = self.size, range(self.size)
        blocks = max(self.tasks, -(-count_tokens(dataset, self.input_col) // FIT_TOKENS))
        values = [F.col(f"`{f.name}`") for f in dataset.schema if "map<" not in f.dataType.simpleString()]
        rows = in_blocks(dataset.withColumn("_order", F.xxhash64(*values)), blocks).select("_block", "_order", self.input_col)
        marked = staged(marked_words(rows, self.input_col, blocks), "block-words")
        first = [(F.xxhash64("word", F.lit(self.seed), F.lit(j)) / (2.0**64 * size)).cast("float") for j in axes]
        state = words_of_blocks(marked.join(staged(vocabulary(marked, self.min_count), "leaves"), "word"), blocks).select("_of", "word", "key", F.array(*first).alias("x"))
        for done in range(self.rounds):
            run = _learnt(self.input_col, size, self.window, self.seed, done, self.rounds, self.rate)
            found = rows.groupBy("_block").cogroup(state.groupBy("_of")).applyInArrow(run, "_of int, word string, key bigint, x array<float>")
            whole = [F.sum(F.round(F.get("x", F.lit(j)) * ONE).cast("bigint")) for j in axes]
            mean = F.array(*[(s / F.count(F.lit(1)) / ONE).cast("float") for s in whole])
            with lent(found, "learnt") as learnt:
                if done + 1 == self.rounds:
                    return written(learnt.groupBy("word").agg(mean.alias("vector")), path)
                # A key has at most one row per block, and the same word in all.
                means = staged(learnt.groupBy("word", "key").agg(mean.alias("x"), *block_marks("_of", blocks)), "means")
            state = words_of_blocks(means, blocks)
        raise ValueError("vectors are learnt in one round or more")
