"""Sets of word shingles as 64-bit hashes, and their HyperMinHash registers."""

from __future__ import annotations

import numpy as np
import xxhash

from tidemark.llm.common import utf8

REGISTERS = 128  # a power of two
MANTISSA = 10  # bits kept below the leading one of a bucket's smallest hash
EMPTY = 0xFFFF
# Odd multipliers of the mixing steps.
STEP, MIX_A, MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``width`` words, A-Z lower-cased.

    Fewer words make one shingle of all of them; no words make an empty set.
    """
    words = utf8(text).lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    width = min(width, len(words))
    found = np.full(n, width, np.uint64)
    for k in range(width):
        found = mixed(found * STEP + hashes[k : k + n])
    return np.unique(found)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash of a set: per bucket the leading zeros and first mantissa bits of its smallest hash.

    Upper bits of a hash choose the bucket, the rest is the value. A bucket without a hash holds ``EMPTY``.
    """
    width = REGISTERS.bit_length() - 1
    kept = 64 - width
    spread = mixed(hashes)
    bucket = (spread >> np.uint64(kept)).astype(np.int64)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bucket, spread & np.uint64((1 << kept) - 1))
    found = np.full(REGISTERS, EMPTY, np.uint16)
    there = np.flatnonzero(least != np.iinfo(np.uint64).max)
    value = least[there] | np.uint64(1 << 10)  # at most kept - 11 leading zeros, so a mantissa is always there
    high = np.frexp(value.astype(np.float64))[1]  # position after the leading one; rounding up doesn't split equals
    zeros = np.clip(kept - high, 0, 63)
    shift = np.maximum(high - 1 - MANTISSA, 0).astype(np.uint64)
    mantissa = (value >> shift) & np.uint64((1 << MANTISSA) - 1)
    found[there] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return found


def bands(found: np.ndarray, rows: int) -> np.ndarray:
    """For each sketch (a row of ``found``), a 64-bit key per whole band of ``rows`` registers.

    An empty bucket takes the register of the next full one, so small sets can be banded too.
    """
    filled = found.copy()
    for k in range(2 * REGISTERS - 2, -1, -1):
        at, following = k % REGISTERS, (k + 1) % REGISTERS
        filled[:, at] = np.where(filled[:, at] == EMPTY, filled[:, following], filled[:, at])
    count = REGISTERS // rows
    parts = filled[:, : count * rows].reshape(len(found), count, rows).astype(np.uint64)
    keys = np.tile(np.arange(1, count + 1, dtype=np.uint64), (len(found), 1))
    for k in range(rows):
        keys = mixed(keys * STEP + parts[:, :, k])
    return keys.view(np.int64)


def rows_per_band(similarity: float, missed: float = 1e-6) -> int:
    """The most registers a band may have if pairs of that similarity are to share one but for ``missed``."""
    return max(
        (r for r in range(1, 17) if (1 - similarity**r) ** (REGISTERS // r) <= missed), default=1
    )


# Two different minima agree by chance if their leading zeros and their mantissas do: a third of 2^-MANTISSA.
CHANCE = 2.0**-MANTISSA / 3


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Jaccard estimates of one sketch with each row of ``many``, corrected for agreement by chance."""
    there = (many != EMPTY) | (one != EMPTY)
    equal = (many == one) & (many != EMPTY)
    share = equal.sum(axis=-1) / np.maximum(there.sum(axis=-1), 1)
    return np.clip((share - CHANCE) / (1 - CHANCE), 0.0, 1.0)


def lowest_estimate(similarity: float, there: np.ndarray | int = REGISTERS) -> np.ndarray:
    """Pairs of that similarity are estimated lower in about one of a million cases."""
    return similarity - 5.0 * np.sqrt(similarity * (1 - similarity) / np.maximum(there, 1)) - 1.0 / np.maximum(there, 1)
