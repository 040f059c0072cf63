"""Sketches choose which members of a block are compared on their full sets."""

import numpy as np

from tidemark.llm import near, shingles


def test_likely_members_hold_every_similar_pair():
    draw = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(12):
        base = list(draw.choice(words, 60))
        texts.append(" ".join(base))
        for changes in (1, 4, 30):
            other = list(base)
            for at in draw.integers(0, len(other), changes):
                other[at] = str(draw.choice(words))
            texts.append(" ".join(other))
    sets = [shingles.shingle_set(t, 3) for t in texts]
    sketch = np.stack([shingles.registers(s) for s in sets])
    every = np.arange(len(texts))
    labels = every.copy()
    left, right = near.with_likely(sketch, labels, every, every, 80)
    likely = {*left} & {*right}
    similar = {
        k for i in every for j in every if i != j
        and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])) for k in (i, j)
    }
    assert similar and similar <= likely
    assert len(likely) < len(texts)  # unlike texts are not compared
    assert [len(side) for side in near.with_likely(sketch, np.zeros_like(labels), every, every, 80)] == [0, 0]
    assert [len(side) for side in near.with_likely(sketch, labels, every[:0], every[:0], 80)] == [0, 0]
