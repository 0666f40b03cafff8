"""Texts that share passages."""

import numpy as np


def word_lists(kind):
    rng = np.random.default_rng(len(kind))
    alphabet = list(kind) if kind != "many" else [f"w{i}" for i in range(5000)]
    shared = [list(rng.choice(alphabet, n)) for n in (11, 12, 13, 20, 40)]
    texts = []
    for _ in range(40):
        parts = [list(rng.choice(alphabet, rng.integers(0, 15)))]
        for _ in range(rng.integers(0, 3)):
            parts += [shared[rng.integers(len(shared))], list(rng.choice(alphabet, rng.integers(0, 6)))]
        texts.append(" ".join(w for p in parts for w in p))
    return [*texts, "", None, "a " * 12, "b " * 13, "a b " * 9]
