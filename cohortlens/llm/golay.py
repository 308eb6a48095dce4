"""The binary Golay code (23, 12, 7): which codewords lie near a 23-bit word.

Every word has exactly one codeword within distance 3. A word at distance 3 of its codeword has five
more at distance 4, a word at distance 2 or less has none. ``codeword_indices`` returns these: words
that differ in at most one bit always share an index.

Why: take x and y at distance 1, and c the codeword nearest to x. If c is within 2 of x, it is within
3 of y and so the one that y decodes to. If c is at distance 3 of x, y is at distance 2 or 4 of c. At
2, y decodes to c. At 4, y decodes to another codeword within 3 of y, hence within 4 of x, which is
among the five that x adds.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
WORD_BITS, CHECK_BITS = 23, 11
KEYS = 6


def _remainder(word: int) -> int:
    for bit in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each 12-bit upper part, and for each syndrome the six error patterns of weight
    up to 4 (the single pattern of weight 0 to 2 repeated where there is only one)."""
    upper = np.array([_remainder(m << CHECK_BITS) for m in range(1 << 12)], dtype=np.int64)
    single = [_remainder(1 << b) for b in range(WORD_BITS)]
    patterns: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for bits in combinations(range(WORD_BITS), weight):
            syndrome = error = 0
            for b in bits:
                syndrome ^= single[b]
                error |= 1 << b
            patterns[syndrome].append(error)
    errors = np.array([(p * KEYS)[:KEYS] if len(p) == 1 else p for p in patterns], dtype=np.int64)
    return upper, errors


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: (n, 6) indices of nearby codewords, and which of the six are distinct."""
    upper, errors = tables()
    syndrome = upper[words >> CHECK_BITS] ^ (words & ((1 << CHECK_BITS) - 1))
    near = errors[syndrome]
    indices = (words[:, None] ^ near) >> CHECK_BITS  # the code is systematic: the message is in the upper bits
    distinct = np.ones(near.shape, dtype=bool)
    distinct[:, 1:] = near[:, 1:] != near[:, :1]
    return indices, distinct
