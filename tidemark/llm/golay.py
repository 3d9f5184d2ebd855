"""Fuzzy keys of bit segments: indices of the Golay codewords near them.

The binary Golay code of length 23 is perfect: each word is within three bits of exactly one of
4,096 codewords. A segment's keys are the codewords next to itself and to each word one bit
away, one or six in all; two segments that differ in at most two bits have a word in common that
is within one bit of both, and so share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LENGTH, CHECKS = 23, 11


class Golay:
    def __init__(self) -> None:
        powers = []
        for i in range(LENGTH):
            rest = 1 << i
            for bit in range(LENGTH - 1, CHECKS - 1, -1):
                if rest >> bit & 1:
                    rest ^= GENERATOR << (bit - CHECKS)
            powers.append(rest)

        def syndromes(first: int, bits: int) -> np.ndarray:
            table = np.zeros(1 << bits, np.int64)
            for i in range(bits):
                table[1 << i : 2 << i] = table[: 1 << i] ^ powers[first + i]
            return table

        self.low, self.high = syndromes(0, 12), syndromes(12, LENGTH - 12)
        self.errors = np.zeros(1 << CHECKS, np.int64)
        for weight in (1, 2, 3):
            for bits in combinations(range(LENGTH), weight):
                word = sum(1 << b for b in bits)
                self.errors[int(self.low[word & 0xFFF] ^ self.high[word >> 12])] = word

    def nearest(self, words: np.ndarray) -> np.ndarray:
        """The index (message bits) of the codeword next to each word."""
        error = self.errors[self.low[words & 0xFFF] ^ self.high[words >> 12]]
        return (words ^ error) >> CHECKS

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``words``, index) of every key, each once."""
        around = np.stack([words, *[words ^ (1 << b) for b in range(LENGTH)]], axis=1)
        found = np.sort(self.nearest(around), axis=1)
        first = np.ones_like(found, dtype=bool)
        first[:, 1:] = found[:, 1:] != found[:, :-1]
        return np.nonzero(first)[0], found[first]
