"""Suffix arrays by ranks of growing prefixes.

Each suffix starts with the rank of its first symbol. A round packs the ranks at equal
distances behind it into one number and ranks those numbers, so that a rank stands for several
times as many symbols as before; the last round may overlap what is known, so that it ends at
exactly `depth` symbols. Equal ranks are equal prefixes. All steps work on whole arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def prefix_ranks(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The ranks of all suffixes by their first `depth` symbols, from 1; a suffix that ends is less than its extensions."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].reshape(n) + 1  # 0 is past the end
    span = 1
    while n and span < depth and (most := int(rank.max())) < n:
        bits = most.bit_length()
        code, reach = rank.copy(), span
        for _ in range(1, 63 // bits):
            step = min(span, depth - reach)
            if not step:
                break
            reach += step
            code <<= bits
            code[: max(0, n - reach + span)] |= rank[reach - span :]
        order = np.argsort(code)
        code = code[order]
        rank[order] = np.cumsum(np.append(1, code[1:] != code[:-1]))
        span = reach
    return rank


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """The starts of all suffixes in ascending order; a suffix is less than its extensions."""
    return np.argsort(prefix_ranks(np.asarray(symbols, np.int64), len(symbols))).tolist()
