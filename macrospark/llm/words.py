"""Words and shingles of many texts at once, as numpy arrays over Arrow's own buffers.

A word's hash is a sum over its bytes, each byte's random number times a power of an odd
constant (modulo 2**64), so that one running sum over the buffer gives the hashes of all words.
Hashes depend on nothing but the word: every worker and every run agrees.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_ODD = 0xD1342543DE82EF95
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _random(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(seed << 20)) * U(_STEP))


def _byte_values(fold: bool) -> np.ndarray:
    values = _random(256, 1) | U(1)
    if fold:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


def _classes() -> np.ndarray:
    """0: white space and control, 1: letters and digits, 2: other signs."""
    kind = np.full(256, 2, np.uint8)
    kind[:0x21] = 0
    kind[0x7F] = 0
    kind[0x30:0x3A] = kind[0x41:0x5B] = kind[0x61:0x7B] = 1
    kind[0x80:] = 1
    return kind


_KIND = _classes()
_FOLDED, _PLAIN = _byte_values(True), _byte_values(False)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        steps = np.full(size, base, U)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text begins (one more entry than texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def span_hashes(raw: np.ndarray, first: np.ndarray, after: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hashes of the bytes from each `first` up to `after`."""
    total = np.empty(len(raw) + 1, U)
    total[0] = 0
    np.cumsum((_FOLDED if fold else _PLAIN)[raw] * _power(_ODD, len(raw)), out=total[1:])
    return mix((total[after] - total[first]) * _power(_INVERSE, len(raw))[first])


def tokens(texts: pa.Array, fold: bool = True, signs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin.

    `fold` lower-cases A-Z; `signs` makes each run of punctuation a token of its own.
    """
    raw, at = utf8(texts)
    kind = _KIND[raw]
    if not signs:
        kind = kind & np.uint8(1)
    n = len(raw)
    if not n:
        return np.empty(0, U), np.zeros(len(at), np.int64)
    begins = np.empty(n, bool)
    begins[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    begins[at[:-1][at[:-1] < n]] = True
    edges = np.flatnonzero(begins)
    used = kind[edges] != 0
    first = edges[used]
    after = np.append(edges[1:], n)[used]
    return span_hashes(raw, first, after, fold), np.searchsorted(first, at)


def shingles(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word shingles of each text: text number, 48-bit shingle, occurrences; sorted.

    A text of fewer words than `size`, but not none, has one shingle of all its words.
    At most 65,536 texts at once.
    """
    words, at = tokens(texts)
    counts = np.diff(at)
    factors = _random(size, 2) | U(1)
    n = max(len(words) - size + 1, 0)
    sums = np.zeros(n, U)
    for j in range(size):
        sums += words[j : j + n] * factors[j]
    text = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(text[:n] == text[size - 1 : size - 1 + n]) if n else np.empty(0, np.int64)
    ids, texts_of = sums[whole], text[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        some = [sum((int(w) * int(f) for w, f in zip(words[at[i] : at[i + 1]], factors)), int(counts[i])) for i in short]
        ids = np.concatenate([ids, np.array([x & (2**64 - 1) for x in some], U)])
        texts_of = np.concatenate([texts_of, short])
    keys = np.sort((texts_of.astype(U) << U(48)) | (mix(ids) >> U(16)))
    if not len(keys):
        return np.empty(0, np.int64), keys, np.empty(0, np.int64)
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    occurrences = np.diff(np.append(heads, len(keys)))
    keys = keys[heads]
    return (keys >> U(48)).astype(np.int64), keys & U(2**48 - 1), occurrences
