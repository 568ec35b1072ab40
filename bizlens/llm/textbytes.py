"""Words of many texts at once, on the bytes of a string column.

Words are runs of other bytes than space and 0x09-0x0D, with A-Z in lower case.
A word is known by a 64-bit hash: sum of (byte + 1) * base^(place in the word),
scrambled together with its length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from bizlens.llm.common import mix64

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BREAK = np.zeros(256, bool)
BREAK[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n - 1) modulo 2^64, kept for the next call."""
    out = _powers.get(base, np.ones(1, np.uint64))
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    if len(out) <= 1 << 23:
        _powers[base] = out
    return out[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row (null: empty) and their offsets."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


@dataclass
class Words:
    hash: np.ndarray  # of each word
    per_text: np.ndarray  # number of words of each text


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    if not n:
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64))
    data = LOWER[data]
    ink = ~BREAK[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a text's first byte follows no other
    begin = ink.copy()
    begin[1:] &= ~ink[:-1] | first[1:n]
    done = ink.copy()
    done[:-1] &= ~ink[1:] | first[1:n]
    start, end = np.flatnonzero(begin), np.flatnonzero(done) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    h = (total[end] - total[start]) * powers(INVERSE, n)[start]
    h = mix64(h ^ mix64((end - start).astype(np.uint64)))
    return Words(h, np.diff(np.searchsorted(start, offsets)))
