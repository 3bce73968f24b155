"""Words and their hashes over a whole Arrow batch, with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

HELD_BYTES = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def is_space() -> np.ndarray:
    """Byte table of the ASCII white space."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


SPACE = is_space()


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 with a space after each, and where each text begins (and the end).

    Null texts are empty.
    """
    texts = pc.fill_null(column, "").cast(pa.large_binary()).to_pylist()
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1, out=begins[1:])
    return data, begins


def spans(inside: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of True, and the first run of each text (and the number of runs).

    The byte after each text must be False.
    """
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    return starts, ends, np.searchsorted(starts, begins)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (a 64-bit finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse modulo 2**64, at least ``n`` of each."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
        up, down = np.full(size, _FACTOR, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS[size]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the span lies.

    Spans are hashed in pieces of about ``HELD_BYTES``, so memory does not grow with a text.
    """
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(int(np.searchsorted(starts, low + HELD_BYTES)), i + 1)
        high = int(ends[i:j].max())
        up, down = _powers(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.multiply(data[low:high] + np.uint64(1), up[: high - low], out=sums[1:])
        np.cumsum(sums, out=sums)
        first, last = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)
        i = j
    return mixed(out)


def shingle_hashes(
    words: np.ndarray, firsts: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words of each text, and each text's first (and the end).

    A text of fewer words, but not none, has one shingle: all its words.
    """
    counts = np.diff(firsts)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(made)]).astype(np.int64)
    at = np.arange(begins[-1]) - np.repeat(begins[:-1] - firsts[:-1], made)
    last = np.repeat(firsts[1:], made)
    total = np.zeros(len(at), np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    for i in range(k):
        here = np.where(at + i < last, padded[at + i], np.uint64(0))
        total = total * _FACTOR + here
    return mixed(total), begins
