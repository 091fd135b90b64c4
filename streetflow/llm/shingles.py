"""Distinct 5-word shingles of whole texts as 64-bit hashes, by array arithmetic.

Words are runs of bytes other than the six white-space bytes, A-Z lower-cased.
A word's hash is a sum of byte values times position multipliers, mixed; a
shingle's is a sum of its words' hashes times multipliers, mixed.  Both are plain
functions of the words, so equal shingles are equal anywhere.  Work runs over the
bytes of many documents at once in windows of bounded size, so one very long text
needs no more memory than its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from streetflow.llm.common import string_bytes

WORDS_PER_SHINGLE = 5
WINDOW_BYTES = 1 << 20

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every bit."""
    x = x.astype(U, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U(30)
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
    return x


def series(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd multipliers."""
    with np.errstate(over="ignore"):
        return mix(U(seed) + np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = series(11, 256)[_LOWER]
_PLACE = series(23, 64)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = series(23, 1 << (n - 1).bit_length())
    return _PLACE


def _window_words(data: np.ndarray, begins: np.ndarray, parts: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word, or of its first ``most`` bytes; ``begins``: where documents begin."""
    inside = ~parts[data]
    if not inside.any():
        return np.zeros(0, U), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = begins[(begins >= 0) & (begins < len(data))]
    first[begins] |= inside[begins]
    starts = np.flatnonzero(first)
    at = np.flatnonzero(first[inside])  # the starts, counted in word bytes only
    sizes = np.diff(np.append(at, np.count_nonzero(inside)))
    place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
    with np.errstate(over="ignore"):
        value = _BYTE[data[inside]] * _places(int(sizes.max()))[place]
        if most is not None:
            value[place >= most] = 0
        return mix(np.add.reduceat(value, at)), starts


def _window_end(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray, lo: int) -> int:
    """Where a window from ``lo`` ends: after a parting byte or at a document's end, so no word is cut."""
    hi = lo + WINDOW_BYTES
    if hi >= len(data):
        return len(data)
    space = np.flatnonzero(parts[data[lo:hi]])
    edge = int(offsets[np.searchsorted(offsets, hi, side="right") - 1])  # the last document begun by then
    if space.size or edge > lo:
        return max(edge, lo + int(space[-1]) + 1 if space.size else 0)
    stop = int(offsets[np.searchsorted(offsets, lo, side="right")])  # one word fills the window
    space = np.flatnonzero(parts[data[hi:stop]])
    return hi + int(space[0]) + 1 if space.size else stop


def word_hashes(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = _SPACE, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each document the index of its first word (n + 1 values).

    ``parts``: for each byte, whether it parts words; ``most``: bytes of a word that count."""
    hashes, starts, lo = [np.zeros(0, U)], [np.zeros(0, np.int64)], 0
    while lo < len(data):
        hi = _window_end(data, offsets, parts, lo)
        h, s = _window_words(data[lo:hi], offsets - lo, parts, most)
        hashes.append(h)
        starts.append(s + lo)
        lo = hi
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


_WORD = series(37, WORDS_PER_SHINGLE)
_SHORT = series(41, WORDS_PER_SHINGLE)


def shingle_sets(arr: pa.Array) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, ascending; empty without words."""
    words, first = word_hashes(*string_bytes(arr))
    k = WORDS_PER_SHINGLE
    with np.errstate(over="ignore"):
        if len(words) >= k:
            run = words[: len(words) - k + 1] * _WORD[0]
            for j in range(1, k):
                run += words[j : len(words) - k + 1 + j] * _WORD[j]
            run = mix(run)
        else:
            run = np.zeros(0, U)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= k:
                s = np.sort(run[a : b - k + 1])
                yield s[np.append(True, s[1:] != s[:-1])]
            elif b > a:  # fewer words: the whole sequence, told apart by its length
                yield mix((words[a:b] * _WORD[: b - a]).sum(dtype=U, keepdims=True) + _SHORT[b - a])
            else:
                yield np.zeros(0, U)


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each set, the same for equal sets only (but for a chance of 2^-128 a pair)."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    one, two = np.zeros(len(sets), U), np.zeros(len(sets), U)
    full = sizes > 0
    if full.any():
        flat = np.concatenate(sets)
        at = (np.cumsum(sizes) - sizes)[full]
        with np.errstate(over="ignore"):
            one[full] = mix(np.add.reduceat(flat, at) + sizes[full].astype(U))
            two[full] = mix(np.add.reduceat(mix(flat ^ U(0xA5A5A5A5A5A5A5A5)), at))
    return one.view(np.int64), two.view(np.int64)
