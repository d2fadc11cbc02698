"""64-bit hashes of words, word shingles and character shingles, over arrays of bytes."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit numbers."""
    part = x >> np.uint64(30)
    x = x ^ part
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=part)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=part)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting is several times faster here than ``numpy.unique``."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE = mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word in ``data``, A-Z taken as a-z.

    A word is a run of bytes without ASCII white space, which in UTF-8 never splits a character.
    Its hash sums each byte's number times the number of its place.
    """
    solid = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    lengths = ends - starts
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    place = at - np.repeat(starts, lengths)
    values = _BYTE[_LOWER[data[at]]] * _PLACE[place & 4095] + (place >> 12).astype(np.uint64)
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64)), starts


def shingles_of(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of five words in a row; of all words where there are fewer."""
    n = len(words)
    if not n:
        return words
    width = min(WIDTH, n)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total += words[k : n - width + 1 + k] * _PLACE[k + 8]
    return distinct(mix(total))


def text_shingles(text: str) -> np.ndarray:
    return shingles_of(word_hashes(np.frombuffer(text.encode(), dtype=np.uint8))[0])


def many_shingles(texts: list[str]) -> list[np.ndarray]:
    """``text_shingles`` of each text, with the words of all hashed at once."""
    encoded = [t.encode() for t in texts]
    words, starts = word_hashes(np.frombuffer(b" ".join(encoded), dtype=np.uint8))
    ends = np.cumsum([len(e) + 1 for e in encoded])
    cuts = np.searchsorted(starts, ends)
    return [shingles_of(w) for w in np.split(words, cuts[:-1])]


def fingerprint(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    one = int(mix(elements + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64))
    two = int(mix(elements ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64))
    return one - (1 << 63), two - (1 << 63)
