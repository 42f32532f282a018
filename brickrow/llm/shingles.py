"""Word shingles of whole texts as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

WIDTH = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_M1, _M2, _ODD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_THREE = np.uint64(3)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _ODD, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: A random-looking odd number for each byte, capital letters as small ones.
_BYTE = mix(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) + _ODD) | np.uint64(1)
_POWERS = _powers(256)


def words(data: bytes) -> np.ndarray:
    """Hashes of the words, runs of anything but the six ASCII white-space characters; A-Z count as a-z."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    word = ~_SPACE[b]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.append(edge, len(b))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    longest = int((end - start).max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    lead = np.concatenate([[0], start])
    place = np.arange(len(b)) - np.repeat(lead, np.diff(lead, append=len(b)))
    value = _BYTE[b]
    value *= powers[np.where(word, place, 0)]
    cuts = edge if edge[-1] < len(b) else edge[:-1]
    return mix(np.add.reduceat(value, cuts)[::2] + (end - start).astype(np.uint64))


def shingles(text: str) -> np.ndarray:
    """The text's set, ascending: windows of five words; the whole sequence if there are fewer, none without words."""
    h = words(text.encode())
    if not len(h):
        return h
    if len(h) < WIDTH:
        x = np.array([len(h)], np.uint64)
        for y in h:
            x = mix(x * _THREE + y)
        return x
    n = len(h) - WIDTH + 1
    x = h[:n].copy()
    for k in range(1, WIDTH):
        x = mix(x * _THREE + h[k : k + n])
    return np.unique(x)
