"""Word shingles of whole texts as 64-bit hashes, from flat byte arrays."""

from __future__ import annotations

import hashlib

import numpy as np

_U = np.uint64
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
#: Words up to so many bytes are hashed together, eight bytes of all of them at a time.
SHORT = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def word_hashes(low: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs from ``first`` to ``end``, which are not empty.

    Eight bytes at a time go through a bijection, from one that the length
    picks, so words that differ in one such step only never share a hash.  Long
    ones, which are few, are hashed by a cryptographic function.
    """
    size = end - first
    h = mix(size.astype(np.uint64) + _U(0x9E3779B97F4A7C15))
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    at = np.flatnonzero(size <= SHORT)
    step = 0
    while len(at):
        left = size[at] - 8 * step
        part = padded[(first[at] + 8 * step)[:, None] + np.arange(8)]
        part[np.arange(8)[None, :] >= left[:, None]] = 0
        h[at] = mix((h[at] ^ part.view(np.uint64)[:, 0]) * _U(0x9FB21C651E98DF25) + _U(2 * step + 1))
        step += 1
        at = at[left > 8]
    for i in np.flatnonzero(size > SHORT).tolist():
        digest = hashlib.blake2b(low[first[i]:end[i]].tobytes(), digest_size=8).digest()
        h[i] = np.frombuffer(digest, np.uint64)[0]
    return h


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of non-space bytes, A-Z as a-z) and each text's offsets in them."""
    solid = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    before = np.append(False, solid[:-1]) if len(raw) else solid
    first = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.append(solid[1:], False) if len(raw) else solid
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return word_hashes(_LOWER[raw], first, end), np.searchsorted(first, at)


def shingle_sets(raw: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """Every text's sorted distinct shingles of ``width`` words; with fewer words the whole sequence, without any none."""
    word, place = words(raw, at)
    out = []
    n = len(word)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        rolled = mix(rolled + word[k:n - width + 1 + k] + _U(k + 1)) if len(rolled) else rolled
    for a, b in zip(place[:-1].tolist(), place[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for k in range(b - a):
                h = mix(h + word[a + k] + _U(k + 1))
            out.append(mix(h + _U(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
